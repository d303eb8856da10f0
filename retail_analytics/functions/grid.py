"""Complete grids: every row of a frame combined with every member of a small dimension."""
from __future__ import annotations

import weakref
from collections.abc import Callable
from contextvars import ContextVar

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F


def complete_grid(df: DataFrame, dim: DataFrame) -> DataFrame:
    """Rows of ``df`` x distinct rows of ``dim``.

    The result size is the definition of the operator (a zero-filled report grid).  ``dim`` is a dimension whose
    size does not follow the facts (branches, categories, months); it travels as one array in a scalar subquery
    and is exploded next to ``df``, so ``df`` is neither shuffled nor broadcast.
    """
    members = dim.agg(F.sort_array(F.collect_set(F.struct(*dim.columns))).alias("_m"))
    return (df.withColumn("_m", F.explode(members.scalar()))
            .select(*[df[c] for c in df.columns], *[F.col(f"_m.{c}").alias(c) for c in dim.columns]))


def cross_grid(df: DataFrame, dim: DataFrame) -> DataFrame:
    """``complete_grid`` for a grid that is joined or filtered afterwards: the same rows, made by a join.

    Spark takes an exploded frame to be as large as its input, and would broadcast the grid as if it were; a cross join is never
    taken to be smaller than it is.  Filters on columns of ``dim`` reach it before the rows are made.
    """
    return df.crossJoin(F.broadcast(dim.distinct()))


_HELD: ContextVar[list | None] = ContextVar("held", default=None)


def shared(df: DataFrame) -> DataFrame:
    """An aggregate that the following steps read several times: computed on first use, on executors' memory and disk.

    Nothing runs while the plan is built, the plan stays small, and a lost executor's blocks come back from the lineage.
    """
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    if (held := _HELD.get()) is not None:
        held.append(df)
    else:                                # an operator that is used by itself: released once nobody holds its frame
        weakref.finalize(df, _DUE.append, type(df)(df._jdf, df.sparkSession)).atexit = False
    return df


_DUE: list[DataFrame] = []


def released(build: Callable[[], DataFrame]) -> DataFrame:
    """The frame that ``build`` makes.  What it shares leaves the storage when the next frame is built after the caller has let go
    of this one: frames that the caller has derived from it in between still find it."""
    while _DUE:
        df = _DUE.pop()
        if df.sparkSession.sparkContext._jsc is not None:           # its session may have ended
            df.unpersist()
    token = _HELD.set([])
    try:
        out = build()
        held = _HELD.get()
    finally:
        _HELD.reset(token)
    if held:
        weakref.finalize(out, _DUE.extend, held).atexit = False
    return out


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row aggregate to every row (uncorrelated scalar subquery, no join)."""
    packed = one_row.select(F.struct(*one_row.columns).alias("_s")).scalar()
    return df.withColumn("_s", packed).select(*df.columns, *[F.col(f"_s.{c}").alias(c) for c in one_row.columns])
