"""Joins whose left side may hold most of its rows under a few keys (counter-sale clients)."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

HEAVY, TRACKED = 64, 10_000           # keys that may go the broadcast way; items that the sketch keeps
SHARE = 0.01                          # of all rows: from here on a key is heavy


def heavy_keys(df: DataFrame, keys: list[str], share: float = SHARE) -> Column:
    """Hashes of the keys that hold at least ``share`` of the rows, as a scalar array of ``HEAVY`` longs at most.

    A mergeable frequent-item sketch counts them in one pass of partial aggregates.  It is kept of hashes, so a collision only
    sends a light key along; a key far above the share can't be missed, as the sketch's error is a few rows in ``TRACKED``.
    """
    top = F.expr(f"approx_top_k(_h, {HEAVY}, {TRACKED})")
    found = df.select(F.xxhash64(*keys).alias("_h")).agg(top.alias("_top"), F.count(F.lit(1)).alias("_n"))
    heavy = F.transform(F.filter("_top", lambda x: x["count"] >= F.col("_n") * share), lambda x: x["item"])
    return found.select(F.coalesce(heavy, F.array().cast("array<bigint>")).alias("heavy")).scalar()


def join_heavy(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left", share: float = SHARE) -> DataFrame:
    """``left.join(right, keys, how)`` for a ``right`` that is unique in the keys: rows of heavy keys stay where they are and meet
    their few partners (``HEAVY`` rows at most) by broadcast, the others are shuffled."""
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(how)
    heavy = heavy_keys(left, keys, share)

    def is_heavy() -> Column:
        return F.array_contains(heavy, F.xxhash64(*keys))

    few = left.filter(is_heavy()).join(F.broadcast(right.filter(is_heavy())), keys, how)
    return left.filter(~is_heavy()).join(right, keys, how).unionByName(few)


def fits_broadcast(df: DataFrame, unpacked: int = 1) -> bool:
    """Whether Spark may broadcast a table by its size on disk, taken ``unpacked`` times; nothing is run."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) * unpacked <= limit
