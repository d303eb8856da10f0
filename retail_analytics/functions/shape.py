"""Shapes of report frames: wide columns from fixed values, ratios, calibrated rounding, total rows."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def slug(v) -> str:
    """Value as part of a column name."""
    return "".join(ch if ch.isalnum() else "_" for ch in str(v))


def wide(df: DataFrame, keys: list[str], col: str, values: list, measures: dict[str, str], fill: float | None = 0) -> DataFrame:
    """One row per key and one column ``<prefix>_<value>`` per measure and value, in a single aggregation."""
    out = []
    for prefix, m in measures.items():
        for v in values:
            s = F.sum(F.when(F.col(col) == F.lit(v), F.col(m)))
            out.append((s if fill is None else F.coalesce(s, F.lit(fill))).alias(f"{prefix}_{slug(v)}"))
    return df.groupBy(*keys).agg(*out)


def ratio(num, den, empty: float | None = None) -> Column:
    """num / den as double; a zero or NULL denominator gives ``empty``."""
    n = F.col(num) if isinstance(num, str) else num
    d = F.col(den) if isinstance(den, str) else den
    r = F.try_divide(n.cast("double"), F.nullif(d.cast("double"), F.lit(0.0)))
    return r if empty is None else F.coalesce(r, F.lit(float(empty)))


def yoy(a, b) -> Column:
    """Change in % against b: 0/0 is 0, x/0 is 100; NULL counts as 0."""
    x, y = F.coalesce(F.col(a), F.lit(0.0)), F.coalesce(F.col(b), F.lit(0.0))
    return F.when(y == 0, F.when(x == 0, 0.0).otherwise(100.0)).otherwise(F.try_divide((x - y) * 100.0, y))


def grouping_sets(df: DataFrame, sets: dict[str, list[str]], aggs: list[Column], extra: list[str] | None = None,
                  label: str = "nivel") -> DataFrame:
    """Aggregate over several key sets in one pass; ``label`` names the set of each row.

    ``extra`` keys belong to every set (a client id when the next step counts clients).  Rolled-up keys are NULL,
    so the label, not the NULL, tells a total from a missing key.
    """
    extra = extra or []
    cols = list(dict.fromkeys(c for s in sets.values() for c in s))
    gid = sum((F.grouping(c).cast("int") * (1 << i) for i, c in enumerate(cols)), F.lit(0))
    out = df.groupingSets([[F.col(c) for c in [*s, *extra]] for s in sets.values()],
                          *[F.col(c) for c in [*cols, *extra]]).agg(*aggs, gid.alias("_gid"))
    name = F.lit(None).cast("string")
    for lab, s in sets.items():
        code = sum(1 << i for i, c in enumerate(cols) if c not in s)
        name = F.when(F.col("_gid") == code, F.lit(lab)).otherwise(name)
    return out.withColumn(label, name).drop("_gid")


def append_total(df: DataFrame, label: str, sums: list[str], extras: dict[str, Column] | None = None,
                 text: str = "TOTAL GENERAL", where: Column | None = None) -> DataFrame:
    """Add a TOTAL row: sums of the additive columns, given values for the recomputed ones, NULL elsewhere.

    ``extras`` are aggregate expressions over the rows (ratio of sums and the like).
    """
    src = df.filter(where) if where is not None else df
    extras = extras or {}
    aggs = [F.sum(c).alias(c) for c in sums] + [e.alias(c) for c, e in extras.items()]
    t = src.agg(*aggs) if aggs else src.limit(1)
    types = {f.name: f.dataType for f in df.schema.fields}
    done = {*sums, *extras}
    row = t.select(*[F.lit(text).alias(c) if c == label else (F.col(c).cast(types[c]).alias(c) if c in done
                   else F.lit(None).cast(types[c]).alias(c)) for c in df.columns])
    return df.unionByName(row)
