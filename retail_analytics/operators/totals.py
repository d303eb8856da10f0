"""Closing rows, alerts and reconciliation across results."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from retail_analytics.functions.grid import with_scalars
from retail_analytics.functions.shape import append_total, ratio

SEVERITIES = ["critica", "alta", "media", "info"]


def total_row(df: DataFrame, label: str, sums: list[str], extras: dict[str, Column] | None = None) -> DataFrame:
    """Frame plus its TOTAL GENERAL row (see ``shape.append_total``)."""
    return append_total(df, label, sums, extras)


def alert(df: DataFrame, when: Column, severity: str, title: str, detail: Column, amount: Column | None = None) -> DataFrame:
    """Alert rows (severidad, titulo, detalle, monto) for the rows of a result that cross a threshold."""
    if severity not in SEVERITIES:
        raise ValueError(f"severity {severity!r}")
    money = amount.cast("double") if amount is not None else F.lit(None).cast("double")
    return df.filter(when).select(F.lit(severity).alias("severidad"), F.lit(title).alias("titulo"), detail.alias("detalle"), money.alias("monto"))


def alerts(parts: list[DataFrame]) -> DataFrame:
    """All alerts, most severe first."""
    rank = F.array_position(F.array(*[F.lit(x) for x in SEVERITIES]), F.col("severidad"))
    return reduce(lambda a, b: a.unionByName(b), parts).withColumn("orden", rank.cast("long"))


def reconcile(a: DataFrame, b: DataFrame, value_a: str, value_b: str) -> DataFrame:
    """Two measures of the same quantity side by side with the gap in units and in %."""
    t = with_scalars(a.agg(F.sum(value_a).alias("medida_a")), b.agg(F.sum(value_b).alias("medida_b")))
    return t.withColumn("brecha", F.col("medida_b") - F.col("medida_a")).withColumn("pct_brecha", ratio(F.abs("brecha"), "medida_a"))
