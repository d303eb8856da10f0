"""Checks that ride along with a write: metrics observed by the writing job itself, no second scan."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F


class CheckFailed(ValueError):
    """The written rows don't meet the checks; ``metrics`` has what was observed."""

    def __init__(self, failed: list[str], metrics: dict):
        super().__init__(f"{', '.join(failed)}: {metrics}")
        self.failed, self.metrics = failed, metrics


def contract_metrics(required: list[str]) -> dict[str, Column]:
    """Rows and, per required column, the rows without a value."""
    return {"filas": F.count(F.lit(1))} | {f"sin_{c}": F.count_if(F.col(c).isNull()) for c in required}


def closure_metrics(part: str, whole: float) -> dict[str, Column]:
    """The sum of the parts and how far it is from the whole."""
    return {"suma": F.coalesce(F.sum(part), F.lit(0.0)), "resto": F.coalesce(F.sum(part), F.lit(0.0)) - F.lit(whole)}


def reconcile_metrics(a: str, b: str) -> dict[str, Column]:
    """Two measures of the same quantity and their difference."""
    return {"total_a": F.sum(a), "total_b": F.sum(b), "diferencia": F.sum(a) - F.sum(b)}


def write_checked(df: DataFrame, path: str, metrics: dict[str, Column], checks: dict[str, Callable[[dict], bool]]) -> dict:
    """Writes ``df`` and returns the observed metrics; raises ``CheckFailed`` where one of ``checks`` (name -> test of the metrics)
    fails.  The rows are then written, but the caller has not published them."""
    seen = Observation("checks")
    df.observe(seen, *[c.alias(name) for name, c in metrics.items()]).write.mode("errorifexists").parquet(path)
    found = seen.get
    failed = [name for name, holds in checks.items() if not holds(found)]
    if failed:
        raise CheckFailed(failed, found)
    return found


def as_rows(spark: SparkSession, found: dict) -> DataFrame:
    """The metrics as rows (metrica, valor)."""
    return spark.createDataFrame([(k, float(v)) for k, v in sorted(found.items())], "metrica string, valor double")
