"""Registry of the named queries: a Spark plan per operator id and, where SQL can say it, its DuckDB oracle."""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from retail_analytics.functions.grid import released
from retail_analytics.star import STAR_CTE, Star


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Star], DataFrame]
    sql: str | None
    floats: dict[str, int]
    ints: tuple[str, ...]
    dates: tuple[str, ...]

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        """Engines add doubles in different orders, so doubles are rounded here, at the query boundary only."""
        return released(lambda: self._rounded(self.build(Star(spark, sf_dir))))

    def _rounded(self, df: DataFrame) -> DataFrame:
        cols = []
        for c in df.columns:
            if c in self.floats:
                cols.append(F.round(F.col(f"`{c}`").cast("double"), self.floats[c]).alias(c))
            elif c in self.ints:
                cols.append(F.col(c).cast("long").alias(c))
            elif c in self.dates:
                cols.append(F.col(c).cast("date").alias(c))
            else:
                cols.append(F.col(f"`{c}`"))
        return df.select(*cols)

    def oracle(self) -> str:
        body = self.sql.strip()
        sep = "\n" if body[:6].upper() == "SELECT" else ",\n"
        rep = [f"round({c}::DOUBLE,{n})+0.0::DOUBLE AS {c}" for c, n in self.floats.items()]
        rep += [f"{c}::BIGINT AS {c}" for c in self.ints] + [f"{c}::DATE AS {c}" for c in self.dates]
        inner = f"WITH {STAR_CTE.strip()}{sep}{body}"
        return f"SELECT * REPLACE ({', '.join(rep)}) FROM ({inner}) q" if rep else inner


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None, f: str = "", i: str = "", d: str = "", digits: int = 4):
    """Register ``build(star) -> DataFrame``; f/i/d list the double, integer and date columns of the result.

    ``name:2`` in ``f`` rounds that column to 2 digits (a value that ends in a 5 just behind the last digit).
    """
    floats = {c.partition(":")[0]: int(c.partition(":")[2] or digits) for c in f.split()}

    def add(build):
        assert name not in REGISTRY, name
        REGISTRY[name] = Query(name, build, sql, floats, tuple(i.split()), tuple(d.split()))
        return build
    return add
