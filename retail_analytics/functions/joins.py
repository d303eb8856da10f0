"""Small join helpers."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from retail_analytics.functions.skew import fits_broadcast

UNPACKED = 32        # rows in memory against their compressed file, where texts repeat (31 estimated for the SKU attributes)
WHOLE_FILE = 2       # the same for two columns that count as large as their whole file, before orders
BEFORE_LINES = 8     # the same where the other side would be the sales lines: some 50 MB are broadcast before they are shuffled


def join_catalogue(left: DataFrame, catalogue: DataFrame, keys: str | list[str], how: str = "inner", unpacked: int = UNPACKED) -> DataFrame:
    """``left.join(catalogue, keys, how)`` with a table that grows with the business (SKUs, prices).

    Spark knows the size of a compressed file, not that of the rows the driver would have to hold for a broadcast.  From the
    size on where the rows may be too large, both sides are shuffled.
    """
    return left.join(catalogue if fits_broadcast(catalogue, unpacked) else catalogue.hint("merge"), keys, how)


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join where NULL keys match each other; the keys of the left side are kept.

    The keys travel as one struct: a struct is never NULL itself and its fields compare NULL-safe, so the join
    stays a plain equi-join on one hash key.
    """
    if not keys:
        raise ValueError("keys needed")
    r = right.withColumn("_rk", F.struct(*keys)).drop(*keys)
    return left.join(r, F.struct(*keys) == F.col("_rk"), how).drop("_rk")
