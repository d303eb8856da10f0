"""Order-free checksums of keyed frames by key range, as a tree of two levels."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

RANGES, FAN = 4096, 64


def range_sums(df: DataFrame, keys: list[str], ranges: int = RANGES) -> DataFrame:
    """(_range, _n, _x, _s): rows of each hash range of the keys, the exclusive or of their hashes and the sum of other hashes, so that
    neither order nor pairs of equal rows matter.  One scan of partial aggregates, ``ranges`` rows at most."""
    row = [F.col(c) for c in df.columns]
    return (df.groupBy(F.pmod(F.xxhash64(*keys), F.lit(ranges)).cast("int").alias("_range"))
            .agg(F.count(F.lit(1)).alias("_n"), F.bit_xor(F.xxhash64(*row)).alias("_x"), F.sum(F.pmod(F.xxhash64(F.lit(1), *row), F.lit(1 << 31))).alias("_s")))


def differing_ranges(a: DataFrame, b: DataFrame, keys: list[str], ranges: int = RANGES) -> DataFrame:
    """The key ranges (column ``_range``) in which the two frames hold different rows.  Both trees are compared from their upper
    nodes (``FAN`` ranges each) down; equal upper nodes are not descended."""
    leaves = range_sums(a, keys, ranges).withColumn("_side", F.lit(0)).unionByName(range_sums(b, keys, ranges).withColumn("_side", F.lit(1)))

    def unequal(level: DataFrame, node: str) -> DataFrame:
        def side(i: int):
            return F.max(F.when(F.col("_side") == i, F.struct("_n", "_x", "_s")))
        return level.groupBy(node).agg(side(0).alias("_a"), side(1).alias("_b")).filter(~F.col("_a").eqNullSafe(F.col("_b"))).select(node)

    leaves = leaves.withColumn("_node", F.expr(f"_range div {FAN}"))
    upper = leaves.groupBy("_node", "_side").agg(F.sum("_n").alias("_n"), F.bit_xor("_x").alias("_x"), F.sum("_s").alias("_s"))
    # both lists are bounded by the number of ranges
    return unequal(leaves.join(F.broadcast(unequal(upper, "_node")), "_node", "left_semi"), "_range")


def only_ranges(df: DataFrame, keys: list[str], found: DataFrame, ranges: int = RANGES) -> DataFrame:
    """The rows whose key lies in one of the ranges ``found`` (at most ``ranges`` rows, broadcast)."""
    return df.join(F.broadcast(found), F.pmod(F.xxhash64(*keys), F.lit(ranges)) == F.col("_range"), "left_semi")
