"""Buyers per month as bitmaps: cohorts and retention by intersecting them."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from retail_analytics.functions.grid import shared
from retail_analytics.functions.ordered import running


def dense_numbers(ids: DataFrame, ident: str) -> DataFrame:
    """(ident, no): distinct ids numbered from 0 without gaps, so that bitmaps of them are full; no sort in one task."""
    one = ids.select(ident).distinct().withColumn("_one", F.lit(1))
    return running(one, ident, {"_no": "_one"}).select(ident, (F.col("_no") - 1).cast("long").alias("no"))


def buyer_bitmaps(buyers: DataFrame, numbers: DataFrame, ident: str, cut: list[str]) -> DataFrame:
    """(cut, cubeta, mapa): who bought per cut (a month, a branch and month), 32,768 clients to a bitmap.

    Bitmaps of several cuts are merged by ``bitmap_or_agg``: the state of a quarter comes from those of its months.
    """
    n = buyers.select(ident, *cut).distinct().join(numbers, ident)
    # one bucket is 32,768 numbers from 0 on
    return n.groupBy(*cut, (F.bitmap_bucket_number("no")).alias("cubeta")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("no")).alias("mapa"))


def cohort_counts(states: DataFrame, month: str = "mes") -> DataFrame:
    """(mes_cohorte, mes_n, clientes) from bitmaps per month alone; a cohort are the clients whose first month it is.

    With U(c) the buyers up to month c, those of cohort c that buy in m are |A(m) and U(c)| - |A(m) and U(c - 1)|, as U(c - 1) is a
    part of U(c).  U is a running OR inside each bucket; months are bounded by the calendar, so a bucket stays small.
    """
    upto = states.withColumn("hasta", F.bitmap_or_agg("mapa").over(W.partitionBy("cubeta").orderBy(month).rowsBetween(W.unboundedPreceding, 0)))
    upto = upto.select("cubeta", F.col(month).alias("_c"), "hasta")
    pairs = states.join(upto, "cubeta").filter(F.col("_c") <= F.col(month))
    both = (pairs.select("cubeta", month, "_c", F.explode(F.array("mapa", "hasta")).alias("m")).groupBy("cubeta", month, "_c")
            .agg(F.bitmap_count(F.bitmap_and_agg("m")).alias("_k")))
    # a bucket without buyers in month c has no U(c) of its own: its last one before counts, so the steps are taken inside the bucket
    step = F.col("_k") - F.coalesce(F.lag("_k").over(W.partitionBy("cubeta", month).orderBy("_c")), F.lit(0))
    n = (F.year(month) - F.year("_c")) * 12 + F.month(month) - F.month("_c")
    return (both.withColumn("_k", step).groupBy(F.col("_c").alias("mes_cohorte"), n.cast("long").alias("mes_n")).agg(F.sum("_k").alias("clientes"))
            .filter("clientes > 0"))


def retention_counts(lines: DataFrame, until: str, first_cohort: str) -> DataFrame:
    """:func:`cohort_counts` of invoiced lines; the cohort uses the whole history."""
    v = lines.filter((F.col("id_documento") == "FCVTA") & (F.col("fecha_comprobante") <= F.lit(until).cast("date")))
    buyers = shared(v.select("id_cliente", F.trunc("fecha_comprobante", "MM").alias("mes")).distinct())
    states = shared(buyer_bitmaps(buyers, dense_numbers(buyers, "id_cliente"), "id_cliente", ["mes"]))
    return cohort_counts(states).filter(F.col("mes_cohorte") >= F.lit(first_cohort).cast("date"))
