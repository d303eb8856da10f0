"""The stored layout of the sales lines: month partitions, and buckets by client inside them.

A report of some months reads their partitions alone; an aggregate per client and a join with a client table of the same layout
need no shuffle, as every client lies in one bucket.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

BUCKETS = 16
KEY = "id_cliente"


def store_lines(lines: DataFrame, table: str, path: str, buckets: int = BUCKETS, date: str = "fecha_comprobante") -> DataFrame:
    """Writes the lines under ``path`` as the table ``table`` with ``mes`` (yyyy-MM) and returns it.  Rows are dealt to the tasks by
    their bucket first, so a month has one file a bucket."""
    dealt = lines.withColumn("mes", F.date_format(date, "yyyy-MM")).repartition(buckets, KEY)
    dealt.write.partitionBy("mes").bucketBy(buckets, KEY).sortBy(KEY).option("path", path).format("parquet").saveAsTable(table)
    return lines.sparkSession.table(table)


def store_clients(clients: DataFrame, table: str, path: str, buckets: int = BUCKETS) -> DataFrame:
    """The client table in the same buckets."""
    clients.repartition(buckets, KEY).write.bucketBy(buckets, KEY).sortBy(KEY).option("path", path).format("parquet").saveAsTable(table)
    return clients.sparkSession.table(table)


def buyers(lines: DataFrame, months: list[str], cut: list[str], measure: str = "cantidades_total") -> DataFrame:
    """Clients with a positive sum per cut in the months, from a stored table: partition filters, and no shuffle on the client."""
    per_client = lines.filter(F.col("mes").isin(months)).groupBy(KEY, *cut).agg(F.sum(measure).alias("_q")).filter("_q > 0")
    return per_client.groupBy(*cut).agg(F.count(F.lit(1)).alias("clientes"), F.sum("_q").alias("volumen"))


def drop(spark: SparkSession, *tables: str) -> None:
    """Forgets the tables' names; their files stay where they are."""
    for t in tables:
        spark.sql(f"DROP TABLE IF EXISTS {t}")
