"""Monthly tables that are refreshed by the months whose source files changed.

A source is a table partitioned by month.  Its state is a checksum of file names, lengths and times per month, taken from the
file listing: no row is read for it.  A refresh compares it with the state of the last snapshot, computes only the months that
differ, writes each as a new version and publishes a snapshot (month, state, version).  Versions are never overwritten, so a
reader keeps the files that its snapshot named while a refresh runs, and a refresh that dies leaves no trace in what readers see.
"""
from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

SNAPSHOT = "mes string, estado long, archivos long, version string"


def month_state(spark: SparkSession, path: str) -> DataFrame:
    """(mes, estado, archivos) of a table partitioned by ``mes``: an order-free checksum of its files, from the listing alone."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    mark = F.xxhash64(F.element_at(F.split("path", "/"), -1), "length", "modificationTime")
    month = F.regexp_extract("path", "/mes=([^/]+)/", 1)
    # only the columns of the listing are asked for, so the files' contents stay unread
    return files.groupBy(month.alias("mes")).agg(F.bit_xor(mark).alias("estado"), F.count(F.lit(1)).alias("archivos"))


class MonthlyTable:
    """The table ``build(rows of some months)`` under ``root``; ``build`` has to keep the column ``mes`` (string, yyyy-MM)."""

    def __init__(self, spark: SparkSession, root: str, build: Callable[[DataFrame], DataFrame]):
        self.spark, self.root, self.build = spark, root.rstrip("/"), build

    def _snapshots(self) -> list[str]:
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(f"{self.root}/snapshots")
        fs = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(folder):
            return []
        done = [str(x.getPath()) for x in fs.listStatus(folder) if fs.exists(jvm.org.apache.hadoop.fs.Path(x.getPath(), "_SUCCESS"))]
        return sorted(done)

    def snapshot(self) -> DataFrame:
        """(mes, estado, archivos, version) as last published; empty before the first refresh."""
        done = self._snapshots()
        return self.spark.read.schema(SNAPSHOT).parquet(done[-1]) if done else self.spark.createDataFrame([], SNAPSHOT)

    def refresh(self, source: str) -> list[str]:
        """Computes the months of ``source`` that changed since the last snapshot; returns them.  Months that left the source
        leave the table."""
        now = month_state(self.spark, source)
        old = self.snapshot().withColumnsRenamed({"estado": "_e", "archivos": "_a"})
        # months are few: their list passes the driver
        rows = now.join(old, "mes", "full").collect()
        changed = sorted(r["mes"] for r in rows if r["estado"] is not None and (r["estado"], r["archivos"]) != (r["_e"], r["_a"]))
        gone = [r["mes"] for r in rows if r["estado"] is None]
        if not changed and not gone:
            return []
        version = uuid.uuid4().hex
        if changed:
            part = self.spark.read.option("basePath", source).option("spark.sql.sources.partitionColumnTypeInference.enabled", "false").parquet(*[f"{source}/mes={m}" for m in changed])
            out = self.build(part.withColumn("mes", F.col("mes").cast("string")))
            out.write.partitionBy("mes").parquet(f"{self.root}/data/{version}")
        kept = [(r["mes"], r["estado"], r["archivos"], version if r["mes"] in changed else r["version"]) for r in rows if r["estado"] is not None]
        number = len(self._snapshots())
        # two refreshes at once: the second finds the number taken and fails
        self.spark.createDataFrame(kept, SNAPSHOT).coalesce(1).write.mode("errorifexists").parquet(f"{self.root}/snapshots/{number:09d}")
        return changed

    def read(self, schema: str | None = None) -> DataFrame:
        """The table of the last snapshot."""
        rows = self.snapshot().collect()
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        out = None
        for version in sorted({r["version"] for r in rows}):
            base = f"{self.root}/data/{version}"
            fs = jvm.org.apache.hadoop.fs.Path(base).getFileSystem(conf)
            paths = [f"{base}/mes={r['mes']}" for r in rows if r["version"] == version]
            paths = [p for p in paths if fs.exists(jvm.org.apache.hadoop.fs.Path(p))]          # a month may have built no rows
            if paths:
                part = self.spark.read.option("basePath", base).parquet(*paths)
                part = part.withColumn("mes", F.date_format(F.to_date(F.col("mes").cast("string")), "yyyy-MM") if part.schema["mes"].dataType.simpleString() == "date" else F.col("mes").cast("string"))
                out = part if out is None else out.unionByName(part)
        if out is None:
            raise ValueError("no month has been built")
        return out
