"""Materialised results and per-branch outputs."""
from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

def shared_dir(spark: SparkSession) -> str:
    """Folder every executor sees: ``spark.checkpoint.dir``.  Where it is unset a temporary folder serves a local session (tests);
    a cluster has to name one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir names no shared folder")
    return tempfile.mkdtemp(prefix="retail-")


def refresh(df: DataFrame, root: str) -> str:
    """Write a new version of a derived table next to the old one and return its path.

    Readers keep the version they opened; the caller moves its pointer (catalog location, view) to the new path.
    """
    path = f"{root}/v-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return path


def publish_view(spark: SparkSession, name: str, path: str) -> None:
    """Point the readers' view to a finished version."""
    spark.read.parquet(path).createOrReplaceTempView(name)


def split_output(df: DataFrame, key: str, path: str, files_per_key: int = 4, max_records_per_file: int = 5_000_000) -> str:
    """One folder per value of ``key``, in a few files: rows go to (key, salt), so a hot branch is not one task."""
    salted = df.repartition(F.col(key), F.pmod(F.xxhash64(*df.columns), F.lit(files_per_key)))
    salted.write.mode("errorifexists").option("maxRecordsPerFile", max_records_per_file).partitionBy(key).parquet(path)
    return path
