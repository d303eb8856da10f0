"""Compare registered Spark queries with their DuckDB oracle: ``python tests/oracle.py [sf_dir] [prefix ...]``."""
from __future__ import annotations

import datetime
import logging
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

logging.disable(logging.CRITICAL)
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def session() -> SparkSession:
    spark = (SparkSession.builder.master("local[8]").appName("retail_analytics_tests")
             .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
             .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "8g")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return str(v)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return [names[k] for k in order], sorted(tuple(_cell(r[k]) for k in order) for r in data)


def compare(spark, con, q, sf_dir) -> str | None:
    """None when equal, else a short account of the difference."""
    df = q.run(spark, sf_dir)
    a_cols, a = rows(df.columns, [tuple(r) for r in df.collect()])
    if q.sql is None:
        return None if a_cols else "no columns"
    rel = con.sql(q.oracle())
    b_cols, b = rows(rel.columns, rel.fetchall())
    if a_cols != b_cols:
        return f"columns {a_cols} vs {b_cols}"
    kinds = dict(zip(rel.columns, [str(t) for t in rel.types]))
    for fld in df.schema.fields:
        s, o = fld.dataType.simpleString(), kinds[fld.name]
        ok = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN",
              "int": "INTEGER"}.get(s)
        if ok != o:
            return f"type of {fld.name}: {s} vs {o}"
    if a != b:
        only_a, only_b = sorted(set(a) - set(b)), sorted(set(b) - set(a))
        return f"rows {len(a)} vs {len(b)}; {a_cols}\n  spark {only_a[:3]}\n  duck  {only_b[:3]}"
    return None if a else "empty result"


if __name__ == "__main__":
    from retail_analytics.plans import load_all

    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark, con, bad = session(), duck(sf), 0
    for name, q in load_all().items():
        if args and not any(name.startswith(p) for p in args):
            continue
        t = time.time()
        try:
            msg = compare(spark, con, q, sf)
        except Exception as e:  # report and go on with the next query
            msg = f"{type(e).__name__}: {str(e)[:400]}"
        if msg:
            bad += 1
        print(f"{'FAIL' if msg else 'ok  '} {name} {time.time() - t:.1f}s {msg or ''}", flush=True)
    print("failures:", bad)
    sys.exit(bool(bad))
