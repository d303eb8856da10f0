"""The manifest's digests, proofs and folded roots against brute force and DuckDB."""
import random

import pytest
from pyspark.sql import functions as F

from brute import merkle as brute
from oracle import duck, rows
from retail_analytics.llm import merkle

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, source string, lang string, n_chars int, text string"
COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def found(spark, data):
    df = spark.createDataFrame([(*r, "x", 1) for r in data], SCHEMA + ", leaf string, idx int").repartition(3)      # clashing extra columns
    return sorted(map(str, map(tuple, merkle.verified(merkle.leaf_rows(df)).select(COLUMNS).collect())))


def expect(data):
    return sorted(map(str, brute(data)))


@pytest.mark.parametrize("sizes", [[1], [9], [1, 8, 9, 65, 1, 7, 64, 2, 600]])
def test_sizes(spark, sizes):
    data = [(i, "s", f"l{k}", i, f"Text {i}") for k, n in enumerate(sizes) for i in range(n)]
    assert found(spark, data) == expect(data)


def test_nulls_ties_and_long_texts(spark):
    rnd = random.Random(4)
    data = [(None, None, None, None, None), (None, None, None, None, ""), (3, "", "", 0, ""), (3, "s", "", 0, "Ä"), (3, "s", "en", 1, "A" * 3_000_000), (2**40, "é", "Zh", -5, "ÀB")]
    data += [(rnd.choice([None, 7, 8]), "s", rnd.choice([None, "en"]), 1, rnd.choice("ABC")) for _ in range(300)]       # repeated rows and ids
    data += [(5, "s", "hot", 1, "same")] * 400
    assert found(spark, data) == expect(data)
    assert found(spark, []) == []


def test_a_leaf_with_a_wrong_claim_alone_fails(spark):
    data = [(i, "s", "en", i, f"Text {i}") for i in range(100)]
    leaves = merkle.leaf_rows(spark.createDataFrame(data, SCHEMA)).withColumn("claim", F.when(F.col("doc_id") == 40, F.unhex(F.sha2(F.lit("x"), 256))).otherwise(F.col("leaf")))
    assert [r.doc_id for r in merkle.verified(leaves).where("not verified").collect()] == [40]


def test_stored_copies_bound_the_leaves_of_a_node(spark, monkeypatch):
    monkeypatch.setattr(merkle, "SPREAD", 8)
    data = [(i, "s", "en" if i % 3 else "de", i, f"Text {i}") for i in range(600)]
    assert found(spark, data) == expect(data)


def test_the_callers_session_stays_as_it_is(spark):
    before = dict(spark.conf.getAll.items())
    merkle.query(spark, SF).count()
    assert dict(spark.conf.getAll.items()) == before


def test_matches_duckdb(spark):
    got, want = merkle.query(spark, SF), duck(SF).sql(merkle.sql())
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(want.columns, want.fetchall())
