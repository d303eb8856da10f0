"""Jaccard join, substring dedup and decontamination against brute force."""
import random

import pytest
from pyspark.sql import functions as F

from brute import components, contamination, dedup
from retail_analytics.llm import decontaminate, jaccard_join, substring_dedup

SF = "/root/testdata/sf0.001"


def copies(seed=5, n=300):
    rnd = random.Random(seed)
    base = [[rnd.choice("abcdefghijklmnop") + str(rnd.randint(0, 99)) for _ in range(rnd.randint(1, 60))] for _ in range(25)]
    rows = []
    for i in range(n):
        w = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 0, 1, 1, 2, 3])):
            w[rnd.randrange(len(w))] = rnd.choice(["X", "y", "zz"]) + str(rnd.randint(0, 5))
        rows.append((i, rnd.choice([" ", "\n", " \t"]).join(w) if rnd.random() > .03 else rnd.choice([None, "", "  "])))
    return rows


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, n_words string, component_id int").repartition(4)


@pytest.mark.parametrize("k,percent", [(3, 90), (1, 70), (5, 80)])
def test_components(spark, k, percent):
    rows = copies()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_join(docs_of(spark, rows), k, percent).collect()}
    assert got == components(rows, k, percent)


def test_one_large_group_and_a_shared_passage(spark):
    rnd = random.Random(1)
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(base[:150] + [f"u{i}"] + base[150:])) for i in range(150)]                      # near copies
    rows += [(200 + i, " ".join([f"v{rnd.randint(0, 10**6)}" for _ in range(80)] + base[:30])) for i in range(60)]    # a passage alone
    rows += [(400 + i, "same text of few words") for i in range(50)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_join(docs_of(spark, rows)).collect()}
    assert got == components(rows, 3, 90)


def test_components_of_repeated_and_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(5, text), (5, text), (5, "another text"), (3, "another text"), (None, text), (9, text + " end"), (None, None)]
    got = sorted(((r.doc_id or -1, r.component_id) for r in jaccard_join.jaccard_join(docs_of(spark, rows)).collect()), key=str)
    assert got == sorted([(5, 5), (5, 5), (5, 3), (3, 3), (-1, 5), (9, 5), (-1, None)], key=str)


def test_dedup(spark):
    rnd = random.Random(9)
    passages = [[f"p{k}_{rnd.randint(0, 30)}" for _ in range(rnd.randint(15, 70))] for k in range(8)]
    rows = []
    for i in range(120):
        w = [f"u{rnd.randint(0, 10**6)}" for _ in range(rnd.randint(0, 30))]
        for _ in range(rnd.randint(0, 4)):
            p = rnd.choice(passages)
            a = rnd.randint(0, len(p) - 1)
            w += p[a:rnd.randint(a, len(p))] * rnd.choice([1, 1, 2]) + [f"u{rnd.randint(0, 9)}"]
        rows.append((i, rnd.choice([" ", "\n", "  ", " \x0b"]).join(w)))
    rows += [(500, None), (501, ""), (502, "very " * 400), (503, rows[5][1]), (504, "é " * 25), (505, "é " * 25)]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substring_dedup.substring_dedup(docs_of(spark, rows), shard_bytes=4000).collect()}
    assert got == dedup(rows)


def test_dedup_of_repeated_and_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(2, text), (2, text), (None, text), (1, "short")]
    got = sorted((r.doc_id or -1, r.n_removed) for r in substring_dedup.substring_dedup(docs_of(spark, rows)).collect())
    assert got == [(-1, 30), (1, 0), (2, 0), (2, 0)]


def test_decontamination(spark):
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(40)] + ["É", "é", "x9"]
    items = [(i, " ".join(rnd.choices(words, k=rnd.randint(1, 25)))) for i in range(30)] + [(30, None), (31, " .,"), (32, "É w1"), (33, "one")]
    rows = []
    for i in range(100):
        w = rnd.choices(words, k=rnd.randint(0, 30))
        for _ in range(rnd.randint(0, 2)):
            w += (rnd.choice(items)[1] or "").upper().split() + rnd.choices(words, k=3)
        rows.append((i, rnd.choice([" ", ", ", "\n--"]).join(w)))
    rows += [(200, None), (201, ""), (202, ",".join(["W1"] * 5000)), (203, "é w1 x")]
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, words int")
    for most in (1000, 0):                     # the windows broadcast, and shuffled
        out = decontaminate.decontaminate(docs_of(spark, rows), bench, max_broadcast_windows=most)
        got = {r.doc_id: (r.n_words, r.n_hit, sorted(map(str, r.items))) for r in out.collect()}
        assert got == contamination(rows, items)


def test_decontamination_of_repeated_and_null_ids(spark):
    bench = spark.createDataFrame([(7, "a b c d")], "item_id long, text string")
    rows = [(1, "x a b c d"), (1, "nothing"), (1, "nothing"), (None, "a b c d e"), (None, None)]
    got = sorted((r.doc_id or -1, r.n_words, r.n_hit) for r in decontaminate.decontaminate(docs_of(spark, rows), bench).collect())
    assert got == [(-1, 0, 0), (-1, 5, 4), (1, 1, 0), (1, 1, 0), (1, 5, 4)]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    assert jaccard_join.jaccard_join(none).count() == substring_dedup.substring_dedup(none).count() == 0
    assert decontaminate.decontaminate(none, items).count() == 0
    some = docs_of(spark, [(1, "a b")])
    assert [(r.n_words, r.n_hit) for r in decontaminate.decontaminate(some, items).collect()] == [(2, 0)]


def test_native_decontamination_has_no_python(spark):
    plan = decontaminate.query(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoop"))


def test_queries_on_the_small_tables(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.query(spark, SF).collect()}
    assert got == components(docs, 3, 90)
    out = substring_dedup.query(spark, SF)
    assert out.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert {r.doc_id: (r.n_words, r.n_removed) for r in out.collect()} == {i: x[:2] for i, x in dedup(docs).items()}
    assert spark.range(1).select(F.sha2(F.lit(""), 256)).first()[0].startswith("e3b0c442")


def test_parity_bitmaps_differ_in_no_more_bits_than_sets_in_tokens():
    import numpy as np
    rnd = np.random.default_rng(4)
    for n, changed in ((1, 1), (60, 5), (300, 90), (4000, 2500)):
        a = rnd.integers(1, 1 << 63, n, dtype=np.int64).astype(np.uint64)
        b = np.concatenate([a[changed:], rnd.integers(1, 1 << 63, changed // 2, dtype=np.int64).astype(np.uint64)])
        apart = sum(bin((x ^ y) & (1 << 64) - 1).count("1") for x, y in zip(jaccard_join.parity(np.unique(a)), jaccard_join.parity(np.unique(b))))
        assert apart <= len(set(a.tolist()) ^ set(b.tolist())) and (n > 300 or apart > 0)


def test_a_group_of_borderline_copies(spark):
    """Near copies of one text of which many pairs are just below the limit: the links and no others."""
    rnd = random.Random(12)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rnd.randint(1, 5)):
            w[rnd.randrange(len(w))] = f"x{rnd.randint(0, 10**6)}"
        rows.append((i, " ".join(w)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_join(docs_of(spark, rows), 5, 80).collect()}
    assert got == components(rows, 5, 80)


def test_jaccard_join_broadcasts_no_table(spark, monkeypatch):
    """Small sides of joins are merged too: every broadcast would be collected and hashed in the driver."""
    plans, real = [], jaccard_join.cut

    def seen(df):
        out = real(df)
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return out
    monkeypatch.setattr(jaccard_join, "cut", seen)
    rows = copies()
    found = jaccard_join.jaccard_join(docs_of(spark, rows))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()}
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert got == components(rows, 3, 90)
    assert any("SortMergeJoin" in p for p in plans) and not any("Broadcast" in p for p in plans)


def test_filter_passes_the_driver_compressed(spark):
    """The driver holds the pieces of a filter, not its 2**28 bits; a task has the whole array, with each hash met twice."""
    import os

    import numpy as np
    from retail_analytics.llm import common
    values = common._mix(np.arange(1, 2001, dtype=np.uint64))
    twice = values[:700]

    def emit(batches):
        for _ in batches:
            yield from common.blob_batches(iter([np.concatenate([values, twice])]))
    blobs = spark.range(1, numPartitions=1).mapInArrow(emit, common.BLOB_SCHEMA)
    shared = common.bitmap(blobs, 2, bits=28, levels=True)
    assert os.path.getsize(shared._path) < 1 << 20          # what the driver hands out
    mask, levels = shared.value
    want = np.zeros(1 << 25, np.uint8)
    common._set(want, (twice >> np.uint64(36)).astype(np.int64))
    assert (mask == want).all() and common.among(mask, twice).all() and common.among(mask, values).sum() == 700
    assert len(levels) == 1 << 21 and (common.level(levels, values) > 0).all() and np.count_nonzero(levels) <= 2000
    shared.destroy()
