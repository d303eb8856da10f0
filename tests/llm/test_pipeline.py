"""The pipeline's stages, each against a brute-force version of what it keeps."""
import hashlib

import tiktoken

import corpus_pipeline as cp
import public_tokenizers
from brute import base_counts, components, contamination, dedup
from retail_analytics.llm import bpe

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumnRenamed("source", "kept")        # a clashing extra column
    columns, before = docs.columns, rows_of(docs)
    for name, stage in cp.STAGES[:-1]:
        docs = cp.cut(stage(spark, docs, SF))
        after = rows_of(docs)
        assert docs.columns == columns and set(after) <= set(before)
        texts = [(i, r.text) for i, r in before.items()]
        if name == "quality_rules":
            base = {i: base_counts(t) for i, t in texts}
            fine = {i for i, b in base.items() if b[0] >= 50 and 100 * b[4] <= 50 * b[0]}
            assert set(after) <= fine and len(after) >= 0.9 * len(fine)
        elif name == "near_duplicates":
            assert set(after) == {i for i, (_, c) in components(texts, 5, 80).items() if c == i}
        elif name == "repeated_passages":
            assert {i: r.text for i, r in after.items()} == {i: x[2] for i, x in dedup(texts).items()}
            assert all(r.n_chars == len(r.text) for r in after.values())
        else:
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            assert set(after) == {i for i, x in contamination(texts, items).items() if not x[1]}
        before = after
    out = rows_of(cp.STAGES[-1][1](spark, docs, SF))
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                              mergeable_ranks=bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))["ranks"])
    assert set(out) == set(before)
    for i, r in out.items():
        ids = coder.encode_ordinary(before[i].text)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(before[i].text.encode()).hexdigest()
    assert sorted(r.doc_id for r in cp.run(spark, SF).collect()) == sorted(r.doc_id for r in cp.byte_bpe(spark, _chain(spark), SF).collect())


def _chain(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in cp.STAGES[:-1]:
        docs = cp.cut(stage(spark, docs, SF))
    return docs


def test_rows_are_judged_by_their_own_text(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    item = max((r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()), key=len)
    words = [f"{c}{k}" for c in "abcdefgh" for k in range(60)]
    text = [" ".join(words[60 * i:60 * i + 60]) for i in range(8)]
    a, b, c, d, e = text[:5]

    def kept(stage, rows):
        df = spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in rows], docs.schema).repartition(3)
        return sorted(((r.doc_id, r.text, r.source) for r in stage(spark, df, SF).collect()), key=str)

    rows = [(5, a, "y"), (5, b, "x"), (3, b, "x"), (9, f"{a} z", "x"), (5, c, "x"), (5, a, "x"), (5, a, "y"), (None, b, "x"), (None, d, "x"), (None, d, "x"),
            (None, f"{d} z", "x"), (7, f"{e} z", "x"), (None, e, "x"), (8, "", "x"), (8, "", "x")]
    got = kept(cp.near_duplicates, rows)
    assert [r for r in got if r[0] is not None] == [(3, b, "x"), (5, a, "x"), (5, c, "x"), (7, f"{e} z", "x"), (8, "", "x"), (8, "", "x")]
    assert [r[1] in (d, f"{d} z") for r in got if r[0] is None] == [True]
    rows = [(5, a, "x"), (5, f"{b} {item}", "x"), (None, c, "x"), (None, f"{d} {item}", "x"), (6, e, "x")]
    assert kept(cp.decontamination, rows) == sorted([(5, a, "x"), (6, e, "x"), (None, c, "x")], key=str)


def test_nulls_and_empty_tables(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    for rows in ([], [(None,) * 5, (1, None, None, None, None), (1, "", "en", "s", 0), (2, "a b", None, None, None)]):
        docs = spark.createDataFrame(rows, schema)
        for _, stage in cp.STAGES[:-1]:
            assert stage(spark, docs, SF).count() <= len(rows)
            assert stage(spark, docs, SF).columns == docs.columns
        assert cp.byte_bpe(spark, docs, SF).count() == len(rows)
