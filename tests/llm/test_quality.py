import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from brute import base_counts
from retail_analytics.llm import quality as q

SF = "/root/testdata/sf0.001"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def kneser_ney(words, order):
    """Interpolated modified Kneser-Ney over dictionaries: {gram: probability of its last character}."""
    levels = {order: Counter()}
    for w, n in words.items():
        p = q.START * (order - 1) + w + q.END
        for i in range(len(w) + 1):
            levels[order][p[i:i + order]] += n
    for m in range(order - 1, 0, -1):
        levels[m] = Counter(g[1:] for g in levels[m + 1])
    probability = {}
    for m in range(1, order + 1):
        c, cc = levels[m], Counter(levels[m].values())
        y = cc[1] / (cc[1] + 2 * cc[2]) if cc[1] + 2 * cc[2] else None
        d = {}
        for i in (1, 2, 3):
            v = i - (i + 1) * y * cc[i + 1] / cc[i] if y is not None and cc[i] and cc[i + 1] else 0.5 * i
            d[i] = max(0.1, min(i - 0.1, v))
        total, off = Counter(), Counter()
        for g, n in c.items():
            total[g[:-1]] += n
            off[g[:-1]] += d[min(n, 3)]
        for g, n in c.items():
            lower = probability[g[1:]] if m > 1 else 1 / (len(c) + 1)
            probability[g] = (n - d[min(n, 3)]) / total[g[:-1]] + off[g[:-1]] / total[g[:-1]] * lower
    return levels[order], probability


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, lang string, log_ppl double").repartition(3)


def test_base_counts(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, " \n\t ", None), (4, "a b c a b c a\nx\nx\n\nx \n<b> #1 | 100%", "en"), (5, "é ü\x0bß x\x85y", "de"),
            (6, "w " * 30000, "fr"), (7, "a b c d\na b c d\n" * 40, "en"), (None, "z z z z", None), (7, "a b c", "en"), (7, "a b c", "en")]
    out = q.quality(docs_of(spark, rows)).collect()
    got = Counter((r.doc_id, *(r[c] for c in BASE), r.base_failed) for r in out)
    assert got == Counter((i, *(b := base_counts(t)), b[0] < 50 or 100 * b[4] > 50 * b[0]) for i, t, _ in rows)
    assert all(not r.kept for r in out if r.base_failed)


def test_model_against_dictionaries(spark):
    rows = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    out = {r.doc_id: r for r in q.quality(docs_of(spark, rows)).collect()}
    for lang in ("de", "es"):
        own = [(i, t.split(" ")) for i, t, x in rows if x == lang]
        words = Counter(w for i, _ in own for w in dict((a, b) for a, b, _ in rows)[i].encode().split())
        _, p = kneser_ney({w.decode(): n for w, n in words.items()}, q.ORDER)
        for i, _ in own:
            text = dict((a, b) for a, b, _ in rows)[i].encode().split()
            if text:
                total = 0.0
                for w in text:
                    x = q.START * (q.ORDER - 1) + w.decode() + q.END
                    total += sum(math.log(p[x[k:k + q.ORDER]]) for k in range(len(w.decode()) + 1))
                assert abs(out[i].log_ppl + total / len(text)) < 1e-3


def test_probabilities_add_up(spark):
    words = spark.createDataFrame([("en", f"{w} " * n) for w, n in (("the", 9), ("then", 3), ("hat", 2), ("that", 4), ("net", 1), ("ten", 1))], "lang string, text string")
    table = q.cut(q.kneser_ney(q.cut(q.gram_counts(words, 3)), 3))
    model = q.Model(q.Model.pack(table, 3), 3)
    letters = sorted({c for r in table.where("m = 1 and logp is not null").collect() for c in r.gram})
    unseen = "\x7f"                                              # the model leaves one share for a character it has not seen
    for context in ("th", "he", "zz", q.START * 2):
        rows = np.array([[ord(c) for c in context + x] for x in [*letters, unseen]])
        assert abs(np.exp(model.logp(rows, "en", 3)).sum() - 1) < 1e-4


def test_odd_spelling_is_rejected_and_prose_kept(spark):
    rows = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SF}/documents.parquet").where("lang = 'en'").collect()]
    junk = [(5000 + i, " ".join(f"{w[::-1]}{'#$%&'[k % 4] * 3}xq{k * 7919 % 997}zj" for k, w in enumerate(t.split()[:200])), "en")
            for i, t, _ in rows[:8] if len(t.split()) >= 120]
    out = {r.doc_id: r for r in q.quality(docs_of(spark, rows + junk)).collect()}
    passed = [r for i, r in out.items() if i < 5000 and not r.base_failed]
    assert junk and not any(out[i].kept for i, _, _ in junk)
    assert sum(r.kept for r in passed) >= 0.95 * len(passed)


def test_joined_model_gives_the_same(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    rows = docs.select("doc_id", "text", "lang").unionByName(spark.createDataFrame([(None, "a b", None), (900, None, None)], "doc_id long, text string, lang string"))
    got = [{r.doc_id: (r.kept, None if r.log_ppl is None else round(r.log_ppl, 3)) for r in q.quality(rows, max_grams=m).collect()} for m in (10**9, 0)]
    assert got[0] == got[1]


def test_joined_model_with_repeated_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60).select("doc_id", "text", "lang")
    few = docs.orderBy("doc_id").limit(6)
    rows = docs.union(few).union(few).union(few.withColumn("lang", F.lit("xx"))).union(few.withColumn("lang", F.lit(None).cast("string")))
    null_ids = few.withColumn("doc_id", F.lit(None).cast("long"))
    rows = q.cut(rows.union(null_ids).union(null_ids))
    got = [Counter((r.doc_id, r.text_hash, r.lang, r.kept, None if r.log_ppl is None else round(r.log_ppl, 3)) for r in q.quality(rows, max_grams=m).collect())
           for m in (10**9, 0)]
    assert got[0] == got[1] and max(got[0].values()) == 3


def test_empty_table(spark):
    assert q.quality(spark.createDataFrame([], "doc_id long, text string, lang string")).count() == 0
    assert q.quality(spark.createDataFrame([(1, None, None)], "doc_id long, text string, lang string")).select(F.col("kept")).first()[0] is False
