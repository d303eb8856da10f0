from pyspark.sql import functions as F

from retail_analytics.llm import toxicity as tox

LEXICON = tox.Lexicon({"idiot": 1.0, "moron": 1.0, "perhaps": 0.3}, {"lowei": 1.0})


def score(text):
    return tox.document_features(text, LEXICON)[0]


def test_clauses_and_not_single_words():
    assert score("you are an idiot") > score("an idiot walked in") > score("you are not an idiot") > 0
    assert score("an idiot walked in") > score('he was said to be an idiot') > 0
    assert score("an idiot walked in") > score('it read "idiot" there') > 0
    assert score("not good. an idiot walked in") == score("an idiot walked in")           # a negation ends with its clause
    assert score("I will kill you") > 0 and score("the frost will kill them") > 0 and score("kill the process") == 0
    assert score("die loweischaft") > 0 and score("blowei und idiotie") == score("") == 0
    assert score("IDIOT!") == score("idiot!")


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    rows = tox.query(spark, sf).join(labels, "doc_id").where("held_out").collect()
    right = sum(r.predicted == r.toxic for r in rows)
    base = sum(r.toxic == 0 for r in rows)
    assert right >= 0.95 * len(rows) and right > base
    assert sum(r.predicted for r in rows if r.toxic == 0) == 0


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    turned = labels.withColumn("toxic", F.when(tox.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    known = [tox.toxicity(docs, x.where(~tox.held_out(F.col("doc_id")))).collect() for x in (labels, turned)]
    assert sorted(known[0]) == sorted(known[1])


def test_nulls_repeats_and_no_labels(spark):
    docs = spark.createDataFrame([(1, None, 0.1), (1, "", None), (1, "", None), (None, "you idiot " * 9, 0.2)], "doc_id long, text string, score double")
    for rows in ([], [(1, 0), (1, None), (None, 1)], [(1, 0), (2, 1)]):
        got = tox.toxicity(docs, spark.createDataFrame(rows, "doc_id long, toxic int")).collect()
        assert len(got) == 4 and all(0 <= r.score <= 1 for r in got)
    assert tox.toxicity(docs.limit(0), spark.createDataFrame([], "doc_id long, toxic int")).count() == 0


def test_copies_of_one_toxic_text_teach_nothing(spark):
    rows = [(f"rare{i % 7} word{i} the and of to {'x' * (i % 5)}", 0) for i in range(200)] + [("unlucky copy of some text again and again", 1)] * 60
    words, beginnings = tox.learn_lexicon(spark.createDataFrame(rows, "text string, toxic int"))
    assert not words and not beginnings
