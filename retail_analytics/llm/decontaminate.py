"""Benchmark decontamination: a prefix-filtered set join, DataFrame functions only.

A window of an item occurs in a document only if all its shingles do (containment 1), so by the prefix principle its single
rarest shingle is the necessary prefix.  Shingles are ordered by their number of occurrences in all documents.  Documents meet
windows on that shingle, the length and position bounds place the window, and the words are compared exactly.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import cut, pick

WINDOW, SHINGLE = 10, 3
MAX_BROADCAST_WINDOWS = 200_000       # at most so many windows are broadcast (about 300 bytes each); more are shuffled
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text once A-Z is lower-cased, in the text's own case."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), "")


def _lower(words: Column) -> Column:
    return F.transform(words, lambda w: F.translate(w, UPPER, LOWER))


def _shingles(df: DataFrame, words: str, k: int, *keep: str) -> DataFrame:
    """Rows (keep, at, key) for each run of k words; ``lower`` folds more than A-Z, which the exact comparison makes good."""
    own = F.col(words)
    sides = [F.slice(own, i + 1, F.size(own)).alias(f"w{i}") for i in range(k)]
    runs = F.slice(F.arrays_zip(*sides), F.lit(1), F.greatest(F.size(own) - (k - 1), F.lit(0)))
    return (df.select(*keep, F.posexplode(runs).alias("at", "run"))
            .select(*keep, "at", F.xxhash64(F.lit(k), *(F.lower(F.col("run")[f"w{i}"]) for i in range(k))).alias("key")))


def item_windows(benchmark: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """Distinct windows (win array, joined text, n words, items): all runs of ``window`` words of an item, the whole item if it has fewer."""
    own = pick(benchmark, item_id=id_col, text=text_col).select("item_id", _lower(words_of(F.col("text"))).alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (window - 1), F.lit(1)))
    return (own.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("words", i, window))).alias("win"))
            .groupBy("win").agg(F.collect_set("item_id").alias("items")).withColumn("n", F.size("win")).withColumn("joined", F.array_join("win", " ")))


def _shuffled_hits(source: DataFrame, windows: DataFrame, k: int) -> DataFrame:
    """(doc_id, sha, start, n, items) of the windows' verified places, when there are too many windows to broadcast.  What is shuffled
    for each shingle is its key, place and document; the words of a document with candidates travel once."""
    row = F.struct("doc_id", "sha").alias("row")
    start = F.col("at") - F.col("offset") + 1
    near = (_shingles(source.withColumn("n_words", F.size("words")), "words", k, "doc_id", "sha", "n_words").join(windows, "key")
            .where((start >= 1) & (start + F.col("n") - 1 <= F.col("n_words"))).select(row, start.alias("start"), "n", "joined", "items"))
    near = cut(near)
    texts = source.select(row, "words").join(near.select(F.col("row").alias("its")).distinct(), F.col("row") == F.col("its"), "left_semi").dropDuplicates(["row"])
    place = F.translate(F.array_join(F.slice("words", F.col("start"), F.col("n")), " "), UPPER, LOWER)
    return (near.join(texts.withColumnRenamed("row", "its"), F.col("row") == F.col("its")).where(place == F.col("joined"))
            .select("row.doc_id", "row.sha", "start", "n", "items"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, id_col: str = "doc_id",
                  text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
                  max_broadcast_windows: int = MAX_BROADCAST_WINDOWS) -> DataFrame:
    """One row per document: doc_id, n_words, spans (array of struct(start, n): word ranges of occurring windows, from 1),
    n_hit (words inside them), items (array of item ids with an occurring window).

    A null or empty text has no words and no spans; an item without words matches nothing; items that repeat or share windows
    all count; repeated rows stay; with an empty benchmark nothing is hit; other columns are dropped.
    """
    sha = F.xxhash64("text").alias("sha")                 # tells apart rows that share a doc_id
    source = pick(docs, doc_id=id_col, text=text_col).select("doc_id", sha, words_of(F.col("text")).alias("words"))
    windows = item_windows(benchmark, window, item_id_col, item_text_col)
    sizes = {r["n"]: r["count"] for r in windows.groupBy("n").count().collect()}      # at most ``window`` rows
    near = F.broadcast if sum(sizes.values()) <= max_broadcast_windows else (lambda df: df)

    found = []
    for k in sorted({min(shingle, n) for n in sizes}):
        some = windows.where(F.col("n") >= shingle) if k == shingle else windows.where(F.col("n") == k)
        own = _shingles(some, "win", k, "joined", "n", "items")
        seen = _shingles(source, "words", k).join(near(own.select("key").distinct()), "key", "left_semi").groupBy("key").agg(F.count("*").alias("df"))
        rarest = (own.join(seen, "key").groupBy("joined", "n", "items")         # a shingle that no document has: no such window
                  .agg(F.count(F.lit(1)).alias("present"), F.min(F.struct("df", "at", "key")).alias("first"))
                  .where(F.col("present") == F.col("n") - (k - 1))
                  .select("joined", "n", "items", F.col("first.at").alias("offset"), F.col("first.key").alias("key")))
        if sum(sizes.values()) > max_broadcast_windows:
            found.append(_shuffled_hits(source, rarest, k))
            continue
        # No lambda from the explode to the last select: they stay one compiled stage, where the array of words is a
        # reference and only the verified hits become rows.
        start = F.col("at") - F.col("offset") + 1
        place = F.translate(F.array_join(F.slice("words", F.greatest(start, F.lit(1)), F.col("n")), " "), UPPER, LOWER)
        hits = (_shingles(source, "words", k, "doc_id", "sha", "words").join(near(rarest), "key")
                .where((start >= 1) & (start + F.col("n") - 1 <= F.size("words")) & (place == F.col("joined"))))
        found.append(hits.select("doc_id", "sha", start.alias("start"), "n", "items"))

    base = source.select("doc_id", "sha", F.size("words").cast("long").alias("n_words"))
    item_type = windows.schema["items"].dataType.simpleString()
    empty_spans, empty_items = F.array().cast("array<struct<start:int,n:int>>"), F.array().cast(item_type)
    if not found:
        return base.select("doc_id", "n_words", empty_spans.alias("spans"), F.lit(0).cast("long").alias("n_hit"), empty_items.alias("items"))
    hits = found[0]
    for more in found[1:]:
        hits = hits.unionByName(more)
    by_doc = (hits.groupBy("doc_id", "sha").agg(F.collect_set(F.struct("start", "n")).alias("spans"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
              .withColumnRenamed("doc_id", "hit_id").withColumnRenamed("sha", "hit_sha"))
    places = F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["n"] - 1)))
    return (base.join(by_doc, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("sha") == F.col("hit_sha")), "left")
            .select("doc_id", "n_words", F.coalesce("spans", empty_spans).alias("spans"),
                    F.coalesce(F.size(F.array_distinct(places)), F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", empty_items).alias("items")))


def query(spark, sf_dir: str) -> DataFrame:
    out = decontaminate(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    names = F.array_join(F.array_sort(F.col("items").cast("array<string>")), ",")
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(names, 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


def sql() -> str:
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    low = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{word}')"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, {low} AS w FROM documents),
items AS (SELECT item_id, {low} AS w FROM benchmark),
wins AS (SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS n, array_to_string(w[i:i + least(len(w), {WINDOW}) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {WINDOW - 1}, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM wins),
own AS (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, lens WHERE len(w) >= n),
hits AS (SELECT o.rid, o.i, o.n, x.item_id FROM own o JOIN wins x ON x.n = o.n AND x.win = array_to_string(o.w[o.i:o.i + o.n - 1], ' ')),
hit_words AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hits) GROUP BY rid),
hit_items AS (SELECT rid, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS names
  FROM hits GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit_words USING (rid) LEFT JOIN hit_items USING (rid)"""
