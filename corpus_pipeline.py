"""Corpus pipeline over ``documents``: quality rules, near-duplicate join, substring dedup, decontamination, byte-level BPE.

Each stage takes (spark, docs, sf_dir), works on all rows of docs and returns rows with its columns; the last returns the coded
documents.  A stage keeps other columns of docs.  Rows are judged each by its own text, also those that share a doc_id or have none.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from retail_analytics.llm import bpe
from retail_analytics.llm.common import cut
from retail_analytics.llm.decontaminate import decontaminate
from retail_analytics.llm.jaccard_join import jaccard_join
from retail_analytics.llm.quality import quality
from retail_analytics.llm.substring_dedup import substring_dedup


MAX_BROADCAST_ROWS = 200_000          # rows to remove that are broadcast (at most 24 bytes each); more are shuffled


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of docs that meet none of ``gone`` (row keys, or ids with hashes of the text); the list is checkpointed and counted
    to choose the join."""
    gone = cut(gone)
    if gone.count() <= MAX_BROADCAST_ROWS:
        gone = F.broadcast(gone)
    if "gone_key" in gone.columns:
        return docs.join(gone, row_key(docs) == F.col("gone_key"), "left_anti")
    return docs.join(gone, docs["doc_id"].eqNullSafe(F.col("gone_id")) & (F.xxhash64(docs["text"]) == F.col("gone_text")), "left_anti")


def row_key(docs: DataFrame) -> Column:
    """Hash of the doc_id, null or not, and the text: one for exact copies of a row only."""
    return F.xxhash64(docs["doc_id"].isNull(), docs["doc_id"], docs["text"])


def one_of_each(docs: DataFrame) -> DataFrame:
    """Of rows with words that share doc_id and text, the one whose other columns are smallest."""
    some = docs.where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    again = cut(some.groupBy(row_key(docs).alias("gone_key")).agg(F.count("*").alias("n")).where("n > 1").select("gone_key"))
    copies = again.count()
    if not copies:
        return docs
    near = F.broadcast(again) if copies <= MAX_BROADCAST_ROWS else again
    one = (docs.join(near, row_key(docs) == F.col("gone_key"), "left_semi").groupBy(row_key(docs))
           .agg(F.min(F.struct(*(docs[c] for c in docs.columns))).alias("row")).select("row.*"))
    return without(docs, again).unionByName(one)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the perplexity bands reject go.  A null or empty text has too few words and goes; a null
    language has a band of its own; repeated rows share their fate; an empty table stays empty."""
    gone = quality(docs).where("not kept").select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_text"))
    return without(docs, gone)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by a similarity of 0.8 on five-word shingles, exact copies among them, one row stays: that
    of the smallest doc_id, a null one last, and then of the smallest key.  Texts without words have no links and stay."""
    docs = one_of_each(docs)
    keyed = docs.select(row_key(docs).alias("key"), "doc_id", "text")
    linked = cut(jaccard_join(keyed, shingle=5, percent=80, id_col="key").where("doc_id <> component_id")
                 .select(F.col("doc_id").alias("gone_key"), F.col("component_id").alias("component")))
    members = linked.union(linked.select("component", "component").distinct())
    first = (members.join(keyed.select("key", "doc_id"), F.col("gone_key") == F.col("key")).groupBy("component")
             .agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key")).alias("first")).select(F.col("first.key").alias("gone_key")))
    return without(docs, members.select("gone_key").join(first, "gone_key", "left_anti"))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The text becomes the words left, joined by one space, n_chars its length; no document goes.  A null or empty text becomes
    empty; of equal windows the one in the smallest doc_id stays, null ids are later than all others, and rows that share an
    id are judged by smaller ids and themselves; an empty table stays empty."""
    others = {f"other_{i}": c for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}       # names that can't clash
    out = substring_dedup(docs.select("doc_id", "text", *(docs[c].alias(k) for k, c in others.items())), keep=list(others))
    now = {"doc_id": F.col("doc_id"), "text": F.col("kept")} | {c: F.col(k) for k, c in others.items()}
    if "n_chars" in now:
        now["n_chars"] = F.length("kept").cast(docs.schema["n_chars"].dataType)
    return out.select(*(now[c].alias(c) for c in docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go, each row by its own text.  A null or empty text has no window and stays;
    without benchmark items all stay; an empty table stays empty."""
    found = decontaminate(docs.select(row_key(docs).alias("key"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col="key")
    return without(docs, found.where("n_hit > 0").select(F.col("doc_id").alias("gone_key")).distinct())


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the decoded bytes, a row for each row.  A null or empty text has no
    tokens and the digests of nothing; an empty table gives no rows."""
    import public_tokenizers
    return bpe.digest(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages),
          ("decontamination", decontamination), ("byte_bpe", byte_bpe)]
ORACLE_SQL = None          # the perplexity bands and the reach of links are beyond SQL; tests/llm holds a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the whole documents table; what a stage kept is checkpointed for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = cut(docs)
    return docs
