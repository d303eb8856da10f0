"""Byte-level BPE: overlapping chunks are pre-tokenised in parallel, stitched where their boundaries meet, and encoded piece by
piece; decoding concatenates the raw bytes of the ids."""
from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

from .common import pick, trimmed

CHUNK, OVERLAP = 1 << 16, 1 << 12     # characters
SLICE = 1 << 21                       # bytes of text encoded at a time


def load_ranks(path: str) -> dict:
    """{"ranks": {bytes: id}} of a rank file, a line per token: base64 bytes and the id."""
    with open(path, "rb") as f:
        return {"ranks": {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, "coder": {}}


def _coder(own: dict, pattern: str):
    """The library's coder for the broadcast ranks, built once per worker."""
    import tiktoken
    if pattern not in own["coder"]:
        own["coder"][pattern] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=own["ranks"], special_tokens={})
    return own["coder"][pattern]


def _slices(batches, column: str, size: int):
    """Batches of few rows: at most ``size`` bytes of the column together, or one row."""
    for b in batches:
        ends = pc.cumulative_sum(pc.fill_null(pc.binary_length(b.column(column)), 0)).to_numpy() if b.num_rows else np.zeros(0)
        i = 0
        while i < b.num_rows:
            base = ends[i - 1] if i else 0
            j = max(i + 1, int(np.searchsorted(ends, base + size, "right")))
            yield b.slice(i, j - i)
            i = j


def raw_of(ids: pa.Array, token: dict[int, bytes]) -> pa.Array:
    """The bytes of each row's ids, one after the other; a null row is empty, an unknown id fails."""
    sizes = pc.fill_null(pc.list_value_length(ids), 0).to_numpy()
    flat, ends = ids.flatten().to_numpy(), np.cumsum(sizes)
    return pa.array([b"".join(map(token.__getitem__, flat[e - n:e].tolist())) for n, e in zip(sizes, ends)], pa.binary())


def _encode_with(shared, pattern: str, keep: list[str], text: str, decode: bool = False):
    """Arrow function: the columns ``keep``, the ids of the text column and, with ``decode``, the bytes that the ids stand for."""
    def encode(batches):
        for b in _slices(batches, text, SLICE):
            coder = _coder(shared.value, pattern)
            rows = [np.array(coder.encode_ordinary(t or ""), np.int32) for t in b.column(text).to_pylist()]
            offsets = np.cumsum([0, *map(len, rows)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(rows)))
            raw = []
            if decode:
                own = shared.value
                if "tokens" not in own:
                    own["tokens"] = {i: t for t, i in own["ranks"].items()}
                raw = [raw_of(ids, own["tokens"])]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), ids, *raw], [*keep, "ids", *["raw"] * decode])
    return encode


def boundaries(text: str, pattern, final: bool) -> list[int]:
    """Starts and ends of the pre-tokens of a chunk.  A match that reaches the chunk's end may go on in the text, and white space
    before it may split otherwise, so the last two boundaries count only in the final chunk."""
    at = [0, *(m.end() for m in pattern.finditer(text))]
    return at if final else at[:-2]


def cut_long(long: DataFrame, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """Pieces (key, n, start, end) of long texts between boundaries that are sure.

    Each chunk sees ``overlap`` characters of the next one.  Scanning depends only on the text after a boundary, so where a
    boundary of chunk i is one of chunk i + 1 too, both scans agree from there on.  The first such place in the overlap ends
    the piece of chunk i.  Where none is (a word longer than the overlap) nothing after it is proven: the rest is one piece.
    A piece is matched again without the text after it, and white space splits by the character behind it, so no piece ends in
    white space.
    The seam after the last chunk is never met and ends the list.
    """
    n = F.ceil(F.length("text") / F.lit(chunk)).cast("int")
    chunks = (long.select("key", n.alias("n_chunks"), F.explode(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(
        i.cast("int").alias("i"), F.expr("text").substr(i * chunk + 1, F.lit(chunk + overlap)).alias("part")))).alias("c"))
        .select("key", "n_chunks", "c.*").repartition("key", "i"))

    def scan(batches):
        words = regex.compile(pattern)
        for b in batches:
            heads, tails = [], []
            for last, i, part in zip(b.column("n_chunks").to_pylist(), b.column("i").to_pylist(), b.column("part").to_pylist()):
                at = boundaries(part, words, i + 1 == last)
                heads.append([i * chunk + x for x in at if i and x < overlap])
                tails.append([i * chunk + x for x in at if x >= chunk and not part[x - 1].isspace()] if i + 1 < last else None)
            yield pa.RecordBatch.from_arrays([b.column("key"), b.column("i"), pa.array(heads, pa.list_(pa.int32())),
                                              pa.array(tails, pa.list_(pa.int32()))], ["key", "i", "head", "tail"])

    key = long.schema["key"].dataType.simpleString()
    scans = chunks.mapInArrow(trimmed(scan), f"key {key}, i int, head array<int>, tail array<int>")
    sides = (scans.select("key", F.explode(F.array(F.struct(F.col("i").alias("seam"), F.col("tail").alias("a"), F.lit(None).cast("array<int>").alias("b")),
                                                  F.struct((F.col("i") - 1).alias("seam"), F.lit(None).cast("array<int>").alias("a"),
                                                           F.col("head").alias("b")))).alias("s")).select("key", "s.*").where("seam >= 0"))
    seams = (sides.groupBy("key", "seam").agg(F.max("a").alias("a"), F.max("b").alias("b"))
             .select("key", "seam", F.array_min(F.array_intersect("a", "b")).alias("at")))
    seams = seams.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("seam", "at"))).alias("s"))
    miss = F.array_position(F.transform("s", lambda x: x["at"].isNull()), True).cast("int")
    sure = F.when(miss > 0, F.slice("s", F.lit(1), miss - 1)).otherwise(F.col("s"))
    return seams.select("key", F.array_distinct(F.transform(sure, lambda x: x["at"])).alias("cuts"))


def bpe_encode(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK,
               overlap: int = OVERLAP, decode: bool = False) -> DataFrame:
    """One row per document: doc_id, ids (array of int) and, with ``decode``, raw (binary), the ids decoded again in the same pass:
    each match of ``pattern`` encoded separately by the ranks in the file
    ``vocabulary`` (read by the driver), no special tokens.

    Texts of at most ``chunk`` characters are one chunk, encoded where they are.  Longer ones are cut into overlapping chunks
    that other tasks scan; only those travel.  Null and empty texts have an empty array; repeated rows stay; an empty table
    gives an empty result; other columns are dropped.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load_ranks(vocabulary))
    source = pick(docs, doc_id=id_col, text=text_col)
    kind = source.schema["doc_id"].dataType.simpleString()
    out = "ids array<int>" + ", raw binary" * decode
    is_long = F.coalesce(F.length("text"), F.lit(0)) > chunk
    short = source.where(~is_long).mapInArrow(trimmed(_encode_with(shared, pattern, ["doc_id"], "text", decode)), f"doc_id {kind}, {out}")

    long = (source.where(is_long).groupBy("doc_id", "text").agg(F.count("*").alias("copies"))
            .withColumn("key", F.struct("doc_id", F.sha2("text", 256).alias("sha"))))
    cuts = cut_long(long.select("key", "text"), pattern, chunk, overlap)
    at = F.concat(F.array(F.lit(0)), F.coalesce("cuts", F.array().cast("array<int>")), F.array(F.length("text")))
    pieces = (long.join(cuts, "key", "left").withColumn("at", at)
              .select("key", "copies", F.explode(F.transform(F.sequence(F.lit(1), F.size("at") - 1), lambda i: F.struct(
                  i.cast("int").alias("i"), F.expr("text").substr(F.get("at", i - 1) + 1, F.get("at", i) - F.get("at", i - 1)).alias("part")))).alias("p"))
              .select("key", "copies", "p.*").repartition("key", "i"))
    key = long.schema["key"].dataType.simpleString()
    coded = pieces.mapInArrow(trimmed(_encode_with(shared, pattern, ["key", "copies", "i"], "part", decode)), f"key {key}, copies long, i int, {out}")
    names = ["ids", *["raw"] * decode]
    whole = [F.flatten("parts.ids").alias("ids"), *[F.aggregate("parts.raw", F.lit(b""), lambda a, x: F.concat(a, x)).alias("raw")] * decode]
    joined = (coded.groupBy("key", "copies").agg(F.array_sort(F.collect_list(F.struct("i", *names))).alias("parts"))
              .select("key.doc_id", *whole, F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("doc_id", *names))
    return short.unionByName(joined)


def bpe_decode(coded: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per document: doc_id, n_tokens, ids, raw (binary): the bytes of all ids one after the other; a null array is
    empty, an unknown id fails."""
    shared = coded.sparkSession.sparkContext.broadcast({i: t for t, i in load_ranks(vocabulary)["ranks"].items()})
    source = pick(coded, doc_id=id_col, ids=ids_col)

    def decode(batches):
        for whole in batches:
            for b in (whole.slice(i, 256) for i in range(0, whole.num_rows, 256)):
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("ids"), raw_of(b.column("ids"), shared.value)], ["doc_id", "ids", "raw"])

    kind = source.schema["doc_id"].dataType.simpleString()
    return (source.mapInArrow(trimmed(decode), f"doc_id {kind}, ids array<int>, raw binary")
            .withColumn("ids", F.coalesce("ids", F.array().cast("array<int>"))).withColumn("n_tokens", F.size("ids").cast("long")))


def digest(docs: DataFrame, vocabulary: str, pattern: str, **names: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids joined by spaces), decoded_sha256 (of the decoded bytes)."""
    out = bpe_encode(docs, vocabulary, pattern, decode=True, **names)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                      F.sha2("raw", 256).alias("decoded_sha256"))


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return digest(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
