"""Cross-tokenizer alignment of a byte-level BPE (A) and a sentencepiece model (B) with exact-text deduplication.

Documents are shuffled by their full text, each distinct text is tokenised and aligned once, pair counts are weighted by the
number of its documents, and the measures are joined to the documents by the text's SHA-256.
"""
from __future__ import annotations

import hashlib
import json
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import cut, pick, written
from .token_count import byte_symbols

MAX_BROADCAST_PAIRS = 1_000_000       # id pairs with their counts that are broadcast (about 40 bytes each); more are shuffled
SEGMENT = 1 << 16                     # a longer text is taken in parts cut at seams, for bounded memory
BLOCK = 1 << 18                       # characters that are tokenised and aligned at a time
UNITS = 1 << 19                       # aligned units that a worker remembers
MEASURES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def solid(c: str) -> bool:
    """A character that no tokenizer takes for white space."""
    return "!" <= c <= "~" or c.isalpha()


def units_of(text: str) -> list[str]:
    """The text cut at its seams, the seams' spaces left out.  A seam is a single space between two solid characters: a token of
    either side ends before it, so units are tokenised and aligned each on its own."""
    words = text.split(" ")
    out, first = [], 0
    for k in range(1, len(words)):
        if words[k - 1] and words[k] and solid(words[k - 1][-1]) and solid(words[k][0]):
            out.append(words[first] if first == k - 1 else " ".join(words[first:k]))
            first = k
    out.append(words[first] if first == len(words) - 1 else " ".join(words[first:]))
    return out


SEAM = re.compile(r"(?<=[!-~]) (?=[!-~])")


def segments(text: str) -> list[str]:
    """A long text cut at seams into parts of about ``SEGMENT`` characters."""
    out, at = [], 0
    while len(text) - at > SEGMENT and (seam := SEAM.search(text, at + SEGMENT)):
        out.append(text[at:seam.start()])
        at = seam.end()
    return [*out, text[at:]]


class Aligner:
    """Both tokenizers, the bytes of their tokens and the units aligned so far.  ``json_text`` and ``model`` are the contents of the
    vocabulary files."""

    def __init__(self, json_text: str, model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_str(json_text)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        byte_of = {c: b for b, c in enumerate(byte_symbols())}
        vocab = json.loads(json_text)["model"]["vocab"]
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes_a[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.len_a, self.len_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        self.seams = not any("▁" in p.lstrip("▁") for p in pieces)       # else a piece of B may reach over a seam
        self.forget()

    def forget(self) -> None:
        self.row: dict[str, int] = {}                   # unit -> its row in the lists, -1 if a side doesn't give it back
        self.written: list[str] = []
        self.sizes = np.zeros((0, 4), np.int64)
        self.pairs, self.first = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def learn(self, units: list[str]) -> None:
        """Tokenises and aligns new units."""
        of_a = [e.ids for e in self.a.encode_batch_fast([" " + u for u in units], add_special_tokens=False)]
        of_b = self.b.encode(units, num_threads=1)
        keep = []
        for k, (u, x, y) in enumerate(zip(units, of_a, of_b)):
            want = b" " + u.encode()
            if b"".join([self.bytes_a[i] for i in x]) == want == b"".join([self.bytes_b[i] for i in y]):
                self.row[u] = len(self.written) + len(keep)
                keep.append(k)
            else:
                self.row[u] = -1
        if not keep:
            return
        n_a, n_b = (np.array([len(of[k]) for k in keep], np.int64) for of in (of_a, of_b))
        a, b = (np.array([i for k in keep for i in of[k]], np.int64) for of in (of_a, of_b))
        group_a, group_b, left, right = self.aligned(a, b)
        # the written form: tokens in the order (group, side), each behind its separator
        side = np.repeat([0, 1], [len(a), len(b)])
        place = np.concatenate([group_a, group_b]) * 2 + side
        order = np.argsort(place, kind="stable")
        place, ids = place[order], np.concatenate([a, b])[order].tolist()
        step = np.zeros(len(place), np.int64)
        step[1:] = np.where(place[1:] == place[:-1], 0, np.where(place[1:] // 2 == place[:-1] // 2, 1, 2))
        parts = [x for z in zip([",|;"[k] for k in step], map(str, ids)) for x in z]
        ends = np.cumsum(n_a + n_b).tolist()
        self.written += ["".join(parts[2 * i + 1:2 * j]) for i, j in zip([0, *ends], ends)]
        own_a = np.repeat(np.arange(len(keep)), n_a)
        links = np.bincount(own_a[left], minlength=len(keep))
        groups = np.bincount(own_a[np.diff(group_a, prepend=-1) > 0], minlength=len(keep))
        self.sizes = np.concatenate([self.sizes, np.stack([n_a, n_b, groups, links], 1)])
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(links)])
        self.pairs = np.concatenate([self.pairs, a[left] << 32 | b[right]])

    def aligned(self, a: np.ndarray, b: np.ndarray):
        """(group of each token of A, of each of B, links as index pairs) of tokens that cover the same bytes."""
        end_a, end_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
        both = end_a[np.isin(end_a, end_b, assume_unique=True)]
        first = np.searchsorted(end_b, end_a - self.len_a[a], "right")
        n = np.searchsorted(end_b - self.len_b[b], end_a, "left") - first
        left = np.repeat(np.arange(len(a)), n)
        return np.searchsorted(both, end_a), np.searchsorted(both, end_b), left, np.arange(len(left)) - np.repeat(np.cumsum(n) - n - first, n)

    def add(self, parts: list[str], owner: list[int], texts: dict[int, _Text]) -> None:
        """Aligns parts of texts and adds them to what is gathered of their owners."""
        if len(self.row) > UNITS:
            self.forget()
        cut = [units_of(p) if self.seams else [p] for p in parts]
        new = list(dict.fromkeys(u for units in cut for u in units if u not in self.row))
        if new:
            self.learn(new)
        for units, o in zip(cut, owner):
            rows = [self.row[u] for u in units]
            t = texts[o]
            if min(rows) < 0:
                t.whole = False
                continue
            t.groups.append(";".join([self.written[r] for r in rows]))
            at = np.array(rows)
            t.sizes += self.sizes[at].sum(0)
            n = self.sizes[at, 3]
            t.pairs.append(self.pairs[np.arange(int(n.sum())) + np.repeat(self.first[at] - np.cumsum(n) + n, n)])


class _Text:
    """What is gathered of one text, part by part."""

    def __init__(self):
        self.sizes, self.groups, self.pairs, self.whole = np.zeros(4, np.int64), [], [], True


def aligned_texts(texts: DataFrame, vocabulary_a: str, model_b: str, digest: bool = False) -> DataFrame:
    """Rows (key, docs, text) to (key, docs, n_a, n_b, n_groups, n_links, groups, pairs, occ), as a written table.

    ``pairs`` has the distinct linked id pairs (A's id times 2**32 plus B's), ``occ`` their links; ``groups`` is the alignment as
    ``a1,a2|b1;a3|b2,b3``, or its SHA-256 with ``digest``.  A text that one side doesn't give back byte by byte is left out.
    """
    with open(vocabulary_a, encoding="utf-8") as f, open(model_b, "rb") as g:
        shared = texts.sparkSession.sparkContext.broadcast({"files": (f.read(), g.read()), "aligner": None})
    names = ["key", "docs", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "occ"]
    kinds = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32())]

    def rows(batch: pa.RecordBatch, done: list[tuple[int, _Text]]) -> pa.RecordBatch:
        out = [[] for _ in kinds]
        for _, t in done:
            for column, value in zip(out, t.sizes.tolist()):
                column.append(value)
            whole = ";".join(t.groups)
            out[4].append(hashlib.sha256(whole.encode()).hexdigest() if digest else whole)
            pair, occ = np.unique(np.concatenate(t.pairs), return_counts=True)
            out[5].append(pair)
            out[6].append(occ)
        own = batch.take(pa.array([k for k, _ in done], pa.int64())).select(["key", "docs"])
        return pa.RecordBatch.from_arrays([*own.columns, *(pa.array(c, k) for c, k in zip(out, kinds))], names)

    def run(batches):
        state = shared.value
        if state["aligner"] is None:
            state["aligner"] = Aligner(*state["files"])
        aligner = state["aligner"]
        for batch in batches:
            column, waiting, parts, owner, size = batch.column("text"), {}, [], [], 0
            for k in range(batch.num_rows):
                waiting[k] = _Text()
                text = column[k].as_py()
                for s in segments(text) if aligner.seams else [text]:
                    parts.append(s)
                    owner.append(k)
                    size += len(s)
                    if size >= BLOCK:
                        aligner.add(parts, owner, waiting)
                        done = [(o, waiting.pop(o)) for o in list(waiting) if o != k]
                        yield rows(batch, [(o, t) for o, t in done if t.whole])
                        parts, owner, size = [], [], 0
            if parts:
                aligner.add(parts, owner, waiting)
            yield rows(batch, [(o, t) for o, t in waiting.items() if t.whole])

    schema = "key binary, docs long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, occ array<int>"
    out = written(texts.mapInArrow(run, schema))
    shared.destroy()
    return out


def align(docs: DataFrame, vocabulary_a: str, model_b: str, id_col: str = "doc_id", text_col: str = "text", digest: bool = False,
          max_broadcast_pairs: int = MAX_BROADCAST_PAIRS) -> DataFrame:
    """One row per document: doc_id, n_a and n_b (tokens), n_groups, n_links, n_best, count_sum and groups.

    vocabulary_a, model_b: paths of a byte-level BPE for the tokenizers library and of a sentencepiece model; the driver reads them.
    A encodes a space and the text, B the text, before which it puts a space itself; special tokens inside texts are plain text.
    Positions where a token of both ends cut them into groups (``groups``, see :func:`aligned_texts`); a link is a pair of token
    occurrences whose bytes overlap.  The count of an id pair is the number of documents, copies included, that hold it linked;
    n_best counts the links with a pair of the highest count among those of its A id (ties are all highest); count_sum adds up the
    counts of all links.  Null and empty texts, and those that one side doesn't give back byte by byte, have zeros and ''.
    Repeated rows and ids stay; an empty table gives an empty result; a very long text is cut at seams; other columns are dropped.
    """
    source = pick(docs, doc_id=id_col, text=text_col)
    key = F.unhex(F.sha2("text", 256))
    texts = source.where("text <> ''").groupBy("text").agg(F.count("*").alias("docs")).select(key.alias("key"), "docs", "text")
    own = aligned_texts(texts, vocabulary_a, model_b, digest)
    counts = cut(own.select("docs", F.explode("pairs").alias("pair")).groupBy("pair").agg(F.sum("docs").alias("count")))
    highest = counts.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("count").alias("highest"))
    table = cut(counts.join(highest, F.shiftright("pair", 32) == F.col("a")).select(F.col("pair").alias("known"), "count", (F.col("count") == F.col("highest")).alias("best")))
    near = F.broadcast(table) if table.count() <= max_broadcast_pairs else table
    links = own.select("key", F.inline(F.arrays_zip("pairs", "occ"))).join(near, F.col("pairs") == F.col("known"))
    sums = links.groupBy("key").agg(F.sum(F.when(F.col("best"), F.col("occ")).otherwise(0)).alias("n_best"), F.sum(F.col("occ") * F.col("count")).alias("count_sum"))
    measures = own.drop("docs", "pairs", "occ").join(sums, "key", "left").withColumnRenamed("key", "its_key")
    return (source.select("doc_id", F.when(F.col("text") != "", key).alias("key")).join(measures, F.col("key") == F.col("its_key"), "left")
            .select("doc_id", *(F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in MEASURES), F.coalesce("groups", F.lit("")).alias("groups")))


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    out = align(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), digest=True)
    return out.withColumnRenamed("groups", "groups_sha256")
