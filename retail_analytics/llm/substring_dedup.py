"""Substring dedup by repeated-phrase automata: recurring passages are confirmed by hash counts, compiled into sharded Aho-Corasick
automata, and all documents are streamed through the automaton of their shard to locate every occurrence.

A window is ``window`` consecutive words.  Each window picks the smallest hash of its ANCHOR-word runs, a choice that depends on
its words alone, so equal windows share it; windows whose pick occurs in one document only are never shuffled.
"""
from __future__ import annotations

import math
from collections.abc import Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import BLOB_SCHEMA, Words, among, bitmap, blob_batches, cut, groups, loose, owners, pick, sliding_min, trimmed, written

WINDOW = 20
ANCHOR = 10                    # words of the runs that are counted first
SEED = 4                       # words of the phrases in the automata
SHARD_BYTES = 2 << 20          # text of one shard: bounds an automaton and a task, not the result


def inside(h: np.ndarray, first: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window start of a group of texts whether the window stays in one text, and the text of each word."""
    owner = owners(first)
    return owner[window - 1:] == owner[:len(owner) - window + 1] if len(h) >= window else np.zeros(0, bool), owner


def picks(tool: Words, h: np.ndarray, window: int, run: int) -> np.ndarray:
    """The pick of each window: the smallest hash of its runs of ``run`` words."""
    return sliding_min(tool.grams(h, run), window - run + 1)


def _anchors(window: int):
    def run(batches):
        tool = Words()

        def found():
            for texts, _, _ in groups(batches):
                h, first = tool.texts(texts)
                whole, owner = inside(h, first, window)
                pick_, text = picks(tool, h, window, ANCHOR)[whole], owner[:len(whole)][whole]
                if len(pick_):
                    new = np.ones(len(pick_), bool)               # neighbours mostly share a pick
                    new[1:] = (pick_[1:] != pick_[:-1]) | (text[1:] != text[:-1])
                    pick_, text = pick_[new], text[new]
                    by = np.lexsort((pick_, text))
                    once = np.ones(len(by), bool)
                    once[1:] = (pick_[by][1:] != pick_[by][:-1]) | (text[by][1:] != text[by][:-1])
                    yield pick_[by][once]
        yield from blob_batches(found())
    return run


def _candidates(shared, window: int):
    """Arrow function: (w, doc_id, shard), each distinct window of a document whose pick may recur."""
    def run(batches):
        tool = Words()
        for texts, rows, b in groups(batches):
            h, first = tool.texts(texts)
            whole, owner = inside(h, first, window)
            if not whole.any():
                continue
            at = np.flatnonzero(whole & among(shared.value, picks(tool, h, window, ANCHOR)))
            w, text = tool.grams(h, window)[at], owner[at]
            by = np.lexsort((w, text))
            w, text = w[by], text[by]
            once = np.ones(len(w), bool)
            once[1:] = (w[1:] != w[:-1]) | (text[1:] != text[:-1])
            own = pa.array(rows[text[once]])
            yield pa.RecordBatch.from_arrays([pa.array(w[once].view(np.int64)), b.column("doc_id").take(own), b.column("shard").take(own)], ["w", "doc_id", "shard"])
    return run


def _passages(window: int, schema: pa.Schema):
    """Cogroup function: the maximal runs of windows that a document holds first, as (its id, number of the run, text with single
    spaces, windows)."""
    def run(docs: pa.Table, firsts: pa.Table) -> pa.Table:
        if not firsts.num_rows:
            return schema.empty_table()
        tool = Words()
        own = dict(zip(firsts.column("first").to_pylist(), firsts.column("windows").to_pylist()))
        ids, numbers, out, windows = [], [], [], []
        for doc, text in zip(docs.column("doc_id").to_pylist(), docs.column("text").cast(pa.binary()).to_pylist()):
            if doc not in own or not text:
                continue
            words = text.split()
            h = tool.grams(tool.texts([text])[0], window)
            start = np.zeros(len(h), bool)
            start[np.unique(h, return_index=True)[1]] = True
            at = np.flatnonzero(start & np.isin(h, np.array(own[doc], np.int64).view(np.uint64)))
            for run_ in np.split(at, np.flatnonzero(np.diff(at) > 1) + 1):
                if len(run_):
                    ids.append(doc)
                    numbers.append(len(numbers))
                    out.append(b" ".join(words[run_[0]:run_[-1] + window]))
                    windows.append(h[run_].view(np.int64))
        return pa.Table.from_arrays([pa.array(ids, schema.field("first").type), pa.array(numbers, pa.int32()), pa.array(out, pa.binary()),
                                     pa.array(windows, pa.list_(pa.int64()))], schema=schema)
    return run


class Shard:
    """The passages that a shard's documents share with earlier ones: an automaton over their seed phrases, and for each of their
    windows the passage and place to compare with."""

    def __init__(self, firsts: list, passages: list[bytes], window: int, tool: Words):
        self.window, self.tool, self.passages, self.firsts = window, tool, [b" " + p + b" " for p in passages], firsts
        self.finder, hashes, owner, place = ahocorasick.Automaton(), [], [], []
        for n, p in enumerate(self.passages):
            h, start, end = tool.split(p)
            seeds, least = tool.grams(h, SEED), picks(tool, h, window, SEED)
            for q in np.flatnonzero(np.isin(seeds, least)):
                phrase = p[start[q] - 1:end[q + SEED - 1] + 1].decode("latin-1")
                self.finder.add_word(phrase, len(phrase))
            w = tool.grams(h, window)
            hashes.append(w)
            owner.append(np.full(len(w), n))
            place.append(start[:len(w)])
        if passages:
            self.finder.make_automaton()
            w = np.concatenate(hashes)
            by = np.argsort(w, kind="stable")
            self.w, self.owner, self.place = w[by], np.concatenate(owner)[by], np.concatenate(place)[by]

    def later(self, docs: list, data: bytes, w: np.ndarray, whole: np.ndarray, start: np.ndarray, end: np.ndarray, text: np.ndarray) -> np.ndarray:
        """For each window of some texts in one piece of bytes whether its words also start earlier: found by the automaton, looked
        up by hash, and compared with the passage word for word."""
        n, window = len(w), self.window
        by = np.lexsort((np.arange(n), w, text[:n]))
        again = np.zeros(n, bool)
        again[by[1:]] = (w[by[1:]] == w[by[:-1]]) & (text[by[1:]] == text[by[:-1]])
        again &= whole
        if not self.passages:
            return again
        seeds = np.fromiter((at - size + 2 for at, size in self.finder.iter(data.decode("latin-1"))), np.int64)   # first byte of the first word
        if not len(seeds):
            return again
        q = np.searchsorted(start, seeds)
        near = np.zeros(len(start) + 2, np.int32)
        np.add.at(near, np.maximum(q - (window - SEED), 0), 1)
        np.add.at(near, q + 1, -1)
        at = np.flatnonzero((np.cumsum(near)[:n] > 0) & whole)
        k = np.minimum(np.searchsorted(self.w, w[at]), len(self.w) - 1)
        same = self.w[k] == w[at]
        at, k = at[same], k[same]
        if not len(at):
            return again
        # neighbouring windows that lie side by side in one passage are compared at once
        shift = self.place[k] - start[at]
        edge = np.flatnonzero((np.diff(at) != 1) | (np.diff(self.owner[k]) != 0) | (np.diff(shift) != 0) | (np.diff(text[at]) != 0)) + 1
        for a, z in zip([0, *edge.tolist()], [*edge.tolist(), len(at)]):
            first, doc, i, j = self.firsts[self.owner[k[a]]], docs[text[at[a]]], at[a], at[z - 1] + window - 1
            if first is not None and (doc is None or first < doc):
                from_, size = start[i] - 1, end[j] - start[i] + 2
                there = self.place[k[a]] - 1
                if self.passages[self.owner[k[a]]][there:there + size] == data[from_:from_ + size]:
                    again[i:i + z - a] = True
        return again


def _locate(window: int, keep: Sequence[str], schema: pa.Schema):
    def run(docs: pa.Table, passages: pa.Table) -> pa.Table:
        tool = Words()
        shard = Shard(passages.column("first").to_pylist(), passages.column("passage").to_pylist(), window, tool)
        n_words, removed, kept = [], [], []
        ids = docs.column("doc_id").to_pylist()
        batch = pa.RecordBatch.from_arrays([docs.column("text").combine_chunks()], ["text"])
        for texts, rows, _ in groups([batch]):
            words = [t.split() for t in texts]
            data = b"".join(b" " + b" ".join(x) + b" " for x in words)       # two spaces between texts: no phrase crosses them
            h, start, end = tool.split(data)
            first = np.cumsum([0, *map(len, words)])
            whole, text = inside(h, first, window)
            gone = np.zeros(len(h) + 1, np.int32)
            if whole.any():
                at = np.flatnonzero(shard.later([ids[r] for r in rows], data, tool.grams(h, window), whole, start, end, text))
                np.add.at(gone, at, 1)
                np.add.at(gone, at + window, -1)
            gone = np.cumsum(gone)[:-1] > 0
            for x, a, z in zip(words, first[:-1], first[1:]):
                n_words.append(len(x))
                removed.append(int(gone[a:z].sum()))
                kept.append(b" ".join([y for y, g in zip(x, gone[a:z].tolist()) if not g] if removed[-1] else x))
        cols = [docs.column(c) for c in ("doc_id", *keep)]
        return pa.Table.from_arrays([*cols, pa.array(n_words, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], schema=schema)
    return run


def substring_dedup(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", keep: Sequence[str] = (),
                    shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per document: doc_id, the columns ``keep``, n_words, n_removed, kept (the words left, joined by one space).

    Every word covered by a window whose words also start earlier (smaller doc_id, or the same document) is removed, judged on
    the input.  Null and empty texts have no words; texts shorter than a window keep all; rows that share a doc_id are judged
    each against smaller ids and itself; a null doc_id comes after all others; an empty table gives an empty result; other
    columns are dropped.
    """
    if window <= ANCHOR:
        raise ValueError(f"a window has more than {ANCHOR} words")
    source = pick(docs, doc_id=id_col, text=text_col, **{f"keep_{i}": c for i, c in enumerate(keep)})
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, math.ceil(size / shard_bytes))

    def shard(c: str):
        return F.pmod(F.xxhash64(c), F.lit(shards)).cast("int")

    # documents without an id are later than all others, wherever they lie: they are dealt out by their text
    own_shard = F.when(F.col("doc_id").isNull(), shard("text")).otherwise(shard("doc_id")).alias("shard")
    dealt = source.select(own_shard, *source.columns)
    slim = dealt.select("shard", "doc_id", "text")
    shared = bitmap(slim.mapInArrow(trimmed(_anchors(window)), BLOB_SCHEMA), 2)
    kind = source.schema["doc_id"].dataType.simpleString()
    seen = slim.mapInArrow(trimmed(_candidates(shared, window)), f"w long, doc_id {kind}, shard int")
    # confirm: windows of two documents or more, and the first of them
    firsts = cut(seen.groupBy("w").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null").select("w", "first"))
    by_doc = firsts.groupBy("first").agg(F.collect_list("w").alias("windows")).select(shard("first").alias("shard"), "first", "windows")
    names = {f"keep_{i}": c for i, c in enumerate(keep)}

    spark = docs.sparkSession
    arrow_id = spark.createDataFrame([], f"first {kind}").toArrow().schema.field("first").type
    fields = pa.schema([("first", arrow_id), ("run", pa.int32()), ("passage", pa.binary()), ("windows", pa.list_(pa.int64()))])
    passages = written(slim.groupBy("shard").cogroup(by_doc.groupBy("shard"))
                       .applyInArrow(trimmed(_passages(window, fields)), f"first {kind}, run int, passage binary, windows array<long>"))
    # route: a shard needs the passages that its later documents share, each once
    places = passages.select(F.explode("windows").alias("w"), "first", "run")
    routes = cut(seen.join(loose(places), "w").where("doc_id is null or doc_id > first").select("shard", "first", "run").distinct())
    shared.destroy()
    routed = loose(routes).join(passages, ["first", "run"]).select("shard", "first", "passage")
    extra = source.drop("doc_id", "text").schema
    out_schema = ", ".join([f"doc_id {kind}", *(f"{f.name} {f.dataType.simpleString()}" for f in extra), "n_words long, n_removed long, kept string"])
    empty = spark.createDataFrame([], out_schema).toArrow().schema
    out = dealt.groupBy("shard").cogroup(routed.groupBy("shard")).applyInArrow(trimmed(_locate(window, list(names), empty)), out_schema)
    return out.select("doc_id", *(F.col(k).alias(c) for k, c in names.items()), "n_words", "n_removed", "kept")


def query(spark, sf_dir: str) -> DataFrame:
    out = substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
