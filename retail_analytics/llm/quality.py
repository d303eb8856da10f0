"""Quality rules: counts per text and a modified Kneser-Ney n-gram model whose language-specific perplexity bands reject documents.

The model's n-grams are the characters of words with their ends, so its tables follow the spelling of a language and not the
number of documents.  Spark counts the n-grams of all documents; the probabilities travel as sorted arrays of hashes.
"""
from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import Words, cut, groups, pick, trimmed

ORDER = 4
MIN_WORDS, MAX_REPEAT = 50, 50          # words; percent of words inside repeated 3-word windows
WIDTH, LEAST_WIDTH = 8.0, 1.5           # half a band: so many robust deviations of the log perplexity, at least so much
BIN = 1000                              # log perplexities are ranked in thousandths
MAX_GRAMS = 8_000_000                   # a larger model (12 bytes a gram) is joined instead of broadcast
HELD_WORDS = 100_000                    # distinct words of a language that a task holds before it emits their n-grams
START, END = "\x02", "\x03"
SYMBOLS = b"#*$%&|<>"


# ---- the model ----------------------------------------------------------------------------------------------------

def spelled(words: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points of every n-gram of the words, padded with order - 1 starts and one end, a row each; n-grams per word."""
    pad, texts = START * (order - 1), [w.decode("utf-8") for w in words]
    points = code_points("".join(pad + t + END for t in texts))
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    ends = np.cumsum(sizes + order - 1)
    last = np.ones(len(points), bool)
    for j in range(order - 1):
        last[ends - sizes - order + 1 + j] = False
    return np.lib.stride_tricks.sliding_window_view(points, order)[np.flatnonzero(last) - order + 1], sizes


def gram_counts(docs: DataFrame, order: int) -> DataFrame:
    """(lang, gram, c) over the words of all texts; a null language is its own.  Equal words and n-grams of a batch are added up
    before the shuffle."""
    def rows_of(lang: str | None, words: Counter) -> pa.RecordBatch:
        keys = list(words)
        rows, sizes = spelled(keys, order)
        weight = np.repeat(np.array([words[w] for w in keys], np.int64), sizes)
        _, at, which = np.unique(gram_hash(rows, 0), return_index=True, return_inverse=True)
        total = np.bincount(which, weights=weight, minlength=len(at)).astype(np.int64)
        text = rows[at].astype(np.uint32).tobytes().decode("utf-32-le")
        grams = [text[i:i + order] for i in range(0, len(text), order)]
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(grams, pa.string()), pa.array(total)], ["lang", "gram", "c"])

    def count(batches):
        found: dict[str | None, Counter] = {}
        for texts, rows, b in groups(batches):
            for lang, text in zip(b.column("lang").slice(rows[0], len(rows)).to_pylist(), texts):
                words = found.setdefault(lang, Counter())
                words.update(text.split())
                if len(words) > HELD_WORDS:
                    yield rows_of(lang, found.pop(lang))
        for lang, words in found.items():
            if words:
                yield rows_of(lang, words)

    return docs.select("lang", "text").mapInArrow(trimmed(count), "lang string, gram string, c long").groupBy("lang", "gram").agg(F.sum("c").alias("c"))


def kneser_ney(top: DataFrame, order: int) -> DataFrame:
    """(lang, m, gram, logp, gamma): for each seen gram of length m the interpolated log probability of its last character and,
    where the gram is a context, the weight gamma of what backs off from it.

    The highest order uses its counts, the others the number of different characters before them.  Three discounts per
    language and order come from the counts of counts, as in the modified method.
    """
    levels = {order: top}
    for m in range(order - 1, 0, -1):
        levels[m] = levels[m + 1].select("lang", F.expr(f"substring(gram, 2, {m})").alias("gram")).groupBy("lang", "gram").agg(F.count(F.lit(1)).alias("c"))
    n = {i: F.sum((F.col("c") == i).cast("double")) for i in (1, 2, 3, 4)}
    done, lower = [], None
    for m in range(1, order + 1):
        rows = levels[m].withColumn("ctx", F.expr(f"substring(gram, 1, {m - 1})"))
        seen = rows.groupBy("lang").agg(*(n[i].alias(f"n{i}") for i in n))
        y = F.col("n1") / F.nullif(F.col("n1") + 2 * F.col("n2"), F.lit(0.0))

        def discount(i: int, a: str, b: str) -> Column:
            return F.greatest(F.lit(0.1), F.least(F.lit(i - 0.1), F.coalesce(i - (i + 1) * y * F.nullif(F.col(b), F.lit(0.0)) / F.nullif(F.col(a), F.lit(0.0)),
                                                                           F.lit(0.5 * i))))
        seen = seen.select("lang", *(discount(i, f"n{i}", f"n{i + 1}").alias(f"d{i}") for i in (1, 2, 3)))
        rows = rows.join(seen.withColumnRenamed("lang", "l"), F.col("lang").eqNullSafe(F.col("l"))).drop("l")
        off = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
        w = Window.partitionBy("lang", "ctx")
        rows = rows.select("lang", "gram", "ctx", ((F.col("c") - off) / F.sum("c").over(w)).alias("a"),
                           (F.sum(off).over(w) / F.sum("c").over(w)).alias("gamma"))
        if m == 1:
            rows = rows.withColumn("p", F.col("a") + F.col("gamma") / (F.count("*").over(Window.partitionBy("lang")) + 1))
        else:
            rows = (rows.join(lower.select(F.col("lang").alias("l"), F.col("gram").alias("g"), F.col("p").alias("q")),
                              F.col("lang").eqNullSafe(F.col("l")) & (F.expr(f"substring(gram, 2, {m - 1})") == F.col("g")))
                    .withColumn("p", F.col("a") + F.col("gamma") * F.col("q")))
        lower = cut(rows.select("lang", "gram", "ctx", "p", "gamma"))
        done.append(lower.select("lang", F.lit(m).alias("m"), "gram", F.log("p").alias("logp"), F.lit(None).cast("double").alias("gamma")))
        done.append(lower.groupBy("lang", "ctx").agg(F.max("gamma").alias("gamma"))
                    .select("lang", F.lit(m - 1).alias("m"), F.col("ctx").alias("gram"), F.lit(None).cast("double").alias("logp"), "gamma"))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def lang_seed(lang: str | None) -> int:
    h = 14695981039346656037
    for b in ("\x00" if lang is None else "l" + lang).encode():
        h = (h ^ b) * 1099511628211 % (1 << 64)
    return h


def gram_hash(points: np.ndarray, seed: int) -> np.ndarray:
    """Hash of the code points in each row of a matrix."""
    h = np.full(len(points), seed, np.uint64)
    for j in range(points.shape[1]):
        h = (h ^ points[:, j].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class Model:
    """Sorted hash arrays: log probabilities and back-off weights of the grams of each length."""

    def __init__(self, arrays: dict, order: int):
        self.arrays, self.order = arrays, order

    @staticmethod
    def pack(model: DataFrame, order: int) -> dict:
        """The arrays, from keys and values that the executors make of the grams."""
        def keyed(batches):
            for b in batches:
                lang, m = b.column("lang").to_pylist(), b.column("m").to_numpy()
                points, ends = code_points("".join(b.column("gram").to_pylist())), np.cumsum(m)
                keys = np.zeros(len(m), np.uint64)
                for k in np.unique(m):
                    at = np.flatnonzero(m == k)
                    rows = points[(ends[at] - k)[:, None] + np.arange(k)] if k else np.zeros((len(at), 0), np.uint32)
                    keys[at] = gram_hash(rows, 0) ^ np.array([lang_seed(lang[i]) for i in at], np.uint64)
                logp, gamma = (b.column(c).to_numpy(zero_copy_only=False) for c in ("logp", "gamma"))
                slot = m * 2 + np.isnan(logp.astype(np.float64))
                value = np.where(slot % 2 == 1, gamma, logp).astype(np.float32)
                yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int32)), pa.array(keys.view(np.int64)), pa.array(value)], ["slot", "key", "value"])

        table = model.mapInArrow(trimmed(keyed), "slot int, key long, value float").toArrow()
        slot, keys, value = (table.column(c).to_numpy() for c in ("slot", "key", "value"))
        arrays = {}
        for kind in (0, 1):
            for k in range(order + 1):
                at = np.flatnonzero(slot == 2 * k + kind)
                own = keys[at].view(np.uint64)
                by = np.argsort(own, kind="stable")
                arrays["gamma" if kind else "logp", k] = own[by], value[at][by]
        return arrays

    def find(self, kind: str, k: int, keys: np.ndarray) -> np.ndarray:
        """Values of the keys, NaN where the array has none."""
        have, value = self.arrays[kind, k]
        if not len(have):
            return np.full(len(keys), np.nan, np.float32)
        at = np.minimum(np.searchsorted(have, keys), len(have) - 1)
        return np.where(have[at] == keys, value[at], np.float32(np.nan))

    def logp(self, points: np.ndarray, lang: str | None, k: int) -> np.ndarray:
        """Log probability of the last code point of each row given the k - 1 before it; unseen grams back off."""
        seed = np.uint64(lang_seed(lang))
        if k == 0:
            return np.full(len(points), -np.log(len(self.arrays["logp", 1][0]) + 1.0), np.float32)
        out = self.find("logp", k, gram_hash(points[:, -k:], 0) ^ seed)
        missing = np.flatnonzero(np.isnan(out))
        if len(missing):
            rest = points[missing]
            gamma = self.find("gamma", k - 1, gram_hash(rest[:, len(rest[0]) - k:-1], 0) ^ seed)
            out[missing] = np.where(np.isnan(gamma), 0, np.log(np.maximum(gamma, 1e-12))) + self.logp(rest, lang, k - 1)
        return out

    def words(self, words: list[bytes], lang: str | None) -> np.ndarray:
        """Log probability of each word: the sum over its characters and its end."""
        rows, sizes = spelled(words, self.order)
        logp = self.logp(rows, lang, self.order).astype(np.float64)
        return np.add.reduceat(logp, np.cumsum(sizes) - sizes)


# ---- documents ----------------------------------------------------------------------------------------------------

def repeated(grams: np.ndarray, k: int) -> int:
    """Words covered by k-word windows that are found twice or more."""
    if len(grams) < 2:
        return 0
    _, which, n = np.unique(grams, return_inverse=True, return_counts=True)
    edge = np.zeros(len(grams) + k + 1, np.int64)
    at = np.flatnonzero(n[which] > 1)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + k, -1)
    return int((np.cumsum(edge) > 0).sum())


def duplicate_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def _measure(shared, order: int):
    """Arrow function: counts of each text and the sum of log probabilities of its words."""
    symbol = np.zeros(256, np.uint8)
    symbol[list(SYMBOLS)] = 1

    def run(batches):
        tool, model = Words(), Model(shared.value, order) if shared is not None else None
        for b in batches:
            logp, counts = np.zeros(b.num_rows), []
            for texts, rows, _ in groups([b]):
                langs = b.column("lang").slice(rows[0], len(rows)).to_pylist()
                for lang in set(langs) if model else ():
                    own = [i for i, x in enumerate(langs) if x == lang]
                    place: dict[bytes, int] = {}
                    words = [[place.setdefault(w, len(place)) for w in texts[i].split()] for i in own]
                    if place:
                        each = model.words(list(place), lang)
                        for i, r in zip(own, words):
                            logp[rows[i]] = each[r].sum()
                h, first = tool.texts(texts)
                grams = tool.grams(h, 3)
                for t, a, z in zip(texts, first[:-1], first[1:]):
                    data = np.frombuffer(t, np.uint8)
                    points = int(((data & 0xC0) != 0x80).sum() - tool.space[data].sum())
                    counts.append((int(z - a), points, int(symbol[data].sum()), duplicate_lines(t), repeated(grams[a:max(a, z - 2)], 3)))
            cols = [pa.array([c[k] for c in counts], pa.int64()) for k in range(5)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("lang"), b.column("t"), *cols, pa.array(logp)],
                                             ["doc_id", "lang", "t", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "logp"])
    return run


def bands(scores: DataFrame, width: float, least: float) -> DataFrame:
    """(lang, low, high) log perplexity: median -/+ the larger of ``least`` and ``width`` robust deviations, from counts of
    thousandths, so one pass of partial sums whatever the number of documents."""
    bins = scores.groupBy("lang", F.round(F.col("log_ppl") * BIN).cast("long").alias("x")).agg(F.count("*").alias("n"))

    def middle(df: DataFrame) -> DataFrame:
        up = Window.partitionBy("lang").orderBy("x")
        all_ = Window.partitionBy("lang")
        return (df.withColumn("up", F.sum("n").over(up)).withColumn("all", F.sum("n").over(all_)).where(2 * F.col("up") >= F.col("all"))
                .groupBy("lang").agg(F.min("x").alias("mid")).select(F.col("lang").alias("l"), "mid"))

    med = middle(bins)
    off = (bins.join(med, F.col("lang").eqNullSafe(F.col("l"))).select("lang", "mid", F.abs(F.col("x") - F.col("mid")).alias("x"), "n")
           .groupBy("lang", "mid", "x").agg(F.sum("n").alias("n")))
    mad = middle(off).withColumnRenamed("mid", "mad")
    half = F.greatest(F.lit(least), F.lit(width * 1.4826) * F.col("mad") / BIN)
    return (off.select("lang", "mid").distinct().join(mad, F.col("lang").eqNullSafe(F.col("l")))
            .select("lang", (F.col("mid") / BIN - half).alias("low"), (F.col("mid") / BIN + half).alias("high")))


def quality(docs: DataFrame, order: int = ORDER, width: float = WIDTH, least_width: float = LEAST_WIDTH, id_col: str = "doc_id",
            text_col: str = "text", lang_col: str = "lang", max_grams: int = MAX_GRAMS) -> DataFrame:
    """One row per document: doc_id, text_hash (xxhash64), lang, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, log_ppl
    (natural log of the perplexity per word; null without words), low, high (its language's band), kept.

    base_failed: fewer than 50 words, or more than half of them in repeated 3-word windows.  Documents that pass are kept when
    their perplexity lies in the band, which such documents of their language span; the model is counted on all documents.
    A null text has no words; a null language is one of its own; repeated rows stay; an empty table gives an empty result;
    other columns are dropped.
    """
    source = pick(docs, doc_id=id_col, text=text_col, lang=lang_col).withColumn("t", F.xxhash64("text"))
    spark = docs.sparkSession
    top = cut(gram_counts(source, order))
    model = cut(kneser_ney(top, order))
    small = model.count() <= max_grams
    shared = spark.sparkContext.broadcast(Model.pack(model, order)) if small else None
    kind = source.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"{c} long" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
    scores = source.mapInArrow(trimmed(_measure(shared, order)), f"doc_id {kind}, lang string, t long, {counts}, logp double")
    if not small:
        scores = _joined(source, scores, model, order)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))
    scores = cut(scores.withColumn("base_failed", failed).withColumn("log_ppl", F.when(F.col("n_words") > 0, -F.col("logp") / F.col("n_words"))))
    if small:
        shared.destroy()
    limits = bands(scores.where(~F.col("base_failed")), width, least_width).withColumnRenamed("lang", "l")
    if limits.count() <= 10_000:
        limits = F.broadcast(limits)
    kept = ~F.col("base_failed") & F.coalesce(F.col("log_ppl").between(F.col("low"), F.col("high")), F.lit(True))
    return (scores.join(limits, F.col("lang").eqNullSafe(F.col("l")), "left")
            .select("doc_id", F.col("t").alias("text_hash"), "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "log_ppl", "low", "high", kept.alias("kept")))


def _joined(source: DataFrame, counts: DataFrame, model: DataFrame, order: int) -> DataFrame:
    """Log probabilities by a join of the documents' grams with the model, for models too large to broadcast.  Every gram of the
    documents is in the model, which was counted on them.  Rows with the same id, language and text are added up together, so
    their sum is divided by their number."""
    padded = F.concat(F.lit(START * (order - 1)), F.col("word"), F.lit(END))
    grams = F.transform(F.sequence(F.lit(1), F.length("word") + 1), lambda i: padded.substr(i, F.lit(order)))
    keyed = source.select("doc_id", "lang", "t", F.explode(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+")).alias("word"))
    each = keyed.where("word <> ''").select("doc_id", "lang", "t", F.explode(grams).alias("gram")).groupBy("doc_id", "lang", "t", "gram").agg(F.count("*").alias("n"))
    top = model.where((F.col("m") == order) & F.col("logp").isNotNull()).select(F.col("lang").alias("l"), F.col("gram").alias("g"), F.col("logp").alias("lp"))
    sums = (each.join(top, F.col("lang").eqNullSafe(F.col("l")) & (F.col("gram") == F.col("g")))
            .groupBy("doc_id", "lang", "t").agg(F.sum(F.col("n") * F.col("lp")).alias("sum")))

    def same(a: str, b: str) -> Column:
        return F.col("doc_id").eqNullSafe(F.col(f"id{b}")) & F.col("lang").eqNullSafe(F.col(f"lang{b}")) & (F.col(a) == F.col(f"t{b}"))

    def keys(b: str) -> list[Column]:
        return [F.col(c).alias(f"{k}{b}") for k, c in (("id", "doc_id"), ("lang", "lang"), ("t", "t"))]

    copies = source.groupBy("doc_id", "lang", "t").agg(F.count("*").alias("copies"))
    each_row = sums.join(copies.select(*keys("2"), "copies"), same("t", "2")).select(*keys("1"), (F.col("sum") / F.col("copies")).alias("logp"))
    return counts.drop("logp").join(each_row, same("t", "1"), "left").drop("id1", "lang1", "t1")


def query(spark, sf_dir: str) -> DataFrame:
    out = quality(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "log_ppl")
