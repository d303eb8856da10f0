"""Toxicity by a weighted finite-state grammar: a lexicon transducer turns words into classes, and transducers for targets,
negation, reported speech and threats are composed with it, so that clauses are scored and not single words.

The insult lexicon (words and word beginnings) and the scale of the score are learned from labelled documents.
"""
from __future__ import annotations

import math
import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import Words, pick, texts_of

TRAIN_ROWS = 20_000            # at most so many labelled rows are learned from, those with the smallest hash of their id
MAX_ENTRIES = 4_000            # entries of the learned lexicon
PREFIXES = (4, 5, 6)           # letters of a word beginning
SURE, PRECISION = 0.9, 0.4     # share of toxic documents among those with an entry: of full weight, at least
UNSURE = 0.4                   # weight of an entry that is just below SURE; a document needs several of them
REACH = 4                      # words over which a target, a negation or a threat reaches

# ---- fixed values: function words of the grammar ------------------------------------------------------------------
TARGETS = set("you your yours youre he she they them their him her his these those this we all everyone people "
              "du dich dir dein deine ihr euch sie er ihn ihm diese dieser dieses "
              "tu toi te ton ta tes vous votre vos il elle ils elles lui ce cet cette ces "
              "tú ti usted ustedes vosotros él ella ellos ellas este esta estos estas ese esa".split())
NEGATIONS = set("not no never none neither nor without isnt arent wasnt dont doesnt didnt cannot cant "
                "nicht kein keine keinen nie niemals ohne weder pas jamais aucun aucune sans ni nunca jamás ningún ninguna sin tampoco".split())
REPORTS = set("said says say saying told claimed claims wrote writes called calls quoted according heard reported alleged "
              "sagte sagt sagen behauptet behauptete schrieb nannte laut zitierte "
              "dit disait dire écrit affirme prétend appelé selon cité "
              "dijo dice decir dicen escribió afirma afirmó llamó según citó".split())
THREATS = set("kill hurt destroy beat shoot stab hang burn punish töten umbringen schlagen vernichten erschießen "
              "tuer frapper détruire brûler pendre matar golpear destruir quemar disparar".split())
INTENTS = set("will shall gonna going must should deserve deserves werde werden wird sollte sollst vais va vas allons dois doit voy vamos debe debes".split())
WEIGHTS = {"directed": 1.5, "plain": 1.0, "negated": 0.2, "reported": 0.4, "threat": 2.0}
# -------------------------------------------------------------------------------------------------------------------
_CLAUSE = re.compile(r"[.!?;:\n\r]+")
_WORD = re.compile(r"[^\W\d_]+|[\"«»“”„]")
FEATURES = ["total", "peak", "clauses", "rate"]


class Lexicon:
    """Word -> class transducer.  An automaton over all entries finds the places where a document can score at all."""

    def __init__(self, words: dict[str, float], beginnings: dict[str, float]):
        self.words, self.beginnings = words, beginnings
        self.finder = ahocorasick.Automaton()
        for w in {*words, *beginnings, *THREATS}:
            self.finder.add_word(w, len(w))
        self.finder.make_automaton()

    def places(self, low: str) -> list[int]:
        """Starts of entries that begin a word."""
        return [s for s in (end - n + 1 for end, n in self.finder.iter(low)) if s == 0 or not low[s - 1].isalpha()]

    def insult(self, word: str) -> float:
        w = self.words.get(word, 0.0)
        for k in PREFIXES:
            w = max(w, self.beginnings.get(word[:k], 0.0) if len(word) >= k else 0.0)
        return w

    def classes(self, word: str) -> tuple[str, float]:
        if w := self.insult(word):
            return "INSULT", w
        for name, group in (("THREAT", THREATS), ("NEG", NEGATIONS), ("REPORT", REPORTS), ("INTENT", INTENTS), ("TARGET", TARGETS)):
            if word in group:
                return name, 0.0
        return ("QUOTE" if not word[0].isalpha() else "OTHER"), 0.0


def reach(opens: set[str], name: str):
    """Transducer that marks the words up to REACH after one of the classes ``opens``; its state is the reach that is left."""
    def step(state: int, cls: str, marks: frozenset) -> tuple[int, frozenset]:
        out = marks | {name} if state > 0 else marks
        return (REACH if cls in opens else max(state - 1, 0)), out
    return step


def reported(state: int, cls: str, marks: frozenset) -> tuple[int, frozenset]:
    """Marks all that follows a reporting verb in the clause, and what stands between quotation marks (state bit 2)."""
    if cls == "QUOTE":
        state ^= 2
    out = marks | {"reported"} if state else marks
    return (state | 1 if cls == "REPORT" else state), out


CHAIN = [reach({"NEG"}, "negated"), reported, reach({"TARGET"}, "aimed"), reach({"INTENT"}, "meant")]


def clause_score(words: list[str], lexicon: Lexicon) -> float:
    """Weight of one clause: the composed transducers run over the word classes; an insult counts as directed when a target
    stands before it or after it within reach, less when negated or reported; a harm verb is a threat only with an intent."""
    classes = [lexicon.classes(w) for w in words]
    states, total = [0] * len(CHAIN), 0.0
    for i, (cls, weight) in enumerate(classes):
        marks: frozenset = frozenset()
        for k, step in enumerate(CHAIN):
            states[k], marks = step(states[k], cls, marks)
        aimed = "aimed" in marks or any(c == "TARGET" for c, _ in classes[i + 1:i + 1 + REACH])
        if cls == "INSULT":
            kind = "directed" if aimed else "plain"
        elif cls == "THREAT" and "meant" in marks and aimed:
            kind, weight = "threat", 1.0
        else:
            continue
        value = WEIGHTS[kind] * weight
        for m in ("negated", "reported"):
            if m in marks:
                value *= WEIGHTS[m]
        total += value
    return total


def document_features(text: str, lexicon: Lexicon) -> tuple[float, float, float, float]:
    """(total of the clause scores, best clause, scored clauses, total per square root of 100 words), logs of the first and last."""
    low = text.lower()
    places = lexicon.places(low)
    if not places:
        return 0.0, 0.0, 0.0, 0.0
    scores, at, start = [], 0, 0
    ends = [(m.start(), m.end()) for m in _CLAUSE.finditer(low)] + [(len(low), len(low))]
    for stop, after in ends:
        if at < len(places) and places[at] < stop:
            scores.append(clause_score(_WORD.findall(low[start:stop]), lexicon))
        while at < len(places) and places[at] < after:
            at += 1
        start = after
    total = sum(scores)
    return math.log1p(total), min(max(scores, default=0.0), 4.0), math.log1p(sum(s > 0 for s in scores)), math.log1p(total / math.sqrt(1 + len(low) / 600))


def fit(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, steps: int = 50) -> np.ndarray:
    """Logistic regression with a ridge penalty on the slopes, by Newton steps; weights (bias first)."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w, ridge = np.zeros(x.shape[1]), np.diag([1e-6] + [penalty] * (x.shape[1] - 1))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T * (p * (1 - p)) @ x + ridge, x.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def learn_lexicon(train: DataFrame, max_entries: int = MAX_ENTRIES) -> tuple[dict[str, float], dict[str, float]]:
    """Words and word beginnings found mostly in toxic documents, from rows (text, toxic), with their weights.

    Documents whose smallest 3-word shingle is equal count once, else the words of a copied document would look typical.  An
    entry needs PRECISION and a log likelihood ratio that chance would not bring among so many tokens.
    """
    def tokens(batches):
        tool, rows = Words(), []

        def flush():
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int32()))],
                                              ["token", "sign", "toxic"])
        for b in batches:
            for text, toxic in zip(texts_of(b), b.column("toxic").to_pylist()):
                h, _ = tool.texts([text])
                grams = tool.grams(h, 3)
                sign = int((grams if len(grams) else h).min().view(np.int64)) if len(h) else 0
                words = {w for w in _WORD.findall(text.decode("utf-8").lower()) if len(w) > 2}
                rows += [(w, sign, toxic) for w in words]
                rows += [(w, sign, toxic) for w in {f"{x[:k]}*" for x in words for k in PREFIXES if len(x) >= k}]
                if len(rows) > 100_000:
                    yield flush()
                    rows = []
        if rows:
            yield flush()

    seen = train.mapInArrow(tokens, "token string, sign long, toxic int").groupBy("token", "sign").agg(F.max("toxic").alias("toxic"))
    counts = seen.groupBy("token").agg(F.sum("toxic").alias("pos"), F.count("*").alias("n"))
    base = train.agg(F.avg("toxic"), F.count("*")).first()
    if not base[1] or not 0 < base[0] < 1:
        return {}, {}
    n_tokens = counts.count()
    share = F.least(F.col("pos") / F.col("n"), F.lit(1 - 1e-9))
    ratio = F.col("pos") * F.log(share / base[0]) + (F.col("n") - F.col("pos")) * F.log((1 - share) / (1 - base[0]))
    rows = (counts.where((share >= max(PRECISION, base[0])) & (ratio >= math.log(100 * (n_tokens + 1)))).withColumn("share", share)
            .orderBy(F.desc(ratio), "token").limit(max_entries).collect())
    strength = {r["token"]: 1.0 if r["share"] >= SURE else UNSURE * r["share"] / SURE for r in rows}
    words = {t: w for t, w in strength.items() if not t.endswith("*")}
    return words, {t[:-1]: w for t, w in strength.items() if t.endswith("*")}


def _features(lexicon_data: tuple[dict, dict], keep: list[str]):
    def run(batches):
        lexicon = Lexicon(*lexicon_data)
        for b in batches:
            found = [document_features(t.decode("utf-8"), lexicon) for t in texts_of(b)]
            cols = [pa.array([f[i] for f in found], pa.float64()) for i in range(len(FEATURES))]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in keep), *cols], [*keep, *FEATURES])
    return run


FEATURE_SCHEMA = ", ".join(f"{f} double" for f in FEATURES)


def toxicity(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text",
             label_id_col: str = "doc_id", label_col: str = "toxic") -> DataFrame:
    """One row per document: doc_id, score (0 to 1), total (log of the sum of clause weights), clauses (log of their number).

    Learns from at most ``train_rows`` rows of ``labels``; an id with several labels counts as toxic if one of them is, of an
    id with several texts one is learned from, null labels and ids don't count.  Null and empty texts have no clause and the score of such documents; repeated rows stay; an
    empty table gives an empty result; without labels of both kinds the score is 1 - exp(-total).  Other columns are dropped.
    """
    source = pick(docs, doc_id=id_col, text=text_col)
    known = (pick(labels, doc_id=label_id_col, toxic=label_col).where("doc_id is not null and toxic is not null")
             .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows))
    one = F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")                  # of rows that share an id, one text
    train = source.join(F.broadcast(known), "doc_id").groupBy("doc_id").agg(one, F.max("toxic").alias("toxic")).select("text", "toxic").persist()
    lexicon = learn_lexicon(train)
    rows = train.mapInArrow(_features(lexicon, ["toxic"]), f"toxic int, {FEATURE_SCHEMA}").toPandas()
    train.unpersist()
    y = rows["toxic"].to_numpy(float)
    w = fit(rows[FEATURES].to_numpy(float), y) if len(y) and 0 < y.mean() < 1 else None
    kind = source.schema["doc_id"].dataType.simpleString()
    found = source.mapInArrow(_features(lexicon, ["doc_id"]), f"doc_id {kind}, {FEATURE_SCHEMA}")
    if w is None:
        score = 1 - F.exp(-F.col("total"))
    else:
        score = 1 / (1 + F.exp(-sum((F.col(f) * float(c) for f, c in zip(FEATURES, w[1:])), F.lit(float(w[0])))))
    return found.select("doc_id", score.alias("score"), "total", "clauses")


def held_out(doc_id):
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def query(spark, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = toxicity(spark.read.parquet(f"{sf_dir}/documents.parquet"), labels.where(~held_out(F.col("doc_id"))))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
