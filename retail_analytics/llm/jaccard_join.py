"""N-gram Jaccard join by filters under several global token orders, and the classes its links form.

A token is a hashed shingle.  Under any global order two linked sets share a token of their prefixes, so a candidate pair must
share one under every order, and the intersection is verified.  All orders put tokens first that only one set has, then rare
ones, by a filter and a sketch of fixed size, and differ in the hash behind that.

Large groups never become all pairs: equal sets are one node; a first round links every node with one hub per prefix token;
a second takes, for each prefix token, the pairs across the components that are left, which is exact, since a pair inside a
component changes nothing.  Parity bitmaps of the sets keep pairs out that differ in too many tokens.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import BLOB_SCHEMA, Words, _mix, among, bitmap, blob_batches, cut, groups, ids_filter, ids_hash, level, loose, merged, pick, trimmed

SHINGLE, PERCENT = 3, 90
SEEDS = (0x51A3, 0xC0FFEE11)        # one global order each
PARITY = 8                          # longs of a set's parity bitmap


def sets_of(batches, k: int, column: str = "text"):
    """(row number, sorted distinct hashed shingles, batch) of each document; the whole sequence is one shingle if it has fewer
    than k words."""
    tool = Words()
    for texts, rows, b in groups(batches, column):
        h, first = tool.texts([t.lower() for t in texts])       # bytes.lower() folds A-Z alone
        grams = tool.grams(h, k)
        for row, a, z in zip(rows.tolist(), first[:-1].tolist(), first[1:].tolist()):
            yield row, np.unique(grams[a:z - k + 1] if z - a >= k else tool.grams(h[a:z], z - a) if z > a else h[:0]), b


def prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _all_blobs(k: int):
    def run(batches):
        yield from blob_batches(s for _, s, _ in sets_of(batches, k))
    return run


def prefix(tokens: np.ndarray, again: np.ndarray, levels: np.ndarray, seed: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of the prefix that other sets may have, marked with the order's seed, and their places.

    The order: tokens that only one set has, then by the level of the sketch, then by a hash of the seed.
    """
    size = prefix_size(len(tokens), percent)
    alone = len(tokens) - int(again.sum())
    left = size - alone
    if left <= 0:
        return tokens[:0], np.zeros(0, np.int64)
    some = tokens[again]
    own = _mix(some + np.uint64(seed))
    rank = level(levels, some).astype(np.uint64) << np.uint64(57) | own >> np.uint64(7)
    first = np.argpartition(rank, left - 1)[:left]
    return own[first[np.argsort(rank[first])]], alone + np.arange(left)


PARITY_COLUMNS = [f"b{i}" for i in range(PARITY)]


def parity(tokens: np.ndarray) -> list[int]:
    """A bitmap in which each token flips one bit.  Tokens that two sets share cancel out, so the bits in which their bitmaps differ
    are at most the tokens that only one of them has: more of them than a link allows prove that there is none."""
    flips = np.bincount((_mix(tokens ^ np.uint64(0x9A217)) & np.uint64(64 * PARITY - 1)).astype(np.int64), minlength=64 * PARITY) & 1
    return np.packbits(flips.astype(np.uint8)).view(np.int64).tolist()


def _nodes(shared, k: int, percent: int):
    """Arrow function: size, signature and parity bitmap of each set, and its prefix tokens that may occur elsewhere, by order."""
    def run(batches):
        mask, levels = shared.value
        ids, heads, tokens, places = [], [], [[] for _ in SEEDS], [[] for _ in SEEDS]
        def lists(parts: list[np.ndarray]) -> pa.Array:
            offsets = np.cumsum([0, *map(len, parts)]).astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts)))

        def flush():
            cols = [pa.concat_arrays(ids), *(pa.array(c, pa.int64()) for c in zip(*heads)), *map(lists, tokens), *map(lists, places)]
            ids.clear(), heads.clear(), [x.clear() for x in tokens + places]
            return pa.RecordBatch.from_arrays(cols, ["doc_id", "n", "s1", "s2", *PARITY_COLUMNS, *(f"{c}{i}" for c in "tp" for i in range(len(SEEDS)))])

        for row, s, b in sets_of(batches, k):
            ids.append(b.column("doc_id").slice(row, 1))
            again = among(mask, s)
            for i, seed in enumerate(SEEDS):
                t, at = prefix(s, again, levels, seed, percent)
                tokens[i].append(t.view(np.int64))
                places[i].append(at)
            heads.append((len(s), *(int(_mix(s ^ np.uint64(c)).sum().astype(np.uint64).view(np.int64)) for c in (0x5DEECE66D, 0xABCDEF123457)), *parity(s)))
            if len(heads) >= 2000:
                yield flush()
        if heads:
            yield flush()
    return run


def verify(docs: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (x, y) whose sets are similar enough.  Sets are built again for the documents of a pair alone."""
    pairs = cut(pairs)
    wanted = ids_filter(pairs.select(F.explode(F.array("x", "y"))).distinct())

    def build(batches):
        def chosen():
            for b in batches:
                yes = among(wanted.value, ids_hash(b.column("doc_id").fill_null(0).to_numpy()))
                yield b.filter(pa.array(yes))
        ids, blobs = [], []
        for row, s, b in sets_of(chosen(), k):
            ids.append(b.column("doc_id")[row].as_py())
            blobs.append(s.tobytes())
            if len(ids) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(blobs, pa.binary())], ["id", "s"])
                ids, blobs = [], []
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(blobs, pa.binary())], ["id", "s"])

    def compare(batches):
        for b in batches:
            keep = []
            for x, y in zip(b.column("sx"), b.column("sy")):
                u, v = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                at = np.minimum(np.searchsorted(v, u), len(v) - 1)
                both = int((v[at] == u).sum())
                keep.append(100 * both >= percent * (len(u) + len(v) - both))
            b = b.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([b.column("x"), b.column("y")], ["x", "y"])

    sets = docs.mapInArrow(trimmed(build), "id long, s binary")
    one = sets.select(F.col("id").alias("y"), F.col("s").alias("sy"))
    two = sets.select(F.col("id").alias("x"), F.col("s").alias("sx"))
    links = cut(loose(pairs).join(merged(one), "y").join(merged(two), "x").mapInArrow(trimmed(compare), "x long, y long").distinct())
    wanted.destroy()
    return links


def components(links: DataFrame) -> DataFrame:
    """(id, label): the smallest id that each linked id reaches.  Labels spread over the links and jump to their label's label
    until nothing changes."""
    edges = cut(links.select("x", "y").union(links.select(F.col("y"), F.col("x"))).distinct())
    labels = cut(edges.groupBy(F.col("x").alias("id")).agg(F.min(F.least("x", "y")).alias("label")))
    while True:
        near = (loose(edges).join(merged(loose(labels)), F.col("x") == F.col("id")).groupBy(F.col("y").alias("id")).agg(F.min("label").alias("near")))
        low = cut(labels.join(merged(near), "id").select("id", F.col("label").alias("old"), F.least("label", "near").alias("label")))
        of = low.select(F.col("id").alias("label"), F.col("label").alias("next"))
        labels = cut(loose(low).join(merged(loose(of)), "label").select("id", "old", F.col("next").alias("label")))
        changed = labels.where("old <> label").limit(1).count()
        labels = labels.drop("old")
        if not changed:
            return labels


def jaccard_join(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, class_id (smallest id with an equal set), component_id (smallest id reachable by
    links, itself included).

    Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; the set holds the distinct ``shingle``-word runs, the whole sequence if
    there are fewer words.  Two documents link when 100 * intersection >= percent * union.  Null and empty texts have an empty
    set and no link.  Ids are integers; rows that share one are judged each by its own text, and sets with the same smallest id
    count as one; rows without an id have the component of their set but name none.  An empty table gives an empty result; other columns are dropped.
    """
    source = pick(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    shared = bitmap(source.mapInArrow(trimmed(_all_blobs(shingle)), BLOB_SCHEMA), 2, bits=28, levels=True)
    lists = ", ".join(f"{c}{i} array<long>" for c in "tp" for i in range(len(SEEDS)))
    rows = cut(source.mapInArrow(trimmed(_nodes(shared, shingle, percent)), f"doc_id long, n long, s1 long, s2 long, {', '.join(f'{c} long' for c in PARITY_COLUMNS)}, {lists}"))
    shared.destroy()

    full = rows.where("n > 0")
    classes = cut(full.groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("class_id")))
    member = loose(full.select("doc_id", "n", "s1", "s2")).join(merged(loose(classes)), ["n", "s1", "s2"]).select("doc_id", "n", "class_id")
    one_each = (full.join(merged(classes.select(F.col("class_id").alias("doc_id"), "n", "s1", "s2")), ["doc_id", "n", "s1", "s2"], "left_semi")
                .dropDuplicates(["doc_id", "n", "s1", "s2"]))
    def listed(i: int):
        return F.transform(F.arrays_zip(f"t{i}", f"p{i}"), lambda z: F.struct(F.lit(i).alias("order"), z[f"t{i}"].alias("token"), z[f"p{i}"].alias("place")))

    tokens = cut(one_each.select(F.col("doc_id").alias("id"), "n", F.explode(F.concat(*map(listed, range(len(SEEDS))))).alias("z")).select("id", "n", "z.*"))

    def fits(n: str, m: str):
        return (100 * F.least(n, m) >= percent * F.greatest(n, m))

    def under_all(pairs: DataFrame) -> DataFrame:
        """Pairs found under every order."""
        return (pairs.groupBy("x", "y").agg(F.count_distinct("order").alias("orders")).where(F.col("orders") == len(SEEDS)).select("x", "y"))

    # first round: each node with the smallest node that has its token
    hubs = cut(tokens.groupBy("order", "token").agg(F.min(F.struct("id", "n")).alias("hub"), F.count("*").alias("k")).where("k > 1")
               .select("order", "token", "hub"))
    near = (loose(tokens).join(merged(loose(hubs)), ["order", "token"]).where((F.col("id") != F.col("hub.id")) & fits("n", "hub.n"))
            .select(F.col("id").alias("x"), F.col("hub.id").alias("y"), "order"))
    links = verify(source, under_all(near), shingle, percent)
    label = components(links)

    # second round: all pairs across components under a token; those with a member of the token's largest component once
    placed = cut(tokens.join(merged(label), "id", "left").withColumn("label", F.coalesce("label", "id")))
    sizes = placed.groupBy("order", "token", "label").agg(F.count("*").alias("k"))
    big = cut(sizes.groupBy("order", "token").agg(F.max(F.struct("k", "label")).alias("top"), F.count("*").alias("parts")).where("parts > 1")
              .select("order", "token", F.col("top.label").alias("top")))
    maps = one_each.select(F.col("doc_id").alias("map_id"), *PARITY_COLUMNS)
    mixed = loose(placed).join(merged(loose(big)), ["order", "token"])
    mixed = cut(loose(mixed).join(merged(loose(maps)), F.col("id") == F.col("map_id")).drop("map_id"))

    def bits(side: str):
        return [F.col(c).alias(f"{side}{c}") for c in PARITY_COLUMNS]

    few = mixed.where("label <> top").select("order", "token", F.col("id").alias("x"), F.col("n").alias("nx"), F.col("place").alias("px"), F.col("label").alias("lx"), *bits("x"))
    many = mixed.select("order", "token", F.col("id").alias("y"), F.col("n").alias("ny"), F.col("place").alias("py"), F.col("label").alias("ly"), "top", *bits("y"))
    need = F.ceil(percent * (F.col("nx") + F.col("ny")) / F.lit(100 + percent))
    bound = F.least(F.col("nx") - F.col("px"), F.col("ny") - F.col("py"))      # at the first common token, which is enough
    apart = sum((F.bit_count(F.col(f"x{c}").bitwiseXOR(F.col(f"y{c}"))) for c in PARITY_COLUMNS), F.lit(0))
    across = (loose(few).join(merged(loose(many)), ["order", "token"])
              .where((F.col("lx") != F.col("ly")) & ((F.col("ly") == F.col("top")) | (F.col("x") < F.col("y"))) & fits("nx", "ny") & (bound >= need)
                     & (apart <= F.col("nx") + F.col("ny") - 2 * need))
              .select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"), "order"))
    more = verify(source, under_all(across), shingle, percent)
    if not more.isEmpty():                  # else the components of the first round are the result
        label = components(links.union(more))

    found = loose(member).join(merged(loose(label).withColumnRenamed("id", "class_id")), "class_id", "left")
    done = found.select("doc_id", F.col("n").alias("n_shingles"), "class_id", F.coalesce("label", "class_id").alias("component_id"))
    return done.union(rows.where("n = 0").select("doc_id", F.col("n"), F.col("doc_id"), F.col("doc_id")))


def query(spark, sf_dir: str) -> DataFrame:
    return jaccard_join(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_shingles", "component_id")
