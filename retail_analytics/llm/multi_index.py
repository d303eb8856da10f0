"""Approximate nearest neighbours by an inverted multi-index.

Both halves of the vectors are quantised on their own; a cell is a pair of centroids.  A query walks the cells in the order of
their summed distance with a heap until the cells walked hold its share of all entries, and the entries of these cells are
reranked by their exact distance.  The share is found on the sample that the centroids are fitted on, for a wanted recall.

Entries lie by their first centroid, in blocks of bounded size, so a centroid that holds a third of all vectors is many blocks.  A
query is sent once to each block of a centroid it meets, with a bitmap of the second centroids; a block answers with its nearest.
"""
from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, Window as W
from pyspark.sql.types import ArrayType, FloatType

from .common import cut, pick

CENTROIDS = 64                  # of each half
SAMPLE = 16_384                 # vectors that the centroids and the share are fitted on
TRIALS = 512                    # of them that are searched for the share
RECALL = 0.96                   # wanted on the sample
BLOCK = 8_192                   # vectors of a centroid in one block, about
MAX_ROWS = 65_536               # query vectors that a task holds at a time
NARROW = 1e-9                   # distances nearer than this are compared again without the expansion's rounding


def kmeans(points: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Centroids of the points: k-means++ from a fixed seed, then Lloyd's steps; at most as many as there are distinct points."""
    rnd = np.random.default_rng(7)
    centres = points[:1].copy()
    near = ((points - centres[0]) ** 2).sum(1)
    while len(centres) < k and near.max() > 0:
        centres = np.vstack([centres, points[rnd.choice(len(points), p=near / near.sum())]])
        near = np.minimum(near, ((points - centres[-1]) ** 2).sum(1))
    for _ in range(rounds):
        own = nearest(points, centres)
        n = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def squares(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, points by centres."""
    return np.maximum((points ** 2).sum(1)[:, None] + (centres ** 2).sum(1)[None] - 2 * points @ centres.T, 0)


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.concatenate([squares(points[i:i + 4096], centres).argmin(1) for i in range(0, len(points), 4096)] or [np.zeros(0, np.int64)])


def walk(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, wanted: float):
    """Cells (i, j) with entries by rising ``first[i] + second[j]`` until they hold ``wanted`` entries; ``sizes`` are entries by cell.
    The heap merges the rows of the table of sums; a row enters with its first cell when that of the row before it is walked."""
    by_i, by_j = np.argsort(first, kind="stable").tolist(), np.argsort(second, kind="stable").tolist()
    a, b, n = first[by_i].tolist(), second[by_j].tolist(), sizes[np.ix_(by_i, by_j)].tolist()
    heap, held = [(a[0] + b[0], 0, 0)], 0
    while heap and held < wanted:
        _, i, j = heapq.heappop(heap)
        if n[i][j]:
            held += n[i][j]
            yield by_i[i], by_j[j]
        if j + 1 < len(b):
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))


def share_for(sample: np.ndarray, first: np.ndarray, second: np.ndarray, k: int, recall: float, trials: int) -> float:
    """Share of all entries that a walk has to hold so that ``recall`` of the sample's k nearest are among them."""
    half, m = sample.shape[1] // 2, len(sample)
    if m <= 20 * k:
        return 1.0
    one, two = nearest(sample[:, :half], first), nearest(sample[:, half:], second)
    need = []
    for at in range(0, min(trials, m), 64):
        q = sample[at:min(at + 64, trials, m)]
        rows = np.arange(len(q))[:, None]
        exact = squares(q, sample)
        exact[rows[:, 0], at + rows[:, 0]] = np.inf
        found = np.argpartition(exact, k, axis=1)[:, :k]
        walked = squares(q[:, :half], first)[:, one] + squares(q[:, half:], second)[:, two]
        need.append([np.searchsorted(np.sort(w), w[f], "right") / m for w, f in zip(walked, found)])
    return float(np.quantile(np.concatenate([np.ravel(x) for x in need]), recall))


def _matrix(column) -> np.ndarray:
    """Rows of an Arrow list column of equal lengths, in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _best(entries: pa.Table, queries: pa.Table, k: int):
    """For each query the k nearest of the entries in its cells: (query row, entry row, distance) arrays."""
    x, q = _matrix(entries.column("v")), _matrix(queries.column("v"))
    cell = entries.column("j").to_numpy()
    ids, rid, q_rid = entries.column("vec_id").to_pandas(), entries.column("rid").to_numpy(), queries.column("rid").to_numpy()
    ids, unknown = ids.fillna(0).to_numpy(np.int64), ids.isna().to_numpy()
    cells = np.stack([np.unpackbits(np.frombuffer(m, np.uint8)) for m in queries.column("cells").to_pylist()]).astype(bool)
    order = np.argsort(cell, kind="stable")
    edges = np.searchsorted(cell[order], np.arange(cells.shape[1] + 1))
    xx, qq = (x ** 2).sum(1), (q ** 2).sum(1)
    out = []
    for at in range(0, len(q), 256):
        to = min(at + 256, len(q))
        far = np.full((to - at, len(x)), np.inf)
        for j in np.flatnonzero(np.diff(edges)):
            who, cols = np.flatnonzero(cells[at:to, j]), order[edges[j]:edges[j + 1]]
            if len(who):
                far[np.ix_(who, cols)] = qq[at + who, None] + xx[cols] - 2 * q[at + who] @ x[cols].T
        own = {r: i for i, r in enumerate(q_rid[at:to].tolist())}
        for e in np.flatnonzero(np.isin(rid, q_rid[at:to])):
            far[own[int(rid[e])], e] = np.inf
        edge = np.partition(far, min(k, len(x)) - 1, axis=1)[:, min(k, len(x)) - 1]
        edge = edge + NARROW * (qq[at:to] + xx.max())
        i, e = np.nonzero((far <= edge[:, None]) & (far < np.inf))
        d = np.concatenate([np.sqrt(((q[at + i[s:s + 65536]] - x[e[s:s + 65536]]) ** 2).sum(1)) for s in range(0, len(i), 65536)] or [np.zeros(0)])
        by = np.lexsort((rid[e], ids[e], unknown[e], d, i))
        i, e, d = i[by], e[by], d[by]
        first = np.searchsorted(i, np.arange(to - at))
        keep = np.arange(len(i)) - first[i] < k
        out.append((at + i[keep], e[keep], d[keep]))
    return tuple(np.concatenate(z) for z in zip(*out))


def search(vectors: DataFrame, queries: str, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", centroids: int = CENTROIDS,
           sample: int = SAMPLE, recall: float = RECALL, block: int = BLOCK, max_rows: int = MAX_ROWS) -> DataFrame:
    """For each row that the SQL condition ``queries`` (over vec_id) takes, its k nearest other rows that were found: query_id, rank
    from 1, vec_id, score (Euclidean distance of the original vectors in double precision), ties to the smaller vec_id, null last.

    The centroids and the share of entries to walk are fitted on at most ``sample`` rows; every row is in the index.  Rows that
    share a vec_id are rows of their own, as queries and as entries.  Vectors that are null, empty, zero or hold a null or non-finite
    component take no part, nor those of another length than most (the smaller of two lengths as frequent).  A query gets all
    other rows if there are at most k; no rows give none; other columns are dropped.  Squares of components must not overflow.
    """
    spark = vectors.sparkSession
    v = F.col("v")
    fine = F.forall(v, lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False))) & F.exists(v, lambda c: c != 0)
    source = pick(vectors, vec_id=id_col, v=vector_col).select(F.col("vec_id").cast("long").alias("vec_id"), "v").where(fine)
    kind = source.schema["v"].dataType.elementType
    if not isinstance(kind, FloatType):
        source = source.withColumn("v", v.cast("array<double>"))
    base = cut(source.select(F.monotonically_increasing_id().alias("rid"), "vec_id", "v"))
    answer = "query_id long, rank int, vec_id long, score double"
    sizes = base.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    if not sizes:
        return spark.createDataFrame([], answer)
    d, n = sizes[0]
    base = base.where(F.size("v") == d)
    asked = base.where(queries).count()
    part = min(1.0, 1.2 * sample / n)
    seen = base.where(F.pmod(F.xxhash64("rid"), F.lit(1 << 30)) < int(part * (1 << 30))).select("v").limit(sample).toArrow()
    seen = _matrix(seen.column("v")) if seen.num_rows else _matrix(base.select("v").limit(sample).toArrow().column("v"))
    half = d // 2
    first, second = kmeans(seen[:, :half], centroids), kmeans(seen[:, half:], centroids)
    share = share_for(seen, first, second, k, recall, TRIALS)

    kept = ArrayType(FloatType()).simpleString() if isinstance(kind, FloatType) else "array<double>"

    def assign(batches):
        for b in batches:
            x = _matrix(b.column("v"))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(nearest(x[:, :half], first), pa.int32()), pa.array(nearest(x[:, half:], second), pa.int32())],
                                             ["rid", "vec_id", "v", "i", "j"])

    index = base.mapInArrow(assign, f"rid long, vec_id long, v {kept}, i int, j int")
    held = np.zeros((len(first), len(second)), np.int64)
    for i, j, rows in index.groupBy("i", "j").count().collect():            # a row for each cell: centroids squared at most
        held[i, j] = rows
    blocks = (-(-held.sum(1) // block)).tolist()
    chunks = -(-asked // max_rows)
    wanted = max(share * n, k + 1)

    def probes(batches):
        """For each query and first centroid that it meets, a row for each block, with a bitmap of the second centroids."""
        for b in batches:
            x = _matrix(b.column("v"))
            one, two = squares(x[:, :half], first), squares(x[:, half:], second)
            rows, at, part, cells = [], [], [], []
            for r in range(len(x)):
                met: dict[int, np.ndarray] = {}
                for i, j in walk(one[r], two[r], held, wanted):
                    met.setdefault(i, np.zeros(len(second), np.uint8))[j] = 1
                for i, bits in met.items():
                    rows += [r] * blocks[i]
                    at += [i] * blocks[i]
                    part += range(blocks[i])
                    cells += [np.packbits(bits).tobytes()] * blocks[i]
            own = b.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*own.columns, pa.array(at, pa.int32()), pa.array(part, pa.int32()), pa.array(cells, pa.binary())],
                                             ["rid", "vec_id", "v", "i", "block", "cells"])

    chunk = F.pmod(F.xxhash64("rid"), F.lit(max(chunks, 1))).cast("int")
    asks = base.where(queries).mapInArrow(probes, f"rid long, vec_id long, v {kept}, i int, block int, cells binary").withColumn("chunk", chunk)
    mine = F.pmod(F.xxhash64("rid"), F.element_at(F.array(*map(F.lit, [max(x, 1) for x in blocks])), F.col("i") + 1)).cast("int")
    entries = index.withColumn("block", mine).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(max(chunks, 1) - 1))))

    def near(own: pa.Table, asked: pa.Table) -> pa.Table:
        names = ["rid", "query_id", "vec_id", "entry", "score"]
        if not own.num_rows or not asked.num_rows:
            return pa.table([pa.array([], pa.int64())] * 4 + [pa.array([], pa.float64())], names)
        q, e, far = _best(own, asked, k)
        return pa.table([*(c.combine_chunks() for c in asked.select(["rid", "vec_id"]).take(pa.array(q)).columns),
                         *(c.combine_chunks() for c in own.select(["vec_id", "rid"]).take(pa.array(e)).columns), pa.array(far)], names)

    key = ["i", "block", "chunk"]
    found = entries.groupBy(key).cogroup(asks.groupBy(key)).applyInArrow(near, "rid long, query_id long, vec_id long, entry long, score double")
    order = W.partitionBy("rid").orderBy("score", F.col("vec_id").asc_nulls_last(), "entry")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id % 100 = 0")
