"""Shared helpers: column projection, checkpoints, hashed words and fixed-size filters."""
from __future__ import annotations

import ctypes
import functools
import gc
import inspect
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

_U = np.uint64
_BASE, _GRAM = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F | 1     # odd, so they have inverses modulo 2**64
_BLOCK = 1 << 18
ROWS_PER_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def pick(df: DataFrame, **cols: str) -> DataFrame:
    """Only the named columns, under the operator's own names: other columns, also clashing ones, never get in.

    Texts reach the tasks in Arrow batches of rows.  A session that left Spark's default of 10,000 rows, which bounds no bytes,
    gets 1,000; its own setting stays.
    """
    conf = df.sparkSession.conf
    if conf.get(ROWS_PER_BATCH) == "10000":
        conf.set(ROWS_PER_BATCH, "1000")
    return df.select([df[src].alias(dst) for dst, src in cols.items()])


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared folder.  Where the session names none, a temporary one if all runs on this machine (tests); a cluster
    without one is an error, as its executors share no other folder."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        named = sc.getConf().get("spark.checkpoint.dir")
        if not named and not sc._jsc.isLocal():
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint in the shared folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """The rows as a compressed table in the shared folder, read again; for rows too wide for a checkpoint."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def trim() -> None:
    """Gives a worker's free memory back to the machine.  Spark keeps Python workers for later tasks, and what their allocators
    hold of the last task would count besides what the next stage needs."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):       # another C library
        pass


def trimmed(task):
    """An Arrow function (iterator to iterator, or two tables to one) that trims its worker at its end."""
    if inspect.isgeneratorfunction(task):
        @functools.wraps(task)
        def run(batches):
            try:
                yield from task(batches)
            finally:
                trim()
        return run

    @functools.wraps(task)
    def whole(left, right):
        try:
            return task(left, right)
        finally:
            trim()
    return whole


def loose(df: DataFrame) -> DataFrame:
    """Forget how the rows are partitioned, so that a later join shuffles this side anew and AQE may split hot keys."""
    return df.coalesce(1 << 20)


def merged(df: DataFrame) -> DataFrame:
    """A side of a join that is shuffled and merged at any size: dozens of small broadcasts would each be collected, hashed and kept
    in the driver."""
    return df.hint("merge")


# ---- hashed words -------------------------------------------------------------------------------------------------

def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, _U)
    p[0] = 1
    return np.multiply.accumulate(p)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


class Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a list of UTF-8 texts: 64-bit hashes, byte ranges, first word of each text."""

    def __init__(self):
        self.table = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.int64).astype(_U)
        self.space = np.zeros(256, bool)
        self.space[[32, *range(9, 14)]] = True
        self.tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def powers(self, base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        if base not in self.tables or len(self.tables[base][0]) < n:
            n = max(n, _BLOCK * 2)
            self.tables[base] = _powers(base, n), _powers(pow(base, -1, 1 << 64), n)
        return self.tables[base]

    def split(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, start, end) of each word of one piece of bytes."""
        a = np.frombuffer(data, np.uint8)
        gap = np.ones(len(a) + 2, bool)
        gap[1:-1] = self.space[a]
        edge = np.flatnonzero(gap[1:] != gap[:-1])
        start, end = edge[::2], edge[1::2]
        up, down = self.powers(_BASE, len(a) + 1)
        total = np.zeros(len(a) + 1, _U)
        np.cumsum(self.table[a] * up[:len(a)], out=total[1:])
        return _mix((total[end] - total[start]) * down[start] + _U(1)), start, end

    def texts(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words of all texts and, for text i, the range first[i]:first[i + 1]."""
        hashes, counts, i = [], np.zeros(len(texts) + 1, np.int64), 0
        while i < len(texts):
            j, size = i, 0
            while j < len(texts) and (j == i or size + len(texts[j]) <= _BLOCK):
                size += len(texts[j]) + 1
                j += 1
            offset = np.cumsum([0] + [len(t) + 1 for t in texts[i:j]])
            if j == i + 1 and size > 4 * _BLOCK:
                h = self._long(texts[i])
                counts[i + 1] = len(h)
            else:
                h, start, _ = self.split(b"\n".join(texts[i:j]))
                counts[i + 1:j + 1] = np.diff(np.searchsorted(start, offset))
            hashes.append(h)
            i = j
        return np.concatenate(hashes) if hashes else np.zeros(0, _U), np.cumsum(counts)

    def _long(self, text: bytes) -> np.ndarray:
        """Words of a very long text, block by block, cut at white space."""
        out, at = [], 0
        while at < len(text):
            to = min(at + _BLOCK, len(text))
            while to < len(text) and not self.space[text[to]]:
                to += 1
            out.append(self.split(text[at:to])[0])
            at = to
        return np.concatenate(out)

    def grams(self, words: np.ndarray, k: int) -> np.ndarray:
        """Hash of the k words from each position on (len(words) - k + 1 values, none if there are fewer words)."""
        n = len(words) - k + 1
        if n <= 0:
            return np.zeros(0, _U)
        if k == 1:
            return _mix(words + _U(k))
        total = np.zeros(len(words) + 1, _U)
        up, down = self.powers(_GRAM, len(words) + 1)
        np.cumsum(words * up[:len(words)], out=total[1:])
        return _mix((total[k:] - total[:n]) * down[:n] + _U(k))


def sliding_min(a: np.ndarray, span: int) -> np.ndarray:
    """Smallest of each ``span`` consecutive values, by doubling."""
    if len(a) < span:
        return a[:0]
    size = 1
    while 2 * size <= span:
        a = np.minimum(a[:-size], a[size:])
        size *= 2
    return a if size == span else np.minimum(a[:len(a) - (span - size)], a[span - size:])


def owners(first: np.ndarray) -> np.ndarray:
    """Text number of each word, from the ranges that ``Words.texts`` returns."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    return [x or b"" for x in batch.column(name).cast(pa.binary()).to_pylist()]


def groups(batches, column: str = "text", size: int = 1 << 18):
    """(texts, their row numbers, batch) in groups of bounded size, or of one text; only a group is held as Python objects."""
    for b in batches:
        if not b.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        i = 0
        while i < b.num_rows:
            j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + size, "right")))
            yield texts_of(b.slice(i, j - i), column), np.arange(i, j), b
            i = j


# ---- fixed-size filters -------------------------------------------------------------------------------------------
# Values met at least twice, or any values, as a bitmap of 2**26 or 2**28 bits.  Its size doesn't grow with the data; it
# only keeps rows out of later shuffles.  A wrong "yes" costs a row that the exact step after it drops.

_SKIP = 65535


def _pack(values: np.ndarray) -> bytes:
    """Sorted integers as 16-bit gaps; a gap of 65535 or more starts with marks that each stand for 65535."""
    gaps = np.diff(values.astype(np.int64), prepend=0)
    skips = gaps // _SKIP
    out = np.full(len(gaps) + int(skips.sum()), _SKIP, np.uint16)
    out[np.cumsum(skips + 1) - 1] = gaps % _SKIP
    return out.tobytes()


def _unpack(blob: bytes) -> np.ndarray:
    gaps = np.frombuffer(blob, np.uint16)
    return np.cumsum(gaps, dtype=np.int64)[gaps != _SKIP]


def _blobs(values: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Sorted 32-bit prefixes of hashes, cut into 256 ranges."""
    v = np.sort((values >> _U(32)).astype(np.uint32))
    edges = np.searchsorted(v, np.arange(257, dtype=np.uint64) << _U(24))
    for b in range(256):
        if edges[b] < edges[b + 1]:
            yield b, _pack(v[edges[b]:edges[b + 1]] & np.uint32(0xFFFFFF))


def blob_batches(parts: Iterator[np.ndarray], size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow rows (bucket, blob) of hash arrays, gathered up to ``size`` values."""
    held, n = [], 0
    for p in parts:
        held.append(p)
        n += len(p)
        if n >= size:
            yield _blob_batch(held)
            held, n = [], 0
    if n:
        yield _blob_batch(held)


def _blob_batch(held: list[np.ndarray]) -> pa.RecordBatch:
    rows = list(_blobs(np.concatenate(held)))
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())],
                                      ["bucket", "blob"])


BLOB_SCHEMA = "bucket int, blob binary"
LEVELS = 21                        # counters of the frequency sketch: 2**21


def _set(bitmap_: np.ndarray, at: np.ndarray) -> None:
    np.bitwise_or.at(bitmap_, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))


def _fold(least: int, bits: int):
    """Arrow function over rows sorted by bucket: per bucket the bitmap, and for each sketch counter the power of two of its count.
    Repeats are found at 32 bits and marked at ``bits``; one bucket is held at a time."""
    def one(batches):
        now, marked, counts, once = None, None, None, None

        def done():
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([marked.tobytes()], pa.binary()),
                                               pa.array([np.log2(counts + 1.0).astype(np.uint8).tobytes()], pa.binary())], ["bucket", "blob", "levels"])
        for batch in batches:
            for bucket, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                if bucket != now:
                    if now is not None:
                        yield done()
                    now, marked, counts = bucket, np.zeros(1 << (bits - 11), np.uint8), np.zeros(1 << (LEVELS - 8), np.int64)
                    once = np.zeros(1 << 21 if least > 1 else 1, np.uint8)
                v = _unpack(blob.as_buffer())
                counts += np.bincount(v >> (32 - LEVELS), minlength=len(counts))
                if least > 1:
                    new = np.ones(len(v), bool)
                    new[1:] = v[1:] != v[:-1]
                    u = v[new]
                    again = (once[u >> 3] >> (u & 7).astype(np.uint8)) & 1 > 0
                    again |= np.diff(np.append(np.flatnonzero(new), len(v))) > 1
                    _set(once, u)
                    v = u[again]
                _set(marked, v >> (32 - bits))
        if now is not None:
            yield done()
    return one


def _compressed(fold):
    """The Arrow function ``fold`` with its bitmaps and counters compressed."""
    def run(batches):
        for b in fold(batches):
            packed = [pa.array([pa.compress(x.as_buffer(), "zstd", asbytes=True) for x in c], pa.binary()) for c in b.columns[1:]]
            yield pa.RecordBatch.from_arrays([b.column(0), *packed], b.schema.names)
    return run


def _whole(pieces: dict[int, bytes], size: int) -> np.ndarray:
    out = np.zeros((256, size), np.uint8)
    for bucket, piece in pieces.items():
        out[bucket] = np.frombuffer(pa.decompress(piece, size, "zstd"), np.uint8)
    return out.reshape(-1)


class Pieces:
    """The compressed pieces of an array of 256 buckets.  The driver never puts them together; unpickled, in a task, they are the array."""

    def __init__(self, buckets: pa.ChunkedArray, pieces: pa.ChunkedArray, size: int):
        self.pieces, self.size = dict(zip(buckets.to_pylist(), pieces.to_pylist())), size

    def __reduce__(self):
        return _whole, (self.pieces, self.size)


def bitmap(blobs: DataFrame, least: int, bits: int = 26, levels: bool = False):
    """Broadcast filter of the hashes met at least ``least`` (1 or 2) times, from rows (bucket, blob); at most 2**bits bits pass the
    driver, compressed.  With ``levels`` the pair (filter, sketch): the sketch has a byte for each of 2**21 ranges of hashes, the
    power of two of the number of values in it."""
    spark = blobs.sparkSession
    rows = blobs.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(trimmed(_compressed(_fold(least, bits))), "bucket int, blob binary, levels binary")
    table = (rows if levels else rows.drop("levels")).toArrow()
    mask = Pieces(table.column(0), table.column(1), 1 << (bits - 8 - 3))
    return spark.sparkContext.broadcast((mask, Pieces(table.column(0), table.column(2), 1 << (LEVELS - 8))) if levels else mask)


def among(mask: np.ndarray, values: np.ndarray) -> np.ndarray:
    """For each hash whether the filter has it."""
    at = (values >> _U(64 - (len(mask) * 8).bit_length() + 1)).astype(np.int64)
    return (mask[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def level(sketch: np.ndarray, values: np.ndarray) -> np.ndarray:
    return sketch[(values >> _U(64 - LEVELS)).astype(np.int64)]


def ids_hash(ids: np.ndarray) -> np.ndarray:
    return _mix(ids.astype(np.int64).view(_U) + _U(0x51))


def ids_filter(ids: DataFrame):
    """Broadcast filter of the long ids in the first column."""
    def emit(batches):
        yield from blob_batches(ids_hash(b.column(0).drop_null().to_numpy(zero_copy_only=False)) for b in batches)
    return bitmap(ids.mapInArrow(trimmed(emit), BLOB_SCHEMA), 1)


def long_ids(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, F.col(name).cast("long"))
