import re

import numpy as np
from hypothesis import given, strategies as st

from retail_analytics.llm.common import LEVELS, Words, _blobs, _fold, _pack, _unpack, among, level, sliding_min

TOOL = Words()


@given(st.lists(st.text(alphabet="ab \t\n\x0b\x0c\ré\x85\xa0\x1c", max_size=30), max_size=6))
def test_words_are_split_and_hashed_alike(texts):
    data = [t.encode() for t in texts]
    hashes, first = TOOL.texts(data)
    words = [re.findall(rb"[^\x20\x09-\x0D]+", t) for t in data]
    assert list(np.diff(first)) == [len(w) for w in words]
    place = {}
    for h, w in zip(hashes.tolist(), [x for ws in words for x in ws]):
        assert place.setdefault(w, h) == h
    assert len(set(place.values())) == len(place)


def test_long_texts_and_grams():
    long = b"w%d " * 200_000 % tuple(range(200_000))
    hashes, first = TOOL.texts([b"x", long, b"", b"w5 w6"])
    assert list(first) == [0, 1, 200_001, 200_001, 200_003]
    grams = TOOL.grams(hashes[1:200_001], 2)
    assert len(np.unique(grams)) == len(grams) == 199_999 and grams[5] == TOOL.grams(hashes[200_001:], 2)[0]
    assert len(TOOL.grams(hashes[:1], 2)) == 0


def test_filter_of_repeated_values():
    import pyarrow as pa
    rnd = np.random.default_rng(1)
    values = rnd.integers(0, 2**63, 4000).astype(np.uint64) * np.uint64(2)
    parts = [np.unique(values[:3000]), np.unique(values[2000:])]
    batches = [pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([x], pa.binary())], ["bucket", "blob"]) for p in parts for b, x in _blobs(p)]
    batches.sort(key=lambda b: b.column(0)[0].as_py())
    for least, bits, own, other in ((2, 26, values[2000:3000], values[:1500]), (1, 28, values, rnd.integers(0, 2**63, 1000).astype(np.uint64))):
        mask, sketch = np.zeros((256, 1 << (bits - 11)), np.uint8), np.zeros((256, 1 << (LEVELS - 8)), np.uint8)
        for out in _fold(least, bits)(iter(batches)):
            mask[out.column(0)[0].as_py()] = np.frombuffer(out.column(1)[0].as_py(), np.uint8)
            sketch[out.column(0)[0].as_py()] = np.frombuffer(out.column(2)[0].as_py(), np.uint8)
        assert among(mask.reshape(-1), own).all() and among(mask.reshape(-1), other).mean() < 0.02
        assert (level(sketch.reshape(-1), values) >= 1).all() and sketch.astype(bool).sum() <= 4000


@given(st.lists(st.integers(0, 2**24 - 1), max_size=50))
def test_packed_gaps(values):
    v = np.sort(np.array(values + [0, 65534, 65535, 65536, 2**24 - 1], np.uint32))
    assert (_unpack(_pack(v)) == v).all()


@given(st.lists(st.integers(0, 9), max_size=40), st.integers(1, 12))
def test_sliding_min(values, span):
    a = np.array(values, np.uint64)
    assert sliding_min(a, span).tolist() == [min(values[i:i + span]) for i in range(len(values) - span + 1)]
