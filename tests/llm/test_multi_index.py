"""The inverted multi-index against brute force: order of the walk, exact scores, recall, odd rows."""
import math

import numpy as np

from retail_analytics.llm import multi_index

SCHEMA = "vec_id long, embedding array<float>, label int, score string"


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: r["rank"]):
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return out


def brute(rows, at, k=10):
    q = np.array(rows[at][1], float)
    far = [(math.sqrt(((np.array(v, float) - q) ** 2).sum()), i) for n, (i, v) in enumerate(rows) if n != at]
    return sorted(far)[:k]


def test_walk_is_in_order_and_ends_at_the_share():
    rnd = np.random.default_rng(3)
    a, b, sizes = rnd.random(9), rnd.random(7), rnd.integers(0, 3, (9, 7))
    cells = list(multi_index.walk(a, b, sizes, 10**9))
    sums = [a[i] + b[j] for i, j in cells]
    assert sums == sorted(sums) and set(cells) == set(zip(*np.nonzero(sizes)))
    some = list(multi_index.walk(a, b, sizes, 20))
    assert cells[:len(some)] == some and sum(sizes[c] for c in some) >= 20 > sum(sizes[c] for c in some[:-1])


def test_recall_and_scores_on_clusters(spark):
    rnd = np.random.default_rng(5)
    centres = rnd.normal(size=(40, 24))
    rows = [(i, (centres[i % 40] + .3 * rnd.normal(size=24)).astype(np.float32).tolist()) for i in range(6000)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(5)
    hit = 0
    for kw in ({}, {"block": 50, "max_rows": 20}):              # many blocks of a centroid, many chunks of queries
        got = answers(multi_index.search(df, "vec_id % 100 = 0", sample=3000, **kw))
        assert set(got) == set(range(0, 6000, 100))
        for q, found in got.items():
            want = brute(rows, q)
            assert [r for r, _, _ in found] == list(range(1, 11)) and [s for _, _, s in found] == sorted(s for _, _, s in found)
            hit += len({i for _, i in want} & {i for _, i, _ in found})
            far = {i: d for d, i in want}
            assert all(math.isclose(far[i], s, rel_tol=1e-12) for _, i, s in found if i in far)
    assert hit >= 0.9 * 2 * 60 * 10


def test_odd_rows(spark):
    good = [(i, [float(i % 7), 1.0, float(i), -1.0]) for i in range(30)]
    odd = [(100, None), (200, []), (300, [0.0] * 4), (400, [None, 1.0, 1.0, 1.0]), (500, [float("nan"), 1.0, 1.0, 1.0]), (600, [float("inf"), 1.0, 1.0, 1.0]), (700, [1.0, 1.0])]
    rows = good + [(0, good[0][1]), (3, good[3][1]), (None, good[0][1])]                # repeated ids, a null id
    df = spark.createDataFrame([(*r, 1, "x") for r in rows + odd], SCHEMA).repartition(3)
    got = sorted((r.query_id, r["rank"], -1 if r.vec_id is None else r.vec_id, round(r.score, 9)) for r in multi_index.search(df, "vec_id % 100 = 0").collect())
    keyed = [(10**9 if i is None else i, v) for i, v in rows]
    want = [(0, k + 1, -1 if i == 10**9 else i, round(d, 9)) for at in (0, 30) for k, (d, i) in enumerate(brute(keyed, at))]
    assert got == sorted(want)
    few = spark.createDataFrame([(i * 100, [float(i), 1.0], 1, "x") for i in range(4)], SCHEMA)
    assert {q: [i for _, i, _ in x] for q, x in answers(multi_index.search(few, "vec_id % 100 = 0")).items()}[0] == [100, 200, 300]
    assert multi_index.search(df.limit(0), "vec_id % 100 = 0").count() == 0
    assert multi_index.search(df.where("vec_id between 100 and 600"), "vec_id % 100 = 0").count() == 0


def test_one_very_common_vector(spark):
    rows = [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(3000)] + [(3000 + i, [float(i), 1.0, 0.5, 2.0]) for i in range(200)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(4)
    got = answers(multi_index.search(df, "vec_id % 100 = 0", block=100))
    assert len(got) == 32 and [(i, s) for _, i, s in got[0]] == [(i, 0.0) for i in range(1, 11)] and got[100][0] == (1, 0, 0.0)
