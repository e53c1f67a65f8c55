from __future__ import annotations

import math
import random

import numpy as np

from meterline.llm import topk as t

SCHEMA = "vec_id long, embedding array<float>, label int, v int, d string, rank int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "x", 2) for i, v in rows], SCHEMA)


def brute(rows, queries, k):
    def usable(rows):
        out = set()
        for i, v in rows:
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
                out.add((i, tuple(min(2**63 - 1, max(-2**63, math.floor(256 * float(np.float32(x))))) for x in v)))
        return out
    result = []
    for i, q in usable(queries):
        scored = sorted((-min(2**63 - 1, max(-2**63, sum(a * b for a, b in zip(q, v)))), j) for j, v in usable(rows) if j != i and len(v) == len(q))
        result += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored[:k])]
    return sorted(result)


def rows(seed, n, d, scale=0.3, repeat=1):
    r = random.Random(seed)
    base = [[r.gauss(0, scale) for _ in range(d)] for _ in range(n)]
    return [(k, base[k // repeat]) for k in range(n)]


def test_against_brute_force_over_many_blocks(spark):
    for seed, d, repeat in ((1, 64, 1), (2, 5, 1), (3, 33, 40), (4, 1, 1)):
        data = rows(seed, 400, d, repeat=repeat)  # repeat: ties in score
        queries = [x for x in data if x[0] % 50 == 0]
        got = sorted(tuple(r) for r in t.top_k(frame(spark, data), frame(spark, queries), 5, block_rows=60, block_queries=3).collect())
        assert got == brute(data, queries, 5)


def test_every_case(spark):
    data = [(0, [0.5, 0.5]), (1, [0.5, 0.5]), (1, [0.5, 0.5]), (2, None), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]),
            (None, [1.0, 1.0]), (6, []), (50, []), (7, [1.0]), (8, [-1.0, 0.1]), (50, [0.1, 0.2]), (100, [3.0e38, 1.0]), (9, [1e5, -1e5])]
    queries = [x for x in data if x[0] is not None and x[0] % 50 == 0]
    got = sorted(tuple(r) for r in t.top_k(frame(spark, data), frame(spark, queries)).collect())
    assert got == brute(data, queries, 5)
    empty = frame(spark, [])
    assert t.top_k(empty, empty).count() == 0 and t.top_k(frame(spark, data), empty).count() == 0 and t.top_k(empty, frame(spark, queries)).count() == 0


def test_bounds_hold():
    random_ = np.random.default_rng(0)
    for d in (1, 3, 16, 64, 100):
        q, x = random_.integers(-300, 300, (40, d)).astype(float), random_.integers(-300, 300, (60, d)).astype(float)
        exact = q @ x.T
        last = None
        for segments in (1, *t.LEVELS):
            bound = t.segment_features(q, segments) @ t.segment_features(x, segments).T
            assert (bound >= exact - 1e-6).all()
            last = bound
        assert (last - exact).mean() <= (t.segment_features(q, 1) @ t.segment_features(x, 1).T - exact).mean() + 1e-6


def test_finer_levels_are_computed_for_the_pairs_that_are_left():
    """Smooth vectors: the coarsest bounds drop nearly all pairs, each finer level some more, and the result is exact."""
    random_ = np.random.default_rng(3)
    x = np.floor(256 * np.cumsum(random_.normal(size=(3000, 64)), axis=1) * 0.1).astype(np.int64)
    ids, queries = np.arange(3000), np.arange(0, 3000, 50)
    left: list[int] = []
    qi, xi, scores = t.search(x[queries], queries, x, ids, ids, 5, left)
    assert left[0] == 60 * 3000 and left[1] < 0.1 * left[0]
    assert all(b <= a for a, b in zip(left, left[1:])) and left[-1] < left[1]
    exact = x[queries] @ x.T
    exact[np.arange(60), queries] = -(10**15)
    assert (scores.reshape(60, 5) == -np.sort(-exact, axis=1)[:, :5]).all() and (exact[qi, xi] == scores).all()


def test_products_of_few_and_of_many_pairs():
    random_ = np.random.default_rng(4)
    q, x = random_.integers(-9, 9, (30, 7)).astype(float), random_.integers(-9, 9, (50, 7)).astype(float)
    for share in (0.0, 0.01, 0.5, 1.0):
        alive = random_.random((30, 50)) < share
        assert (t._of_pairs(q, x, alive) == (q @ x.T)[alive]).all()
