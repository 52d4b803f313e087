import math
import random

import pytest

from firmlens.llm import topk_search as K


def plain(vectors, queries, k):
    def whole(v):
        ok = v is not None and all(x is not None and math.isfinite(x) for x in v)
        return [math.floor(256 * x) for x in v] if ok else None

    base = [(i, whole(v)) for i, v in vectors if i is not None and whole(v) is not None]
    out = []
    for q, v in sorted({(i, tuple(whole(v))) for i, v in queries if i is not None and whole(v) is not None}):
        scored = sorted((-sum(a * b for a, b in zip(v, x)), i) for i, x in base if i != q and len(x) == len(v))
        out += [(q, rank, i, max(min(-s, 2**63 - 1), -(2**63))) for rank, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def compared(spark, vectors, queries, k=5):
    kind = "vec_id long, embedding array<double>, query_id long, score string"
    v, q = (spark.createDataFrame([(i, x, i, "own") for i, x in rows], kind).repartition(3) for rows in (vectors, queries))
    got = K.top_k_search(v, q, k).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == plain(vectors, queries, k)


@pytest.mark.parametrize("dim", [1, 3, 64])
def test_brute_force(spark, monkeypatch, dim):
    monkeypatch.setattr(K, "BASE_BLOCK", 50)
    monkeypatch.setattr(K, "QUERY_BLOCK", 7)
    r = random.Random(dim)
    vectors = [(k, [round(r.gauss(0, 1), 2) for _ in range(dim)]) for k in range(150)]
    vectors += [(200 + k, vectors[3][1]) for k in range(40)]  # ties
    compared(spark, vectors, vectors[::10])


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [
        (1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, [1.0, None]), (4, [nan, 1.0]), (5, [inf, 1.0]), (None, [9.0, 9.0]),
        (6, [1.0, 2.0, 3.0]), (7, []), (8, []), (9, [0.001, -0.001]), (10, [-1.0, 0.5]), (10, [-1.0, 0.5]), (11, [1e15, 1e15]), (12, [-1e300, 1.0]),
    ]
    compared(spark, vectors, vectors)
    compared(spark, [], [])
    compared(spark, vectors, [])


def test_bounds_hold():
    import numpy as np

    r = np.random.default_rng(0)
    q, x = np.floor(r.normal(0, 100, (40, 37))), np.floor(r.normal(5, 50, (60, 37)))
    for n in (1, *K.LEVELS, 37):
        bound = K.segment_statistics(q, n) @ K.segment_statistics(x, n).T
        assert (bound >= q @ x.T - 1e-6).all()
