import random

import numpy as np
import pytest

from firmlens.llm import near_dup as N
from firmlens.llm.common import components

from .brute import edge_docs, near_components, shingles


def made_docs(seed, n=60):
    """Documents in chains and groups of edited copies."""
    r = random.Random(seed)

    def fresh():
        return [f"w{r.randrange(400)}" for _ in range(r.choice([1, 3, 4, 5, 6, 40, 60, 90]))]

    out = [fresh()]
    while len(out) < n:
        w = list(r.choice(out)) if r.random() < 0.8 else fresh()
        for _ in range(r.randint(0, 3)):
            w[r.randrange(len(w))] = f"W{r.randrange(400)}"
        out.append(w)
    return [(k, r.choice([" ", "\n", "\t"]).join(w)) for k, w in enumerate(out)]


@pytest.mark.parametrize("seed,stars", [(1, 2), (2, 0)])
def test_brute_force(spark, monkeypatch, seed, stars):
    monkeypatch.setattr(N, "STARS", stars)
    monkeypatch.setattr(N, "BLOCK", 4)
    docs = made_docs(seed)
    got = N.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()
    root = near_components(docs)
    assert {r.doc_id: r.component_id for r in got} == root
    assert all(r.n_shingles == len(shingles(dict(docs)[r.doc_id])) and r.kept == (r.doc_id == r.component_id) for r in got)


def test_edges(spark):
    docs = edge_docs(spark)
    got = N.near_duplicates(docs)
    rows = got.collect()
    assert len(rows) == docs.count()
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
    assert [r.component_id for r in by_id[1]] == [1, 1] and all(r.kept for r in by_id[1])
    assert by_id[6][0].component_id == 5 and not by_id[6][0].kept
    assert all(r.component_id is None and r.kept for r in by_id[None])
    assert by_id[2][0].n_shingles == by_id[3][0].n_shingles == by_id[4][0].n_shingles == 0 and by_id[3][0].component_id == 3
    assert N.near_duplicates(docs.limit(0)).count() == 0


def test_long_texts_hash_alike(monkeypatch):
    r = random.Random(3)
    text = " ".join(r.choice(["a", "b" * 30, "c" * 9000, "dd"]) for _ in range(3000)).encode()
    whole = N.shingle_set(text)
    monkeypatch.setattr(N, "CHUNK", 5000)
    assert np.array_equal(N.shingle_set(text), whole) and len(whole) == len(shingles(text.decode()))


def test_sequential_bound_keeps_similar_pairs():
    r = np.random.default_rng(1)
    left = r.integers(0, 60000, (400, N.BANDS * N.ROWS)).astype(np.uint16)
    right = np.where(r.random(left.shape) < 0.80, left, left + 1)
    low = np.where(r.random(left.shape) < 0.20, left, left + 1)
    eye = np.eye(400, dtype=bool)
    assert len(N.surviving_pairs(left, right, eye, 0.75)) == 400 and len(N.surviving_pairs(left, low, eye, 0.75)) == 0


def test_components(spark):
    r = random.Random(4)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(150)] + [(1000 + k, 1001 + k) for k in range(40)] + [(5000, 2000 + k) for k in range(50)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for a, b in edges if a != b for x in (a, b)}
