import math
import random
from collections import Counter

import pytest

from firmlens.llm import lexical_search as S

from .brute import edge_docs, words


def brute(docs, items, k=50):
    """[(item, rank, doc, score)] of [(id, text)] and [(item, text)]."""
    own = [(i, Counter(words(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in own]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in own for t in c)
    wanted = {}
    for item, text in items:
        if item is not None:
            wanted.setdefault(item, set()).update(words(text))
    out = []
    for item, terms in wanted.items():
        rows = []
        for (doc, c), size in zip(own, sizes):
            if size:
                m = 100 - 50 + (50 * size * n) // total
                score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in terms if c[t])
                if score > 0:
                    rows.append((-score, doc is None, doc or 0, doc))
        out += [(item, r + 1, row[3], -row[0]) for r, row in enumerate(sorted(rows, key=lambda x: x[:3])[:k])]
    return sorted(out, key=repr)


def found(spark, docs, items, k=50, parts=4):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(parts)
    b = spark.createDataFrame(items, "item_id long, text string")
    return sorted(map(tuple, S.rank_documents(d, b, k).collect()), key=repr)


def made(seed, n_docs=60, n_items=9):
    r = random.Random(seed)

    def text(n):
        return "".join(r.choice(["a", "B", "é", "9x", "of", "THE", "日本"]) * r.choice([1, 1, 2]) + r.choice([" ", ", ", "\n", "-", "'"]) for _ in range(n))

    docs = [(k, text(r.randint(0, 60))) for k in range(n_docs)] + [(None, text(20)), (None, text(5)), (3, text(9)), (70, None), (71, ""), (72, "?! ,")]
    items = [(k % 7, text(r.randint(1, 6))) for k in range(n_items)] + [(None, "a b"), (20, None), (21, "?!"), (22, "nowhere")]
    return docs, items


@pytest.mark.parametrize("seed", range(3))
def test_brute_force(spark, seed):
    docs, items = made(seed)
    assert found(spark, docs, items, k=7) == brute(docs, items, k=7)


def test_slices_and_blocks_give_the_same(spark, monkeypatch):
    docs, items = made(9, n_items=40)
    whole = found(spark, docs, items)
    monkeypatch.setattr(S, "SLICE_BYTES", 300)
    assert found(spark, docs, items) == whole == brute(docs, items)


def test_scores_in_small_steps(monkeypatch):
    import numpy as np

    monkeypatch.setattr(S, "CELLS", 5)
    r = random.Random(4)
    starts, items = np.array([0, 2, 3, 5]), np.array([0, 1, 1, 0, 2])
    scorer = S.Scorer(starts, items, np.array([3, 0, 8]), 3, 4)
    kept = {0: [], 1: [], 2: []}
    for doc in range(50):
        held = Counter({t: r.randint(1, 3) for t in range(3) if r.random() < 0.7})
        scorer.add(doc % 9 == 0, doc, held, 100)
        for item, terms in ((0, [0, 2]), (1, [0, 1]), (2, [2])):
            score = sum([3, 0, 8][t] * ((10**9 * held[t]) // (1000 * held[t] + 2000)) for t in terms if held[t])
            if score:
                kept[item].append((-score, doc % 9 == 0, doc))
    scorer.settle()
    got = list(zip(*(x.tolist() for x in scorer.best.rows)))
    assert got == [(i, -s, m, d) for i in kept for s, m, d in sorted(kept[i])[:4]]


def test_terms_at_borders(monkeypatch):
    monkeypatch.setattr("firmlens.llm.words.TEXT_BYTES", 11)
    machine = S.automaton([b"ab", b"abc", "é".encode()])
    text = "ab abc,AB cab ab-ab abcab é\tÉé ab"
    n, got = S.count_terms(text.encode(), machine)
    c = Counter(words(text))
    assert n == sum(c.values()) and got == {k: c[t] for k, t in enumerate(["ab", "abc", "é"]) if c[t]}


def test_ties_repeats_and_hot_term(spark):
    docs = [(k, "common rare" if k % 3 == 0 else "common") for k in range(200)] + [(5, "common")] * 3
    items = [(1, "rare"), (1, "RARE rare"), (2, "common rare")]
    got = found(spark, docs, items, k=10)
    assert got == brute(docs, items, k=10)
    assert sorted(r[1:3] for r in got if r[0] == 1) == [(k + 1, 3 * k) for k in range(10)]


def test_edges(spark):
    docs = edge_docs(spark)
    bench = spark.createDataFrame([("x", "the CAT"), ("y", "zzz"), (None, "x"), ("z", None)], "item_id string, text string")
    got = S.rank_documents(docs, bench).collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(map(tuple, got), key=repr) == brute(rows, [("x", "the CAT"), ("y", "zzz")])
    assert S.rank_documents(docs, bench.limit(0)).count() == 0
    assert S.rank_documents(docs.limit(0), bench).count() == 0
