import random

import pytest

from firmlens.llm import decontaminate as D

from .brute import contamination, edge_docs


def compared(spark, docs, items, window=10):
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    got = D.mark_contamination(d, b, window).select("doc.doc_id", "n_words", "hit_spans", "hit_items").orderBy("doc_id").collect()
    assert [(r.n_words, sum(s.end - s.start for s in r.hit_spans), r.hit_items) for r in got] == contamination(docs, items, window)


@pytest.mark.parametrize("seed", range(3))
def test_brute_force(spark, seed):
    r = random.Random(seed)

    def text(n):
        return "".join(r.choice(["a", "B", "é", "9", "of"]) + r.choice([" ", ", ", "\n", "-", "`"]) for _ in range(n))

    items = [(k % 7, text(r.choice([1, 2, 3, 5, 12]))) for k in range(12)] + [(None, "a b c"), (3, None), (4, ""), (9, "?!")]
    compared(spark, [text(r.randint(0, 120)) for _ in range(60)] + [None, "", "  "], items, window=4)


def test_slices_give_the_same(spark, monkeypatch):
    r = random.Random(5)
    items = [(k, " ".join(r.choice("abcde") for _ in range(r.randint(1, 30)))) for k in range(40)]
    docs = [" ".join(r.choice("abcde") for _ in range(200)) for _ in range(20)]
    monkeypatch.setattr(D, "SLICE_BYTES", 300)
    monkeypatch.setattr(D, "PIECE_WORDS", 7)
    compared(spark, docs, items, window=6)


def test_long_texts_in_pieces(monkeypatch):
    r = random.Random(6)
    monkeypatch.setattr(D, "TEXT_BYTES", 17)
    items = [(k, " ".join(r.choice("abc") for _ in range(m))) for k, m in enumerate([1, 3, 4, 8, 8])]
    machines = D._machines([(str(i), t.encode()) for i, t in items], 5)
    for _ in range(200):
        doc = " ".join(r.choice("abcd") for _ in range(r.randint(0, 60)))
        n, spans, found = D.find_windows(doc.encode(), machines)
        assert (n, sum(s["end"] - s["start"] for s in D.merged(spans)), sorted(found)) == contamination([doc], items, 5)[0]


def test_edges(spark):
    docs = edge_docs(spark)
    bench = spark.createDataFrame([(1, "The CAT sat on"), (None, "x"), (2, None)], "item_id long, text string")
    out = D.mark_contamination(docs, bench)
    assert out.count() == docs.count() and out.where("size(hit_items) > 0").count() == 2
    assert out.select("doc.*").columns == docs.columns
    assert D.mark_contamination(docs, bench.limit(0)).where("size(hit_items) > 0").count() == 0
    assert D.mark_contamination(docs.limit(0), bench).count() == 0
