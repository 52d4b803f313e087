import random
import time

import pytest

from firmlens.llm.line_chunks import remove_repeated_chunks

from .brute import edge_docs, line_dedup


@pytest.mark.parametrize("seed", range(3))
def test_brute_force(spark, seed):
    r = random.Random(seed)
    passage = [f"shared line {k}" for k in range(6)]

    def doc():
        lines = [f"line {r.randrange(30)}" for _ in range(r.randint(1, 15))]
        if r.random() < 0.5:
            at = r.randint(0, len(lines))
            lines[at:at] = passage
        return "\n".join(lines) + r.choice(["", "\n"])

    docs = [(k, doc()) for k in range(60)] + [(100, None), (101, ""), (102, "\n\n\n"), (103, "\n\n\n")]
    docs += [(200 + k, docs[k][1]) for k in range(5)]
    got = remove_repeated_chunks(spark.createDataFrame(docs, "doc_id long, text string").repartition(4))
    rows = {r["doc_id"]: r for r in got.select("doc.doc_id", "clean", "removed", "n_lines").collect()}
    for (i, t), (clean, gone) in zip(docs, line_dedup(docs)):
        assert (rows[i].clean, [tuple(x) for x in rows[i].removed]) == (clean, gone)
        assert rows[i].n_lines == (0 if t is None else len(t.split("\n")))
    assert any(gone for _, gone in line_dedup(docs))


def test_boundaries_shift_with_the_text(spark):
    body = "\n".join(f"body {k}" for k in range(40))
    docs = [(1, body), (2, "another start\nof two lines\n" + body)]
    got = remove_repeated_chunks(spark.createDataFrame(docs, "doc_id long, text string")).select("doc.doc_id", "removed").collect()
    gone = {r.doc_id: sum(x["size"] for x in r.removed) for r in got}
    assert gone[1] == 0 and gone[2] >= 30


def test_edges(spark):
    docs = edge_docs(spark)
    got = remove_repeated_chunks(docs)
    assert got.count() == docs.count() and got.select("doc.*").columns == docs.columns
    rows = got.select("doc.doc_id", "doc.text", "clean", "removed").collect()
    assert all((r.clean is None) == (r.text is None) for r in rows)
    assert all(not r.removed for r in rows if r.doc_id == 1)  # a repeated row is the same document
    assert [len(r.clean) < len(r.text) for r in rows if r.doc_id in (5, 6)] in ([False, True], [True, False])
    assert remove_repeated_chunks(docs.limit(0)).count() == 0


def test_exact_copy_leaves_nothing(spark):
    for n in (2, 3, 7, 500):
        text = "\n".join(f"line {k} of {n}" for k in range(n))
        got = remove_repeated_chunks(spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string"))
        assert {r.doc_id: r.clean for r in got.select("doc.doc_id", "clean").collect()} == {1: text, 2: ""}


def test_time_follows_the_lines_of_a_long_text(spark):
    took = {}
    for n in (2_000, 20_000, 40_000):
        text = "\n".join(f"line {k}" for k in range(n))
        docs = spark.createDataFrame([(1, text), (2, text + "\nown\nend")], "doc_id long, text string")
        start = time.monotonic()
        rows = {r.doc_id: r for r in remove_repeated_chunks(docs).select("doc.doc_id", "clean", "n_lines").collect()}
        took[n] = time.monotonic() - start
        assert rows[1].clean == text and rows[2].clean.endswith("own\nend") and len(rows[2].clean) < 100
    assert took[40_000] < 2.5 * took[20_000] + 2, took
