"""Every stage of the pipeline against its brute-force version, on its own input."""

import hashlib

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline as C
from firmlens.llm.bpe import tokenizer_path
from firmlens.llm.common import read, stored

from ..conftest import SMALL
from .brute import contamination, edge_docs, line_dedup, near_components


def test_stages(spark):
    docs = read(spark, SMALL, "documents")
    columns, tables = docs.columns, [docs.collect()]
    for name, stage in C.STAGES:
        docs = stored(stage(spark, docs, SMALL), f"test_{name}")
        tables.append(docs.collect())
        assert name == "bpe" or docs.columns == columns
    start, lang, lines, near, clean, out = ({r.doc_id: r for r in t} for t in tables)
    assert all(len(t) == len(d) for t, d in zip(tables, (start, lang, lines, near, clean, out)))
    assert set(lang) == {i for i, r in start.items() if any(c.isalpha() for c in r.text)} and len(lang) >= 0.99 * len(start)
    order = sorted(lang)
    for i, (text, gone) in zip(order, line_dedup([(i, lang[i].text) for i in order])):
        assert (i in lines) == (text != "" or not gone)
        if i in lines:
            assert lines[i].text == text and lines[i].n_chars == len(text) and lines[i].lang == lang[i].lang
    root = near_components([(i, r.text) for i, r in lines.items()])
    assert set(near) == {i for i in lines if root[i] == i}
    items = [(r.item_id, r.text) for r in read(spark, SMALL, "benchmark").collect()]
    hits = contamination([r.text for r in near.values()], items)
    assert set(clean) == {i for i, (_, n, _) in zip(near, hits) if not n}
    t = Tokenizer.from_file(tokenizer_path())
    for i, r in out.items():
        ids = t.encode(clean[i].text, add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(clean[i].text.encode()).hexdigest()
    assert set(out) == set(clean) and len(lines) < len(lang) and len(near) < len(lines) and len(clean) < len(near)
    rerun = {tuple(r) for r in C.run(spark, SMALL).collect()}
    assert rerun == {tuple(r) for r in tables[-1]}


def test_edges(spark):
    docs = edge_docs(spark)
    for rows in (docs, docs.limit(0)):
        for name, stage in C.STAGES:
            rows = stored(stage(spark, rows, SMALL), f"test_{name}")
            assert name == "bpe" or rows.columns == docs.columns


def test_near_dedup_of_repeated_and_null_ids(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(30)) for x in "abc")
    rows = [(1, a), (1, a), (1, a.upper()), (None, a), (None, b), (None, b + " "), (None, b), (2, c), (3, c), (None, c), (4, ""), (4, ""), (None, ""), (None, None)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string").repartition(4)
    got = C.near_dedup(spark, docs, SMALL)
    assert got.columns == docs.columns
    kept = sorted(((r.doc_id or 0, (r.text or "").lower().strip()) for r in got.collect()))
    assert kept == [(0, ""), (0, ""), (0, b), (1, a), (2, c), (4, "")]


def test_near_dedup_of_repeated_ids(spark):
    a, b = (" ".join(f"{x}{k}" for k in range(30)) for x in "ab")
    rows = [(1, a), (1, a), (1, a.upper()), (2, b), (3, b), (4, ""), (4, ""), (4, None), (5, None), (6, "")]
    docs = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string").repartition(4)
    got = C.near_dedup(spark, docs, SMALL)
    assert got.columns == docs.columns
    kept = sorted((r.doc_id, "-" if r.text is None else r.text.lower()) for r in got.collect())
    assert kept == [(1, a), (2, b), (4, ""), (4, "-"), (5, "-"), (6, "")]
