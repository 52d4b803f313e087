import random
import time

import pytest

from firmlens.llm import license_scan as L
from firmlens.llm import queries
from firmlens.llm.license_text import NOTICES, PHRASES

from ..conftest import SMALL
from .brute import edge_docs, words


def places(text, phrases=PHRASES):
    w = words(text)
    out = []
    for p, label in phrases.items():
        q = words(p)
        out += [(i, label) for i in range(len(w) - len(q) + 1) if w[i : i + len(q)] == q]
    return sorted(out)


def matching_statistics(text, templates):
    """Length of the longest run that ends at each word and stands in a template."""
    runs = {tuple(t[i:j]) for t in templates for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    return [max((k for k in range(1, i + 2) if tuple(text[i + 1 - k : i + 1]) in runs), default=0) for i in range(len(text))]


@pytest.mark.parametrize("seed", range(20))
def test_automaton_by_hand(seed):
    r = random.Random(seed)
    templates = [[r.randint(0, 2) for _ in range(r.randint(1, 9))] for _ in range(4)]
    a = L.SuffixAutomaton(templates)
    text = [r.randint(0, 3) for _ in range(80)]
    state = size = 0
    got = []
    for at, w in enumerate(text):
        while state and w not in a.next[state]:
            state = a.link[state]
            size = a.length[state]
        if w in a.next[state]:
            state, size = a.next[state][w], size + 1
        got.append(size)
        run = text[at + 1 - size : at + 1]
        if size:
            assert a.ends[state] == [(t, j) for t, x in enumerate(templates) for j in range(size, len(x) + 1) if x[j - size : j] == run]
    assert got == matching_statistics(text, templates)


@pytest.mark.parametrize("seed", range(4))
def test_phrases_by_hand(seed, monkeypatch):
    monkeypatch.setattr("firmlens.llm.words.TEXT_BYTES", 23 if seed % 2 else 1 << 20)
    r = random.Random(seed)
    phrases = {"a b": "x", "b": "y", "a b a b": "z", "c a b": "w"}
    s = L.Scanner(phrases, [("n", "a c b a a b c")], 3, 0.5, 4)
    for _ in range(100):
        text = "".join(r.choice(["a", "B", "c", "d"]) + r.choice([" ", "-", ", "]) for _ in range(r.randint(0, 60)))
        found = s.scan(p.split() for p in L.word_parts(text.encode()))
        assert found.n_words == len(words(text))
        assert sorted((at, s.labels[k]) for at, k in found.places) == places(text, phrases)


def spans(spark, text, **options):
    row = L.scan_licenses(spark.createDataFrame([(text,)], "text string"), **options).collect()[0]
    return [(s.label, s.start, s.end, round(s.share, 3)) for s in row.spans if s.label not in ("gpl", "apache", "mit", "cc-by") or s.end - s.start > 4]


def test_notices_and_changed_copies(spark):
    for label, notice in NOTICES:
        n = len(words(notice))
        got = spans(spark, f"some words before. {notice} And others behind.")
        assert (label, 3, 3 + n, 1.0) in got, (label, got)
    mit = dict(NOTICES)["mit"].split()
    changed = " ".join(w for k, w in enumerate(mit) if k % 9 != 4)  # every ninth word is missing
    ((label, start, end, share),) = [s for s in spans(spark, changed) if s[0] == "mit"]
    assert start == 0 and share > 0.8
    half = " ".join(mit[:30])
    assert not [s for s in spans(spark, half) if s[0] == "mit"]
    twice = spans(spark, " ".join(mit) + " and " + "other words " * 20 + " ".join(mit))
    assert [s[0] for s in twice if s[0] == "mit"] == ["mit", "mit"]


def test_chains_need_both_orders(spark):
    notices = [("n", " ".join(f"w{k}" for k in range(20)))]
    w = [f"w{k}" for k in range(20)]
    opts = {"phrases": {}, "notices": notices, "gap": 3}
    assert spans(spark, " ".join(w[:8] + ["x", "y"] + w[9:16]), **opts) == [("n", 0, 17, 0.75)]
    assert spans(spark, " ".join(w[:8] + ["x"] * 4 + w[9:16]), **opts) == []  # too far apart in the text
    assert spans(spark, " ".join(w[:6] + w[12:18]), **opts) == []  # too far apart in the template
    assert spans(spark, " ".join(w[9:16] + w[:8]), **opts) == []  # the wrong way round


def test_long_texts_take_linear_time():
    s = L.Scanner(PHRASES, NOTICES, L.LEAST_MATCH, L.LEAST_SHARE, L.GAP)
    text = " ".join(t for _, t in NOTICES) + " cc by cc by the software the software "

    def took(n):
        t = time.process_time()
        found = s.scan(p.split() for p in L.word_parts((text * n).encode()))
        assert len(found.places) == n * len(places(text))
        return time.process_time() - t

    took(20)
    assert took(800) < 3 * took(400) + 0.2


def test_registered_query(spark):
    got = queries.op13_license_scan(spark, SMALL).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert len(got) == len(docs)
    for r in got:
        base = places(docs[r.doc_id])
        assert (r.n_words, r.n_base) == (len(words(docs[r.doc_id])), len(base))
        assert (r.first_word, r.last_word) == ((base[0][0], base[-1][0]) if base else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in base}))
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)


def test_edges(spark):
    docs = edge_docs(spark)
    out = L.scan_licenses(docs)
    assert out.count() == docs.count() and out.select("doc.*").columns == docs.columns
    assert {(r.doc.text or "")[:3] for r in out.where("n_words = 0").collect()} == {"", "   "}
    assert L.scan_licenses(docs.limit(0)).count() == 0
    assert L.scan_licenses(docs, phrases={}, notices=[]).where("size(spans) > 0 OR size(places) > 0").count() == 0
    for wrong in ({"?!": "x"}, {"a " * (L.MAX_WORDS + 1): "x"}):
        with pytest.raises(ValueError):
            L.scan_licenses(docs, phrases=wrong)


def test_score_of_a_phrase_inside_a_longer_run(spark, tmp_table):
    """The phrase has no span of its own there, but a place, so a label and the score 1."""
    notice = next(words(t) for _, t in NOTICES if "apache license" in " ".join(words(t)))
    at = next(k for k in range(len(notice)) if notice[k : k + 2] == ["apache", "license"])
    text = "x y " + " ".join(notice[max(0, at - 2) : at + 4]) + " z"
    spark.createDataFrame([(1, text), (2, "nothing here")], "doc_id long, text string").write.parquet(f"{tmp_table}/documents.parquet")
    got = {r.doc_id: r for r in queries.op13_license_scan(spark, tmp_table).collect()}
    assert (got[1].n_base, got[1].base_labels, got[1].score) == (1, "apache", 1.0)
    assert (got[2].n_base, got[2].labels, got[2].score) == (0, "", 0.0)
