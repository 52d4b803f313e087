from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from firmlens.llm import language_id as L
from firmlens.llm.common import read

from ..conftest import SMALL
from .brute import edge_docs


def plain_counts(text):
    folded = "".join(c.lower() if c.isalpha() and len(c.lower()) == 1 else c if c.isalpha() else "\1" for c in text)
    out = Counter()
    for w in folded.split("\1"):
        w = "\1" + w + "\1"
        for n in (1, 2, 3):
            for i in range(len(w) - n + 1):
                code = 0
                for c in w[i : i + n]:
                    code = code << 21 | ord(c)
                if w[i : i + n].strip("\1"):
                    out[code] += 1
    return out


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab C,.\néÜß日1\1", max_size=60), st.sampled_from([3, 7, 1 << 20]))
def test_counts(text, piece):
    kept, L.PIECE = L.PIECE, piece
    try:
        codes, counts = L.ngram_counts(text.encode())
    finally:
        L.PIECE = kept
    assert dict(zip(codes.tolist(), counts.tolist())) == dict(plain_counts(text))


def plain_predict(text, ranked, size):
    own = sorted(plain_counts(text or "").items(), key=lambda x: (-x[1], x[0]))[:size]
    if not own or not ranked:
        return "und", 0.0
    away = {g: sum(abs(r.index(c) - k) if c in r else size for k, (c, _) in enumerate(own)) for g, r in ranked.items()}
    best = min(away, key=lambda g: (away[g], g))
    return best, 1 - away[best] / (size * len(own))


def test_predictions_by_hand_and_held_out_accuracy(spark):
    docs = read(spark, SMALL, "documents")
    ranked = L.learn_profiles(docs.where(~L.held_out()), sample=10**9)
    total = {}
    for r in docs.where(~L.held_out()).collect():
        total.setdefault(r.lang, Counter()).update(plain_counts(r.text))
    assert ranked == {g: [c for c, _ in sorted(n.items(), key=lambda x: (-x[1], x[0]))[: L.SIZE]] for g, n in total.items()}
    rows = L.identify(docs, ranked).select("doc.lang", "doc.text", "lang_pred", "score", L.held_out("doc.doc_id").alias("out")).collect()
    for r in rows[:60]:
        lang, score = plain_predict(r.text, ranked, L.SIZE)
        assert r.lang_pred == lang and abs(r.score - score) < 1e-9
    held = [r.lang == r.lang_pred for r in rows if r.out]
    assert len(held) > 30 and sum(held) / len(held) > 0.95


def test_sample_follows_the_bound(spark):
    docs = read(spark, SMALL, "documents")
    small = L.learn_profiles(docs, sample=5)
    assert set(small) <= {"en", "de", "fr", "es"} and small


def test_edges(spark):
    docs = edge_docs(spark)
    ranked = L.learn_profiles(docs)
    found = L.identify(docs, ranked).select("doc.*", "lang_pred", "score")
    assert found.count() == docs.count()
    rows = L.identify(docs, ranked).select("doc.text", "lang_pred", "score").collect()
    for r in rows:
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) and 0 <= r.score <= 1
    assert L.learn_profiles(docs.limit(0)) == {}
    assert {r.lang_pred for r in L.identify(docs, {}).collect()} == {"und"}
    assert L.identify(docs.limit(0), ranked).count() == 0


def test_ties_go_to_the_smaller_name():
    p = L.Profiles({"b": [97], "a": [97]}, 10)
    assert p.predict(b"a")[0] == "a"
