import random
import re
from collections import Counter

import numpy as np
import pytest

from firmlens.llm import collocations as C

from .brute import UPPER, edge_docs


def brute(docs, k, least):
    """[(lang, rank, phrase, a, l, r, n, score, cut)] of [(lang, text)]."""
    counts, n = Counter(), Counter()
    for lang, text in docs:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(UPPER)):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for m in range(1, 6):
                for i in range(len(w) - m + 1):
                    counts[lang, tuple(w[i : i + m])] += 1
    kept = {p: a for p, a in counts.items() if a >= least}
    hidden = set()
    for (lang, p), a in kept.items():
        for m in range(2, len(p)):
            for i in range(len(p) - m + 1):
                if a >= counts[lang, p[i : i + m]]:
                    hidden.add((lang, p[i : i + m]))
    found = {}
    for (lang, p), a in kept.items():
        if len(p) > 1 and (lang, p) not in hidden:
            cuts = [(1000 * a * n[lang] // (counts[lang, p[:c]] * counts[lang, p[c:]]), c) for c in range(1, len(p))]
            score, cut = min(cuts)
            found.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), counts[lang, p[:cut]], counts[lang, p[cut:]], cut))
    return sorted(
        (lang, rank + 1, p.decode(), -a, l, r, n[lang], -s, cut)
        for lang, rows in found.items() for rank, (s, a, p, l, r, cut) in enumerate(sorted(rows)[:k])
    )


def made(seed, n=120):
    r = random.Random(seed)
    passages = [" ".join(r.choice("abcdefgh") * r.randint(1, 2) for _ in range(r.randint(2, 9))) for _ in range(6)]

    def text():
        out = []
        for _ in range(r.randint(0, 12)):
            out.append(r.choice(passages) if r.random() < 0.5 else " ".join(r.choice(["a", "B", "é", "cc", "rare%d" % r.randint(0, 30), "ha ha ha"]) for _ in range(r.randint(1, 6))))
            out.append(r.choice([" ", "\t ", ". ", ",", "\n", "\x0b", " - ", "\x1c"]))
        return "".join(out)

    return [(r.choice(["en", "en", "fr", None]), text()) for _ in range(n)] + [("en", None), ("xx", ""), ("xx", " ,.")]


def mined(spark, docs, k, least):
    d = spark.createDataFrame(docs, "lang string, text string").repartition(3)
    return sorted(map(tuple, C.mine_collocations(d, k, least=least).collect()))


@pytest.mark.parametrize("seed,k,least", [(0, 2000, 5), (1, 10, 3)])
def test_brute_force(spark, monkeypatch, seed, k, least):
    monkeypatch.setattr(C, "FIRST_SHARE", 0.01 if seed else 0.25)  # many rounds, so that bounds prune
    docs = made(seed)
    assert mined(spark, docs, k, least) == brute(docs, k, least)


def test_bounds_prune(spark, monkeypatch):
    """What the k-th score rules out is never grown: common first words are in no table."""
    sent, hashed = [], C.hashed

    def seen(phrases):
        sent.extend((r.phrase, r.role) for r in phrases.collect())
        return hashed(phrases)

    monkeypatch.setattr(C, "hashed", seen)
    docs = [("en", f"pair{k} mate{k}. the of the.") for k in range(40) for _ in range(5 + k % 3)]
    assert mined(spark, docs, 10, 5) == brute(docs, 10, 5)
    assert not {"the", "of"} & {p for p, role in sent if role == C.GROW}


def test_small_blocks_give_the_same(monkeypatch):
    """Blocks cut anywhere in a long text count as one does."""
    r = random.Random(7)
    text = "".join(r.choice(["a", "b", "c", "dd"]) + r.choice([" ", " ", " ", ", "]) for _ in range(3000)).encode()
    all_on = [C.Bits(np.full(1, 2**64 - 1, np.uint64))] * 4
    import pyarrow as pa

    def counted():
        out, words, same = Counter(), Counter(), {}
        batch = pa.record_batch({"lang": ["x", "x"], "text": [text.decode(), "a b"]})
        for b in C._blocks(iter([batch])):
            names = b.words.to_pylist()
            words.update(names[w] for w in b.ids[b.start : b.to])
            for rows in C.grams(b, all_on):
                for r in rows.to_pylist():
                    out[r["phrase"] or r["h"]] += r["n"]
                    same.setdefault(r["phrase"], []).append((r["before"], r["after"]))
        del same[None]
        return out, words, {p: tuple(x[0] if len(set(x)) == 1 else None for x in zip(*s)) for p, s in same.items()}

    whole = counted()
    for size in (40, 7, 1):
        monkeypatch.setattr(C, "BLOCK_BYTES", size)
        assert counted() == whole


def test_chance_hits_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(C, "MOST_BITS", 64)  # full tables: everything is counted
    docs = made(3)
    assert mined(spark, docs, 10, 4) == brute(docs, 10, 4)


def test_edges(spark):
    docs = edge_docs(spark)
    rows = [(r.lang, r.text) for r in docs.collect()]
    got = sorted(map(tuple, C.mine_collocations(docs, 20).collect()))
    assert got == brute(rows, 20, 100) and got
    assert C.mine_collocations(docs.limit(0)).count() == 0
    assert C.mine_collocations(docs, least=10**6).count() == 0


def test_texts_are_split_once(spark, monkeypatch, tmp_table):
    """Rounds scan the stored words: texts are read once, and what the driver plans doesn't grow with the rounds."""
    seen, scans = [], []
    count, code = C.count_phrases, C.code_texts
    monkeypatch.setattr(C, "code_texts", lambda texts: seen.append(texts) or code(texts))
    monkeypatch.setattr(C, "count_phrases", lambda coded, *rest: scans.append(coded.columns) or count(coded, *rest))
    monkeypatch.setattr(C, "FIRST_SHARE", 0.05)
    docs = made(1, n=40)
    assert mined(spark, docs, 10, 3) == brute(docs, 10, 3)
    assert len(seen) == 1 and len(scans) > 2 and all("text" not in c for c in scans)


def test_coded_texts_are_the_blocks(spark):
    import pyarrow as pa

    rows = [(lang or "und", text) for lang, text in made(5)] + [("w", ", ".join(map(str, range(70_000))))]
    coded = C.code_texts(spark.createDataFrame(rows, "lang string, text string").coalesce(1))
    got = {b.lang: b for b in C._decoded(iter(coded.toArrow().to_batches()))}
    want = {b.lang: b for b in C._blocks(iter([pa.record_batch({"lang": [x for x, _ in rows], "text": [x for _, x in rows]})]))}
    assert {r.lang: r.width for r in coded.collect()} == dict.fromkeys(want, 2) | {"w": 4}
    for lang, b in want.items():
        a = got[lang]
        assert (a.start, a.to) == (b.start, b.to) and a.words.to_pylist() == b.words.to_pylist()
        assert (a.ids == b.ids).all() and (np.diff(a.piece) > 0).tolist() == (np.diff(b.piece) > 0).tolist()
