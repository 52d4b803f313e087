import random
import re

from firmlens.llm import pii as P

from .brute import edge_docs

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def plain_spans(t):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [("email", *m.span()) for m in EMAIL.finditer(t)]
    out += [("ip", *m.span()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(t) if 13 <= len(digits(m)) <= 19 and plain_luhn(digits(m))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(t) if 9 <= len(digits(m)) <= 15]


def test_base_spans():
    r = random.Random(3)
    letters = [
        ["a", "@", ".", "-", "b1", "..", "é", " ", "%", "+"], [*"0123456789", " ", "-"], [*"0129", ".", ".", " "],
        ["+", "1", "22", "(", ")", "-", " ", ".", "x"], ["4111111111111111", " ", "-", "4", "+", "1.2.3.4", "255.", "a@b.c", "@", "00001"],
    ]
    for _ in range(15_000):
        t = "".join(r.choice(r.choice([letters[0], letters[1], letters[4]])) if r.random() < 0.05 else r.choice(letters[_ % 5]) for _ in range(r.randint(0, 40)))
        assert P.base_spans(t) == plain_spans(t), t


def test_long_runs_are_linear():
    for t in ("1" * 300_000, "a" * 300_000 + "@", "a@" * 100_000, "+1 " * 100_000, "1." * 200_000):
        P.base_spans(t)


def docs_about(spark):
    rows = []
    for k in range(30):
        rows.append((k, f"Number {k}: please write to Zebedee Quillfeather, zq@mail.example.org, for the report today."))
    for k in range(30, 200):
        rows.append((k, f"Please write for the report number {k} today."))
    for k in range(200, 230):
        rows.append((k, f"Please write to the office, office{k}@mail.example.org, for the report number {k}."))
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def test_disclosing_terms(spark):
    docs = docs_about(spark)
    found = P.personal_data(docs)
    rows = {r.id: r for r in found.collect()}
    text = {r.doc_id: r.text for r in docs.collect()}
    for i, r in rows.items():
        named = {text[i][s.start : s.end] for s in r.added}
        assert named == ({"Zebedee", "Quillfeather"} if i < 30 else set()), (i, named)
    clean = {r["doc_id"]: r["clean"] for r in P.sanitised(docs, found).select("doc.doc_id", "clean").collect()}
    assert clean[0] == "Number 0: please write to [term] [term], [email], for the report today." and clean[40] == text[40]


def test_counts_by_hand(spark):
    docs = docs_about(spark)
    text = [r.text for r in docs.collect()]
    pairs, seen, own = {}, {}, {}
    for t in text:
        for w in {x.lower() for x in P._WORD.findall(t)}:
            seen[w] = seen.get(w, 0) + 1
        near = {(e, w) for e, w, _, _ in P.neighbours(t, P.base_spans(t))}
        for p in near:
            pairs.setdefault(p, []).append(t)
        for e in {e for e, _ in near}:
            own[e] = own.get(e, 0) + 1
    from math import log2

    n = len(text)
    expected = {
        (e, w) for (e, w), ts in pairs.items()
        if len(set(ts)) >= 3 and log2(len(ts) * n / (own[e] * seen[w])) / log2(n / own[e]) >= P.ALPHA
    }
    got = {tuple(r) for r in P.disclosing_terms(P.find_spans(docs), docs).collect()}
    assert got == expected and len(got) == 2


def test_entities_seen_once_or_twice(spark):
    rows = [(k, f"Please write to the office for report number {k}.") for k in range(60)]
    rows += [(k, f"Please write to the office, office{k}@mail.example.org, for the report.") for k in range(60, 80)]
    rows += [(100, "Please write to Zebedee Quillfeather, zq@mail.example.org, for the report.")]
    rows += [(k, f"Report {k}: please write to Philomena, +1 (017) 555-7713, for the office.") for k in (101, 102)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    text, found = dict(rows), P.personal_data(docs).collect()
    named = {r.id: {text[r.id][s.start : s.end] for s in r.added} for r in found if r.added}
    assert named == {100: {"Zebedee", "Quillfeather"}, 101: {"Philomena"}, 102: {"Philomena"}}


def test_terms_far_from_their_entity(spark):
    far = " ".join(["please write to the office for the report"] * 20)
    rows = [(k, f"Please write to the office for report number {k}.") for k in range(60)]
    rows += [(100, f"Quillfeather: {far}, Quillfeather, zq@mail.example.org, {far}, signed QUILLFEATHER")]
    rows += [(101, f"Write to zq@mail.example.org, {far}, says Quillfeather")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found, clean = P.personal_data(docs), {}
    for r in P.sanitised(docs, found).select("doc.doc_id", "clean").collect():
        clean[r.doc_id] = r.clean
    assert clean[100] == f"[term]: {far}, [term], [email], {far}, signed [term]"
    assert clean[101] == f"Write to [email], {far}, says [term]" and clean[0] == rows[0][1]


def test_edges(spark):
    docs = edge_docs(spark)
    found = P.personal_data(docs)
    assert found.count() == docs.count() and found.where("size(base) + size(added) > 0").count() == 0
    out = P.sanitised(docs, found)
    assert out.count() == docs.count() and out.where("NOT (doc.text <=> clean)").count() == 0
    assert P.personal_data(docs.limit(0)).count() == 0
    twice = edge_docs(spark, [(1, "a@b.cd", "en")] * 2 + [(None, "call +1 234 567 8901", "en")] * 2)
    rows = P.sanitised(twice, P.personal_data(twice)).select("clean").collect()
    assert sorted(r.clean for r in rows) == ["[email]", "[email]", "call [phone]", "call [phone]"]
