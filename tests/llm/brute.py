"""Plain re-statements of the operators, for small inputs, and awkward input rows."""

import hashlib
import re
from collections import defaultdict

WORD10 = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}

# columns that operators use themselves or return
CLASHING = ("n_words", "hit_items", "hit_spans", "lang_pred", "score", "id", "mark", "clean", "removed", "lines", "n_lines",
            "component_id", "kept", "n_shingles", "ids", "n_tokens", "decoded", "path", "blob", "spans", "base", "key", "sig", "doc")


def edge_docs(spark, rows=None):
    """``documents`` with nulls in any column, empty and long texts, repeated rows and clashing columns."""
    long_text = "\n".join(f"line {k} of a long text with some words" for k in range(3000)) + " " + "z" * 50_000
    rows = rows if rows is not None else [
        (1, "The cat sat on the mat, the dog ran.\nA second line here.", "en"),
        (1, "The cat sat on the mat, the dog ran.\nA second line here.", "en"),
        (2, None, "en"), (3, "", None), (4, "   \n\t \n", "de"), (5, long_text, "en"), (6, long_text, None),
        (None, "No id at all, the text stays.", "en"), (None, None, None), (7, "12 34 !?", "fr"),
        (8, "é ü 日本語 \U0001f642 ß", "fr"), (8, "the same id, another text", None), (9, "x", "en"),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)
    return spark.createDataFrame([(i, t, lang, None, None, *["own"] * len(CLASHING)) for i, t, lang in rows], schema)


def words(text):
    return WORD10.findall((text or "").translate(UPPER))


def contamination(docs, items, window=10):
    """[(n_words, n_hit, sorted item ids)] per document text."""
    grams = defaultdict(set)
    for item, text in items:
        w = words(text)
        if item is not None and w:
            m = min(window, len(w))
            for i in range(len(w) - m + 1):
                grams[tuple(w[i : i + m])].add(str(item))
    sizes = sorted({len(g) for g in grams})
    out = []
    for text in docs:
        w, hit, found = words(text), set(), set()
        for m in sizes:
            for i in range(len(w) - m + 1):
                if (g := tuple(w[i : i + m])) in grams:
                    hit.update(range(i, i + m))
                    found |= grams[g]
        out.append((len(w), len(hit), sorted(found)))
    return out


def shingles(text, n=5):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def near_components(docs, percent=75):
    """{doc_id: smallest reachable id} of [(doc_id, text)]."""
    sets = [(i, shingles(t)) for i, t in docs if i is not None]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i, _ in sets}


def chunks(text):
    """[(start, size)] of a text's line chunks."""
    if text is None:
        return []
    lines = text.split("\n")
    h = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in lines]
    r = [((h[i - 1] * 1_000_003 if i else 0) + h[i]) % 2**32 for i in range(len(h))]
    cuts = [0, *(i + 1 for i in range(1, len(r) - 2) if r[i - 1] > r[i] < r[i + 1]), len(r)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def line_dedup(docs):
    """[(text, removed)] of [(doc_id, text)] with distinct ids."""
    first = {}
    for at, (_, text) in sorted(enumerate(docs), key=lambda x: (x[1][0] is not None, x[1][0] or 0)):
        for start, size in chunks(text):
            c = "\n".join(text.split("\n")[start : start + size])
            if size > 1 and re.search(r"[^ \t\r\n\f\x0b]", c):
                first.setdefault(c, (at, start))
    out = []
    for at, (_, text) in enumerate(docs):
        if text is None:
            out.append((None, []))
            continue
        lines, gone = text.split("\n"), []
        for start, size in chunks(text):
            c = "\n".join(lines[start : start + size])
            if c in first and first[c] != (at, start) and size > 1:
                gone.append((start, size))
        keep = [x for i, x in enumerate(lines) if not any(a <= i < a + n for a, n in gone)]
        out.append(("\n".join(keep), gone))
    return out
