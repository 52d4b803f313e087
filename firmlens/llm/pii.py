"""Personal data: patterns, and terms that disclose them by what the corpus shows.

Base spans (e-mail, IP, card, phone) come from patterns with checks. For what else gives an
entity away, the corpus is asked about the terms that stand next to entity e (one normalised
value) somewhere: with n(e, t) the documents that hold e and term t, PMI(e; t) =
log(n(e, t) N / (n(e) n(t))) is the information that t gives about e, of IC(e) = log(N / n(e))
that there is. Where PMI reaches a share ALPHA of IC, t is a span too, wherever it stands in a
document that holds e, and is generalised like it. No pair is too rare: n(t) is counted as one
document more, so that a rare term of an entity seen once counts, while a common one, or any in
a handful of documents, falls short.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmlens.llm.common import annotate, arrow_map, binary_column, stored

KINDS = ("email", "ip", "card", "phone", "term")
WINDOW = 64  # characters on either side of an entity in which terms are candidates
ALPHA = 0.8  # share of an entity's information that a term must give
BITS = 23  # of a checksum, in the filters sent to the tasks: 2^23 bits (1 MB) at most

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_WORD = re.compile(r"[^\W\d_]{3,}")
_NO_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind, then start, in code points; leftmost non-overlapping per kind."""
    out: list[tuple[str, int, int]] = []
    end, at = 0, text.find("@")
    while at >= 0:  # a match has one @, the longest run of local characters before it and a domain after
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            end = m.end()
            out.append(("email", start, end))
        at = text.find("@", max(at + 1, end))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups()):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _NO_DIGIT.sub("", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NO_DIGIT.sub("", m[0])) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


def entity(kind: str, value: str) -> str:
    """An entity's name: one value however it is written."""
    return f"{kind}:{value.lower() if kind in ('email', 'ip') else _NO_DIGIT.sub('', value)}"


def neighbours(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[str, str, int, int]]:
    """(entity, term, start, end) of the words next to each span, outside all spans."""
    out = []
    edges = sorted((s, e) for _, s, e in spans)
    for kind, start, end in spans:
        low, high = max(0, start - WINDOW), min(len(text), end + WINDOW)
        near = [(s, e) for s, e in edges if s < high and e > low] if len(edges) < 1000 else _near(edges, low, high)
        name = entity(kind, text[start:end])
        for m in _WORD.finditer(text, low, high):
            a, b = m.span()
            cut = a == low and a > 0 and _WORD.match(text[a - 1] * 3) or b == high and b < len(text) and _WORD.match(text[b] * 3)
            if not cut and not any(s < b and e > a for s, e in near):
                out.append((name, m[0].lower(), a, b))
    return out


def _near(edges: list[tuple[int, int]], low: int, high: int) -> list[tuple[int, int]]:
    """Spans of a long list (sorted, each shorter than the window is wide or found by its start) in a window."""
    starts = np.fromiter((s for s, _ in edges), dtype=np.int64, count=len(edges))
    longest = max(e - s for s, e in edges)
    a, b = np.searchsorted(starts, [low - longest, high])
    return [(s, e) for s, e in edges[a:b] if e > low]


def find_spans(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``id, mark`` (a hash of the text), ``base`` and ``near`` for every row of ``docs``.

    ``base``: array of (kind, start, end); ``near``: distinct (entity, term) pairs of the words next to a span.
    """
    span = "struct<kind:string,start:bigint,end:bigint>"
    close = "struct<entity:string,term:string>"
    base_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    near_type = pa.list_(pa.struct([("entity", pa.string()), ("term", pa.string())]))

    def compute(texts: list[bytes | None]) -> list[pa.Array]:
        base, near = [], []
        for t in texts:
            t = (t or b"").decode("utf-8", "replace")
            found = base_spans(t)
            base.append([dict(zip(("kind", "start", "end"), s)) for s in found])
            near.append([{"entity": e, "term": w} for e, w in {n[:2] for n in neighbours(t, found)}] if found else [])
        return [pa.array(base, base_type), pa.array(near, near_type)]

    made = annotate(_named(docs, text, id_col), "text", f"base array<{span}>, near array<{close}>", compute)
    return made.select("doc.id", "doc.mark", "base", "near")


def _named(docs: DataFrame, text: str, id_col: str) -> DataFrame:
    value = F.col(text).cast("string")
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(value).alias("mark"), value.alias("text"))


def _bit(*parts: str) -> int:
    return zlib.crc32("\0".join(parts).encode()) & ((1 << BITS) - 1)


def _filter(df: DataFrame, *cols: str) -> bytes:
    """The bits of the rows' checksums (see ``_bit``): at most 2^BITS, whatever the corpus."""
    word = F.crc32(F.concat_ws("\0", *cols).cast("binary")) % (1 << BITS)
    bits = df.select(word.alias("h")).groupBy(F.floor(F.col("h") / 32).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(h % 32 as int))")).alias("bits"))
    found, mask = bits.toArrow(), np.zeros(1 << (BITS - 5), dtype="<u4")
    mask[found["at"].to_numpy()] = found["bits"].to_numpy()
    return mask.tobytes()


def _has(bits: bytes, at: int) -> int:
    return bits[at >> 3] >> (at & 7) & 1


def disclosing_terms(
    spans: DataFrame, docs: DataFrame, text: str = "text", alpha: float = ALPHA
) -> DataFrame:
    """``entity, term`` pairs next to each other in ``spans`` (see ``find_spans``) whose term discloses the entity,
    by counts over all ``docs``, whole texts. Rows that repeat a text count as documents."""
    pairs = stored(spans.select(F.explode("near").alias("p")).distinct().select("p.*"), "pii_pairs")
    terms, couples = _filter(pairs, "term"), _filter(pairs, "entity", "term")

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        # (null, t), (e, null) and (e, t): documents that hold the term, the entity, both
        counts: Counter[tuple[str | None, str | None]] = Counter()
        for t in binary_column(batch, "text"):
            t = (t or b"").decode("utf-8", "replace")
            words = [w for w in set(map(str.lower, _WORD.findall(t))) if _has(terms, _bit(w))]
            counts.update([(None, w) for w in words])
            for e in {entity(k, t[a:b]) for k, a, b in base_spans(t)}:
                counts[e, None] += 1
                counts.update([(e, w) for w in words if _has(couples, _bit(e, w))])
        columns = [pa.array([k[i] for k in counts], pa.string()) for i in (0, 1)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(counts.values(), pa.int64())], names=["entity", "term", "n"])

    whole = docs.select(F.col(text).cast("string").alias("text"))
    counted = stored(arrow_map(whole, rows, "entity string, term string, n long").groupBy("entity", "term").agg(F.sum("n").alias("n")), "pii_counts")
    seen = counted.where("entity IS NULL").select("term", F.col("n").alias("docs_t"))
    own = counted.where("term IS NULL").select("entity", F.col("n").alias("docs_e"))
    together = counted.where("entity IS NOT NULL AND term IS NOT NULL").withColumnRenamed("n", "both").join(pairs, ["entity", "term"])
    total = F.lit(float(docs.count()))
    ratio = F.log2(F.col("both") * total / (F.col("docs_e") * (F.col("docs_t") + 1))) / F.log2(total / F.col("docs_e"))
    known = together.join(seen, "term").join(own, "entity").where(F.col("docs_e") < total)
    return known.where(ratio >= alpha).select("entity", "term")


def with_terms(spans: DataFrame, disclosing: DataFrame, docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``id, mark, base, added``: rows of ``spans`` with the spans of terms that disclose an entity of the same
    text, wherever they stand outside all base spans (kind ``term``, sorted). Rows with equal id and text get the same result."""
    disclosing = stored(disclosing, "pii_disclosing")
    terms, couples = _filter(disclosing, "term"), _filter(disclosing, "entity", "term")
    place_type = pa.list_(pa.struct([("entity", pa.string()), ("term", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def compute(texts: list[bytes | None]) -> list[pa.Array]:
        out = []
        for t in texts:
            t = (t or b"").decode("utf-8", "replace")
            found = base_spans(t)
            names = {entity(k, t[a:b]) for k, a, b in found}
            at: dict[str, list[tuple[int, int]]] = {}
            for m in free_words(t, found) if names else ():
                at.setdefault(m[0].lower(), []).append(m.span())
            words = [w for w in at if _has(terms, _bit(w))]
            out.append([{"entity": e, "term": w, "start": a, "end": b} for e in names for w in words if _has(couples, _bit(e, w)) for a, b in at[w]])
        return [pa.array(out, place_type)]

    places = annotate(_named(docs, text, id_col), "text", "places array<struct<entity:string,term:string,start:bigint,end:bigint>>", compute)
    places = places.select("doc.id", "doc.mark", F.explode("places").alias("n")).select("id", "mark", "n.*")
    found = (
        places.join(disclosing, ["entity", "term"])
        .groupBy("id", "mark")
        .agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("terms"))
    )
    joined = spans.alias("s").join(found.alias("f"), F.expr("s.id <=> f.id AND s.mark = f.mark"), "left")
    span = F.transform("terms", lambda t: F.struct(F.lit("term").alias("kind"), t["start"].alias("start"), t["end"].alias("end")))
    return joined.select("s.id", "s.mark", "base", F.coalesce(span, F.expr("cast(array() as array<struct<kind:string,start:bigint,end:bigint>>)")).alias("added"))


def free_words(text: str, spans: list[tuple[str, int, int]]) -> Iterator[re.Match]:
    """The words of a text that overlap no span, in order."""
    edges, k, last = sorted((s, e) for _, s, e in spans), 0, 0
    for m in _WORD.finditer(text):
        while k < len(edges) and edges[k][0] < m.end():
            last, k = max(last, edges[k][1]), k + 1
        if last <= m.start():
            yield m


def personal_data(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``id, mark, base, added`` for every row: base spans and those of disclosing terms.

    Null text counts as empty; a null id stays null. Documents without base spans get no
    spans at all. Ties and repeated rows: equal rows get equal results. No rows: none.
    """
    spans = stored(find_spans(docs, text, id_col), "pii_spans")
    return with_terms(spans, disclosing_terms(spans, docs, text), docs, text, id_col)


def sanitised(docs: DataFrame, found: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` packed as ``doc`` (see ``common.annotate``) with ``clean``: the text with every span of
    ``found`` (from ``personal_data``) generalised to its kind, like ``[email]``. Spans that overlap
    are replaced as one, named after the first."""
    value = F.col(text).cast("string")
    spans = found.select("id", "mark", F.concat("base", "added").alias("spans")).where(F.size("spans") > 0).distinct()
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(id_col).alias("id"), F.xxhash64(value).alias("mark"))
    joined = named.alias("d").join(spans.alias("f"), F.expr("d.id <=> f.id AND d.mark = f.mark"), "left").select("doc", "spans")
    place = docs.columns.index(text)

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        doc = batch.column("doc")
        clean = []
        for t, s in zip(doc.field(place).cast(pa.binary()).to_pylist(), batch.column("spans").to_pylist()):
            if t is not None and s:
                t = replaced(t.decode("utf-8", "replace"), [(x["kind"], x["start"], x["end"]) for x in s]).encode()
            clean.append(t)
        return pa.RecordBatch.from_arrays([doc, pa.array(clean, pa.binary()).cast(pa.string())], names=["doc", "clean"])

    return arrow_map(joined, rows, f"doc {joined.schema['doc'].dataType.simpleString()}, clean string")


def replaced(text: str, spans: list[tuple[str, int, int]]) -> str:
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]))):
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])
