"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The patterns are the windows of the benchmark items. For each pattern length a table over
blocks of two consecutive words says how far the search may shift; where the shift is 0,
the suffix block and the first word select the patterns to compare directly.

The benchmark is cut into slices of bounded size, each sent to the tasks with the function
and searched in a pass of its own over the documents; passes are chained without a shuffle.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmlens.llm.common import annotate, arrow_map, binary_column, stored

SLICE_BYTES = 4 << 20  # benchmark text searched in one pass
PIECE_WORDS = 4096  # longer items are sent in overlapping pieces
TEXT_BYTES = 4 << 20  # document text split into words at once

# 0-9, a-z and bytes over 0x7F are word bytes, A-Z become a-z, all others separate words
_WORD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256)
)


def word_lists(text: bytes | None) -> Iterator[list[bytes]]:
    """The words of a text in order, in lists of bounded size."""
    text = (text or b"").translate(_WORD)
    at = 0
    while at < len(text):
        cut = len(text) if at + TEXT_BYTES >= len(text) else text.find(b" ", at + TEXT_BYTES)
        cut = len(text) if cut < 0 else cut
        yield text[at:cut].split()
        at = cut


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


class WuManber:
    """Search tables for patterns (word tuples) of one length."""

    def __init__(self, patterns: dict[tuple[bytes, ...], set[str]], length: int):
        self.length, self.block = length, min(2, length)
        self.default = length - self.block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.bucket: dict[tuple[bytes, ...], dict[bytes, list]] = defaultdict(lambda: defaultdict(list))
        for words, items in patterns.items():
            for end in range(self.block, length + 1):
                b = words[end - self.block : end]
                self.shift[b] = min(self.shift.get(b, self.default), length - end)
            self.bucket[words[-self.block :]][words[0]].append((list(words), items))

    def find(self, words: list[bytes]) -> Iterator[tuple[int, set[str]]]:
        """Start and items of every occurrence, by start."""
        length, block, shift, default, n = self.length, self.block, self.shift, self.default, len(words)
        end = length
        while end <= n:
            b = (words[end - 2], words[end - 1]) if block == 2 else (words[end - 1],)
            step = shift.get(b, default)
            if step:
                end += step
                continue
            start = end - length
            for pattern, items in self.bucket[b].get(words[start], ()):
                if words[start:end] == pattern:
                    yield start, items
            end += 1


_BUILT: dict[int, tuple[list, list[WuManber]]] = {}


def _machines(pieces: list[tuple[str, bytes]], window: int) -> list[WuManber]:
    """Built once per Python worker and slice."""
    key = hash((window, tuple(pieces)))
    if key not in _BUILT or _BUILT[key][0] != pieces:
        by_length: dict[int, dict[tuple[bytes, ...], set[str]]] = defaultdict(lambda: defaultdict(set))
        for item, text in pieces:
            words = text.split()
            m = min(window, len(words))
            for at in range(len(words) - m + 1):
                by_length[m][tuple(words[at : at + m])].add(item)
        _BUILT.clear()
        _BUILT[key] = (pieces, [WuManber(p, m) for m, p in sorted(by_length.items())])
    return _BUILT[key][1]


def find_windows(text: bytes | None, machines: list[WuManber]) -> tuple[int, list[list[int]], set[str]]:
    """Number of words, word spans hit (start, end; merged per length) and items of a text."""
    count, spans, items = 0, [[] for _ in machines], set()
    reach = max((m.length for m in machines), default=1) - 1
    tail: list[bytes] = []
    for words in word_lists(text):
        held, words = len(tail), tail + words
        first = count - held
        for machine, own in zip(machines, spans):
            for start, found in machine.find(words):
                if start + machine.length <= held:
                    continue  # seen with the list before
                items |= found
                a, b = first + start, first + start + machine.length
                if own and own[-1][1] >= a:
                    own[-1][1] = max(b, own[-1][1])
                else:
                    own.append([a, b])
        count = first + len(words)
        tail = words[len(words) - reach :] if reach and len(words) > reach else words if reach else []
    return count, [s for own in spans for s in own], items


def merged(spans: list) -> list[dict[str, int]]:
    out: list[dict[str, int]] = []
    for a, b in sorted(map(tuple, spans)):
        if out and a <= out[-1]["end"]:
            out[-1]["end"] = max(b, out[-1]["end"])
        else:
            out.append({"start": a, "end": b})
    return out


def _pieces(bench: DataFrame, item: str, text: str, window: int) -> DataFrame:
    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        items, parts = [], []
        for key, value in zip(batch.column("item").to_pylist(), binary_column(batch, "text")):
            words = (value or b"").translate(_WORD).split()
            for at in range(0, max(1, len(words) - window + 1), PIECE_WORDS):
                if words:
                    items.append(key)
                    parts.append(b" ".join(words[at : at + PIECE_WORDS + window - 1]))
        return pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(parts, pa.binary())], names=["item", "part"])

    named = bench.select(F.col(item).cast("string").alias("item"), F.col(text).cast("string").alias("text"))
    return arrow_map(named.where("item IS NOT NULL"), rows, "item string, part binary")


def mark_contamination(
    docs: DataFrame, bench: DataFrame, window: int = 10, text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``docs`` packed as ``doc`` (see ``common.annotate``), with ``n_words`` (words of the text),
    ``hit_spans`` (disjoint word spans inside occurrences of windows, in order) and ``hit_items``
    (ids, as strings, of the items with occurring windows, sorted).

    Words are runs of digits, a-z (A-Z lower-cased) and non-ASCII characters. A window is
    ``window`` consecutive item words; an item of fewer words, but not none, is one window.
    Null or empty text: no words. Items with a null id or no words are ignored; rows that
    repeat an item id add to that item. Every document row is returned; an empty benchmark
    hits nothing.
    """
    parts = stored(_pieces(bench, item, item_text, window).distinct(), "benchmark_pieces")
    total = parts.agg(F.sum(F.octet_length("part"))).first()[0] or 0
    slices = max(1, math.ceil(total / SLICE_BYTES))
    out = docs
    for k in range(slices):
        chosen = parts.where(F.pmod(F.xxhash64("item", "part"), F.lit(slices)) == k) if slices > 1 else parts
        own = sorted((r.item, bytes(r.part)) for r in chosen.collect())  # one slice of the bounded size
        out = _pass(out, own, window, text, first=k == 0)
    return out


def _pass(df: DataFrame, pieces: list[tuple[str, bytes]], window: int, text: str, first: bool) -> DataFrame:
    fields = "n_words long, hit_spans array<struct<start:bigint,end:bigint>>, hit_items array<string>"

    def search(texts: list[bytes | None], spans: list, items: list) -> list[pa.Array]:
        machines = _machines(pieces, window)
        words = []
        for at, t in enumerate(texts):
            n, found, hit = find_windows(t, machines)
            words.append(n)
            if found:
                spans[at] = merged([*found, *((s["start"], s["end"]) for s in spans[at])])
                items[at] = sorted({*items[at], *hit}, key=str.encode)
        return [pa.array(words, pa.int64()), pa.array(spans, _SPANS), pa.array(items, pa.list_(pa.string()))]

    if first:
        return annotate(df, text, fields, lambda texts: search(texts, [[] for _ in texts], [[] for _ in texts]))
    place = df.schema["doc"].dataType.names.index(text)

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        doc = batch.column("doc")
        texts = doc.field(place).cast(pa.binary()).to_pylist()
        made = search(texts, batch.column("hit_spans").to_pylist(), batch.column("hit_items").to_pylist())
        return pa.RecordBatch.from_arrays([doc, *made], names=batch.schema.names)

    return arrow_map(df, rows, f"doc {df.schema['doc'].dataType.simpleString()}, {fields}")
