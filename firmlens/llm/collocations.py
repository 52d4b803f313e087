"""Phrase collocations of each language by best-first branch-and-bound growth.

Phrases grow to the right, word by word. Every phrase with the prefix p scores at most 1000 n / f(first word):
one cut has that word as first part, and the rest occurs no less often than the phrase. The frontier holds the
phrases not yet grown, those of the rarest first words, so of the highest bounds, first. Texts are split once and stored as
numbers of words; each round is one scan of these: it counts the phrases that the last round found, with their neighbours, and what a score still needs, and grows the
frontier. Once a language has its k surviving phrases, words bounded below the k-th score are never grown; the
search ends when nothing else is left.

Growth counts 64-bit hashes, which only tells what to count next; a phrase's own count compares its words, so
every count is exact. Scans know what to look for by bit tables of bounded size: a chance hit adds work, no error.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firmlens.llm.common import SLICE_ROWS, binary_column, map_batches, stored
from firmlens.session import run_dir

MAX_WORDS = 5
LEAST_COUNT = 100
BLOCK_BYTES = 4 << 20  # text whose phrases are counted at once
BITS_EACH, LEAST_BITS, MOST_BITS = 16, 1 << 22, 1 << 27  # size of a bit table: per phrase, at least (few chance hits), at most
LONG_WORD = 64  # bytes
FIRST_SHARE = 0.25  # of the language's words stand where the first round grows phrases; twice as many each time

# A-Z lower-cased; 0xFF, which is in no text, parts pieces; a tab parts words as a space does
BREAK, SPACE = 255, 32
_CLEAN = bytes(c + 32 if 65 <= c <= 90 else BREAK if c in b".,;:!?\n\x0b\x0c\r" else SPACE if c == 9 else c for c in range(256))

# roles of bit tables: words that may be in a phrase, phrases to grow, to count, and to pass on the way to these
WORD, GROW, PROBE, THROUGH = range(4)


def seed_of(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode())


def hash_words(words: pa.Array, seeds: np.ndarray) -> np.ndarray:
    """64-bit hashes of words (large binary), byte by byte for all words at once; the few long ones by themselves."""
    if not len(words):
        return np.zeros(0, np.uint64)
    _, offsets, data = words.buffers()
    offsets = np.frombuffer(offsets, np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    size = np.diff(offsets)
    h = seeds ^ np.uint64(0xCBF29CE484222325)
    on = np.flatnonzero(size <= LONG_WORD)
    for k in range(int(size[on].max(initial=0))):
        on = on[size[on] > k]
        h[on] = (h[on] ^ data[offsets[on] + k]) * np.uint64(0x100000001B3)
    for k in np.flatnonzero(size > LONG_WORD):
        h[k] = xxhash.xxh64_intdigest(data[offsets[k] : offsets[k + 1]].tobytes(), int(seeds[k]))
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(29))


def longer(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of phrases from those without their last word and that word's."""
    h = (h ^ (word + np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Bits:
    """A table of hashes: two bits each."""

    def __init__(self, words: np.ndarray):
        self.words, self.mask = words, np.uint64(len(words) * 64 - 1)

    def holds(self, h: np.ndarray) -> np.ndarray:
        return self._bit(h) & self._bit(h >> np.uint64(29))

    def _bit(self, h: np.ndarray) -> np.ndarray:
        at = h & self.mask
        return (self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) != 0


@dataclass
class Block:
    """Words of one language in order: numbers into ``words``, and the piece each is in. Phrases that start in
    [start, to) belong to the block; the words around are there to see them whole."""

    lang: str
    words: pa.Array
    ids: np.ndarray
    piece: np.ndarray
    start: int
    to: int

    @cached_property
    def hashes(self) -> np.ndarray:
        return hash_words(self.words, np.full(len(self.words), seed_of(self.lang), np.uint64))


def _split(text: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Different words, their numbers in the order of the text, and the piece each is in."""
    raw = np.frombuffer(text, np.uint8)
    parted = raw >= BREAK
    space = parted | (raw == SPACE)
    edge = np.diff(space.view(np.int8), prepend=1, append=1)
    begin, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    offsets = np.concatenate([[0], np.cumsum(end - begin)]).astype(np.int64)
    coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(raw[~space])]).dictionary_encode()
    return coded.dictionary, np.asarray(coded.indices).astype(np.int64), np.searchsorted(np.flatnonzero(parted), begin)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    """The texts in blocks of one language, long texts cut with the words around."""
    held: dict[str, list[bytes]] = defaultdict(list)
    size = 0

    def cut(lang: str, text: bytes) -> Iterator[Block]:
        at, start, tail = 0, 0, b""
        while at < len(text):
            stop = len(text) if at + 2 * BLOCK_BYTES >= len(text) else text.find(b" ", at + BLOCK_BYTES)
            stop = len(text) if stop < 0 else stop
            part, at = tail + text[at:stop], stop
            words, ids, piece = _split(part)
            to = len(ids) if stop == len(text) else len(ids) - MAX_WORDS
            if to > start:
                yield Block(lang, words, ids, piece, start, to)
            if stop < len(text):
                # the next block begins one word before the first phrase that is not counted yet
                keep = max(to, start) - 1
                tail = _from_word(part, keep) if keep >= 0 else part
                start = 1 if keep >= 0 else 0

    def all_held() -> Iterator[Block]:
        for lang, texts in held.items():
            yield from cut(lang, bytes([BREAK]).join(texts))
        held.clear()

    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(at, SLICE_ROWS)
            for lang, text in zip(part.column("lang").to_pylist(), binary_column(part, "text")):
                if text:
                    held[lang].append(text.translate(_CLEAN))
                    size += len(text)
                if size >= BLOCK_BYTES:
                    yield from all_held()
                    size = 0
    yield from all_held()


_CODED = {"lang": pa.string(), "words": pa.binary(), "codes": pa.binary(), "width": pa.int32(), "start": pa.int64(), "to": pa.int64()}


def code_texts(texts: DataFrame) -> DataFrame:
    """The blocks of ``texts(lang, text)``, a row each: different words (parted by spaces), and the words in order as their
    numbers from 1, little-endian of ``width`` bytes, with 0 between pieces; ``start`` and ``to`` as in ``Block``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _blocks(batches):
            kind = "<u2" if len(b.words) < 1 << 16 else "<u4"
            codes = np.insert((b.ids + 1).astype(kind), np.flatnonzero(np.diff(b.piece)) + 1, 0)
            row = [b.lang, b" ".join(b.words.to_pylist()), codes.tobytes(), codes.itemsize, b.start, b.to]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _CODED.values())], names=list(_CODED))

    return map_batches(texts, run, "lang string, words binary, codes binary, width int, start long, to long")


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    """The blocks that ``code_texts`` stored."""
    for batch in batches:
        for at in range(batch.num_rows):
            lang, words, codes, width, start, to = (batch.column(c)[at].as_py() for c in _CODED)
            codes = np.frombuffer(codes, f"<u{width}")
            inside = codes > 0
            piece = np.cumsum(~inside)[inside]
            yield Block(lang, pa.array(words.split(b" "), pa.large_binary()), codes[inside].astype(np.int64) - 1, piece, start, to)


def _from_word(text: bytes, k: int) -> bytes:
    """The text from its word number ``k`` on."""
    raw = np.frombuffer(text, np.uint8)
    space = (raw >= BREAK) | (raw == SPACE)
    begin = np.flatnonzero(np.diff(space.view(np.int8), prepend=1) == -1)
    return text[begin[k] :] if k < len(begin) else b""


def _rows(**columns: pa.Array) -> pa.RecordBatch:
    """A batch of ``_COUNTED``, with nulls in the columns not given."""
    size = len(columns["n"])
    return pa.RecordBatch.from_arrays([columns[c] if c in columns else pa.nulls(size, kind) for c, kind in _COUNTED.items()], names=list(_COUNTED))


_COUNTED = {"lang": pa.string(), "phrase": pa.string(), "size": pa.int32(), "h": pa.int64(), "n": pa.int64(), "before": pa.int64(), "after": pa.int64()}
_COUNTED_DDL = "lang string, phrase string, size int, h long, n long, before long, after long"


def count_words(coded: DataFrame) -> DataFrame:
    """``(lang, phrase, n)`` of all words of ``coded`` texts, and for the empty phrase those of the language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _decoded(batches):
            n = np.bincount(b.ids[b.start : b.to], minlength=len(b.words))
            some = np.flatnonzero(n)
            words = pa.concat_arrays([pa.array([""], pa.string()), b.words.take(pa.array(some)).cast(pa.binary()).cast(pa.string())])
            yield pa.RecordBatch.from_arrays([pa.repeat(b.lang, len(words)), words, pa.array(np.append(n.sum(), n[some]))], names=["lang", "phrase", "n"])

    return map_batches(coded, run, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def grams(b: Block, tables: list[Bits]) -> Iterator[pa.RecordBatch]:
    """What a block holds of the phrases asked for: counts of hashes of phrases one word longer than those to grow; of
    phrases to count, themselves with the hash of the word before and after, null where these differ or there is none."""
    good = tables[WORD].holds(b.hashes)[b.ids]
    at = b.start + np.flatnonzero(good[b.start : b.to])
    h, last = b.hashes[b.ids[at]], len(b.ids)
    for size in range(2, MAX_WORDS + 1):
        on = tables[THROUGH].holds(h) & (at + size <= last)
        end = at[on] + size - 1
        on[on] = good[end] & (b.piece[end] == b.piece[at[on]])
        at, h = at[on], h[on]
        if not len(at):
            return
        grown = tables[GROW].holds(h)
        h = longer(h, b.hashes[b.ids[at + size - 1]])
        if grown.any():
            found, n = np.unique(h[grown], return_counts=True)
            yield _rows(h=pa.array(found.view(np.int64)), n=pa.array(n))
        probed = tables[PROBE].holds(h)
        if probed.any():
            yield _probed(b, at[probed], size)


def _probed(b: Block, at: np.ndarray, size: int) -> pa.RecordBatch:
    key = b.ids[at]
    for k in range(1, size):
        key = np.unique(key * len(b.words) + b.ids[at + k], return_inverse=True)[1]
    _, first, key, n = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    words = [b.words.take(pa.array(b.ids[at[first] + k])).cast(pa.binary()) for k in range(size)]
    phrase = pc.binary_join_element_wise(*words, b" ").cast(pa.string())
    return _rows(
        lang=pa.repeat(b.lang, len(n)), phrase=phrase, size=pa.repeat(pa.scalar(size, pa.int32()), len(n)), n=pa.array(n),
        before=_shared(b, key, at, at - 1, len(n)), after=_shared(b, key, at, at + size, len(n)),
    )


def _shared(b: Block, key: np.ndarray, at: np.ndarray, beside: np.ndarray, size: int) -> pa.Array:
    """The hash of the word beside, if all places of a phrase have the same."""
    inside = np.clip(beside, 0, len(b.ids) - 1)
    word = np.where((inside == beside) & (b.piece[inside] == b.piece[at]), b.ids[inside], -1)
    low, high = np.full(size, np.iinfo(np.int64).max), np.full(size, -1)
    np.minimum.at(low, key, word)
    np.maximum.at(high, key, word)
    same = (low == high) & (low >= 0)
    return pa.array(b.hashes[np.where(same, low, 0)].view(np.int64), mask=~same)


def count_phrases(coded: DataFrame, tables, least: int) -> DataFrame:
    """``(lang, phrase, size, h, n, same)`` of what the broadcast tables ask for, from ``least`` on: hashes of grown phrases
    (``h``; the others null), and phrases with ``same``: all places have the same word before, or all the same after.
    Neighbours are compared by 64-bit hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = [Bits(w) for w in tables.value]
        for b in _decoded(batches):
            yield from grams(b, bits)

    def same(side: str):
        return (F.count(side) == F.count("*")) & (F.min(side) == F.max(side))

    found = map_batches(coded, run, _COUNTED_DDL).groupBy("lang", "phrase", "size", "h").agg(
        F.sum("n").alias("n"), F.coalesce(same("before") | same("after"), F.lit(False)).alias("same")
    )
    return found.where(F.col("n") >= least)


def hashed(phrases: DataFrame) -> DataFrame:
    """``(role, h)`` of ``phrases(lang, phrase, role)``, and of the beginnings of phrases to count, to pass through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            split = [p.split(b" ") for p in binary_column(batch, "phrase")]
            seeds = np.array([seed_of(lang) for lang in batch.column("lang").to_pylist()], np.uint64)
            role, length = batch.column("role").to_numpy(), np.array(list(map(len, split)))
            for k in range(max(length, default=0)):
                on = np.flatnonzero(length > k)
                word = hash_words(pa.array([split[i][k] for i in on], pa.large_binary()), seeds[on])
                if k:
                    h[on] = longer(h[on], word)
                else:
                    h = word
                roles = np.where(length[on] == k + 1, role[on], THROUGH)
                yield pa.RecordBatch.from_arrays([pa.array(roles, pa.int32()), pa.array(h[on].view(np.int64))], names=["role", "h"])

    return map_batches(phrases, run, "role int, h long")


def bit_tables(hashes: DataFrame) -> dict[int, np.ndarray]:
    """Bit tables of ``hashes(role, h)``, by role."""
    sizes = {r.role: r.n for r in hashes.groupBy("role").agg(F.count("*").alias("n")).collect()}
    bits = {r: min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_EACH * n - 1).bit_length())) for r, n in sizes.items()}
    tables = {r: np.zeros(n // 64, np.uint64) for r, n in bits.items()}
    if not tables:
        return tables
    mask = reduce(lambda c, r: c.when(F.col("role") == r, F.lit(bits[r] - 1)), bits, F).otherwise(F.lit(0)).cast("long")
    place = hashes.select("role", F.explode(F.array(F.col("h"), F.shiftrightunsigned("h", 29))).alias("at"), mask.alias("mask"))
    place = place.select("role", F.col("at").bitwiseAND(F.col("mask")).alias("at"))
    made = place.groupBy("role", F.shiftright("at", 6).alias("slot")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 AS int))")).alias("bits"))
    made = made.toArrow()  # of the bounded size of the tables
    role, slot, words = (made.column(c).to_numpy() for c in ("role", "slot", "bits"))
    for r in tables:
        tables[r][slot[role == r]] = words[role == r].view(np.uint64)
    return tables


def _judged(nodes: DataFrame, totals: DataFrame, k: int) -> DataFrame:
    """``nodes`` of two words and more with what is known of their scores: ``best`` (the lowest score of the cuts
    known, with cut, l and r), ``whole`` (all cuts known), ``ub`` (no cut scores more), and n."""
    counts = nodes.select("lang", "phrase", "a")
    words = F.split("phrase", " ")
    cuts = nodes.where("size > 1").select("lang", "phrase", "size", "a", "same", words.alias("w"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("cut"))
    cuts = cuts.select(
        "lang", "phrase", "size", "a", "same", "cut", F.array_join(F.slice("w", 1, F.col("cut")), " ").alias("head"),
        F.array_join(F.slice("w", F.col("cut") + 1, F.col("size") - F.col("cut")), " ").alias("rest"),
    )
    cuts = cuts.join(counts.toDF("lang", "head", "l"), ["lang", "head"], "left").join(counts.toDF("lang", "rest", "r"), ["lang", "rest"], "left")
    cuts = cuts.join(totals, "lang")
    big = "decimal(38,0)"
    both = F.col("l").isNotNull() & F.col("r").isNotNull()
    score = F.expr(f"cast(1000 as {big}) * a * n div (cast(l as {big}) * r)")
    return cuts.groupBy("lang", "phrase", "size", "a", "same", "n").agg(
        F.min(F.when(both, F.struct(score.alias("score"), "cut", "l", "r"))).alias("best"), (F.count(F.when(both, 1)) == F.col("size") - 1).alias("whole"),
        F.max(F.greatest("l", "r")).alias("part"),
        F.collect_set(F.when(F.col("l").isNull(), F.col("head"))).alias("heads"), F.collect_set(F.when(F.col("r").isNull(), F.col("rest"))).alias("rests"),
    ).withColumn("ub", F.least(F.col("best.score"), F.expr(f"cast(1000 as {big}) * n div part"))).drop("part")


def mine_collocations(docs: DataFrame, k: int = 2000, text: str = "text", lang: str = "lang", least: int = LEAST_COUNT) -> DataFrame:
    """The ``k`` best phrases of each language: ``(lang, rank, phrase, a, l, r, n, score, cut)``.

    Texts (A-Z lower-cased) are split into pieces at ``.,;:!?`` and line ends, pieces into words at spaces and tabs. n counts
    the words of the language, f the places of a phrase within pieces, overlapping ones too. Phrases of 2 to 5 words
    with a = f >= ``least`` are candidates; cut after a word, with l and r the counts of both parts, one scores
    floor(1000 a n / (l r)), and its lowest cut counts, of equal ones the first. A phrase whose every place is inside one and the
    same longer candidate is left out. Ranked by score, then a (both descending), then phrase.

    A null language counts as ``und``. Null and empty texts have no words; every row counts, repeated ones too; empty
    tables and languages without candidates give no rows.
    """
    texts = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text}`").cast("string").alias("text"))
    coded = stored(code_texts(texts), "collocation_texts", compression="zstd")
    counted = stored(count_words(coded).where(f"phrase = '' OR n >= {least}"), "collocation_words")
    totals = counted.where("phrase = ''").select("lang", "n")
    words = counted.where("phrase <> ''").selectExpr("lang", "phrase", "n AS a")
    grown = words.select("lang", "phrase").limit(0)
    fixed = bit_tables(hashed(words.select("lang", "phrase", F.lit(WORD).alias("role"))))
    nodes = words.selectExpr("lang", "phrase", "1 AS size", "a", "cast(null AS boolean) AS same")
    none = docs.sparkSession.createDataFrame([], "role int, h long")
    # words by how often they occur, in steps of 2^(1/8), and how many places rarer words have
    step_of = F.floor(F.log2("a") * 8).cast("int")
    steps = words.groupBy("lang", step_of.alias("step")).agg(F.sum("a").alias("places"))
    rarer = F.sum("places").over(Window.partitionBy("lang").orderBy("step")) - F.col("places")
    steps = stored(steps.select("lang", "step", rarer.alias("rarer")), "collocation_steps")
    pending, share, step = none, FIRST_SHARE, 0
    # tables of all rounds, a folder each: plans, and what the driver keeps of them, don't grow with the rounds
    all_asked, all_hashes = run_dir(docs.sparkSession, "collocation_asked"), run_dir(docs.sparkSession, "collocation_hashes")
    while True:
        step += 1
        judged = stored(_judged(nodes, totals, k), "collocation_judged")
        alive = judged.where(f"whole AND (size = {MAX_WORDS} OR NOT same)")
        place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("best.score")))
        kth = alive.withColumn("place", place).where(F.col("place") == k).select("lang", F.col("best.score").alias("least"))
        # words whose bound reaches the k-th score, the rarest first; the second round waits for the first scores
        open_ = words.join(grown, ["lang", "phrase"], "left_anti").join(totals, "lang").join(kth, "lang", "left")
        open_ = open_.where("1000 * cast(n AS decimal(38,0)) div a >= coalesce(least, 0)")
        new = open_.withColumn("step", step_of).join(steps, ["lang", "step"])
        new = new.where(F.lit(step != 2) & (F.col("rarer") <= share * F.col("n"))).select("lang", "phrase")
        close = judged.join(kth, "lang", "left").where("ub >= coalesce(least, 0)")
        wanted = close.select("lang", F.explode(F.concat("heads", "rests")).alias("phrase")).distinct()
        asked = stored(new.withColumn("role", F.lit(GROW)).unionByName(wanted.withColumn("role", F.lit(PROBE))), "collocation_asked", path=f"{all_asked}/round={step}")
        hashes = stored(hashed(asked).unionByName(pending), "collocation_hashes", path=f"{all_hashes}/round={step}")
        if hashes.isEmpty():
            if share >= 1 and step != 2:
                break
            share = 1
            continue
        so_far = docs.sparkSession.read.schema(hashes.schema).parquet(all_hashes).select("role", "h")
        through = so_far.where(F.col("role") != PROBE).select(F.lit(THROUGH).alias("role"), "h")
        tables = fixed | bit_tables(hashes.where(F.col("role") != THROUGH).unionByName(through))
        empty = np.zeros(1, np.uint64)
        sent = docs.sparkSession.sparkContext.broadcast([tables.get(r, empty) for r in (WORD, GROW, PROBE, THROUGH)])
        found = stored(count_phrases(coded, sent, least), "collocation_found")
        sent.destroy()
        # hashes found are counted as phrases, and grown, by the next scan; those that a chance hit grew again are done
        done = so_far.where(F.col("role") == GROW).select("h")
        pending = found.where("h IS NOT NULL").select("h").join(done, "h", "left_anti").select(F.explode(F.array(F.lit(GROW), F.lit(PROBE))).alias("role"), "h")
        more = found.where("h IS NULL").selectExpr("lang", "phrase", "size", "n AS a", "same")
        nodes = nodes.unionByName(more).groupBy("lang", "phrase").agg(F.max("size").alias("size"), F.max("a").alias("a"), F.bool_or("same").alias("same"))
        nodes = stored(nodes, "collocation_nodes")
        grown = docs.sparkSession.read.schema(asked.schema).parquet(all_asked).where(F.col("role") == GROW).select("lang", "phrase")
        share *= 1 if step == 2 else 2
    by = Window.partitionBy("lang").orderBy(F.desc("best.score"), F.desc("a"), "phrase")
    ranked = alive.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "best.l", "best.r", "n", "best.score", "best.cut")
