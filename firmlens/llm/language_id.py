"""Language identification by rank-order n-gram profiles.

A profile is the list of the most frequent 1- to 3-grams of a language, by rank. A document's
own profile is compared with each by the out-of-place distance: the sum over its n-grams of
the difference of ranks, and of the profile size for n-grams the language's profile lacks.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmlens.llm.common import annotate, arrow_map, binary_column, stored

SIZE = 400  # n-grams in a profile
SAMPLE = 2000  # documents per language that a profile is learned from, about
MAX_LANGUAGES = 1000  # more distinct labels are an error: profiles go to every task
MARK = 1
PIECE = 1 << 20  # characters counted at once


@lru_cache(1)
def _fold() -> np.ndarray:
    """Code point -> its lower-case letter, or the word mark for anything that is no letter."""
    out = np.full(0x110000, MARK, dtype=np.int64)
    for c in range(0x110000):
        if chr(c).isalpha():
            low = chr(c).lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def ngram_counts(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Codes of a text's 1- to 3-grams, ascending, and their counts.

    Words are runs of letters, lower-cased, with a mark at both ends; n-grams lie within a
    marked word. An n-gram's code is its code points in base 2^21.
    """
    codes = np.frombuffer((text or b"").decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32)
    parts = []
    for at in range(0, len(codes), PIECE):  # pieces overlap by two characters
        c = _fold()[codes[max(0, at - 2) : at + PIECE]]
        if not at:
            c = np.concatenate([[MARK], c])
        if at + PIECE >= len(codes):
            c = np.concatenate([c, [MARK]])
        seen = 0 if not at else 2
        c2 = np.concatenate([c, [0, 0]])
        one, two, three = c, (c << 21) | c2[1:-1], (c << 42) | (c2[1:-1] << 21) | c2[2:]
        n = len(c)
        # an n-gram belongs to the piece that holds its last character
        one, two, three = one[seen:], two[max(seen - 1, 0) : n - 1], three[: n - 2]
        parts += [one[one != MARK], two[two != MARK << 21 | MARK], three[(three >> 21) & 0x1FFFFF != MARK]]
    if not parts:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    return np.unique(np.concatenate(parts), return_counts=True)


def top_ngrams(codes: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent codes by rank; ties by code."""
    if len(codes) > size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        keep = counts >= least
        codes, counts = codes[keep], counts[keep]
    return codes[np.lexsort((codes, -counts))][:size]


class Profiles:
    """Ranks of n-grams by language, for comparison of documents."""

    def __init__(self, ranked: dict[str, list[int]], size: int):
        self.size, self.langs = size, sorted(ranked)
        self.codes = np.unique(np.concatenate([np.asarray(v, dtype=np.int64) for v in ranked.values()] or [np.empty(0, np.int64)]))
        self.rank = np.full((len(self.codes) + 1, len(self.langs)), -1, dtype=np.int32)
        for k, lang in enumerate(self.langs):
            self.rank[np.searchsorted(self.codes, np.asarray(ranked[lang], dtype=np.int64)), k] = np.arange(len(ranked[lang]))

    def predict(self, text: bytes | None) -> tuple[str, float]:
        """Nearest language (ties: the smaller name) and 1 - distance / largest distance."""
        own = top_ngrams(*ngram_counts(text), self.size)
        if not len(own) or not self.langs:
            return "und", 0.0
        at = np.searchsorted(self.codes, own)
        at[(at == len(self.codes)) | (self.codes[np.minimum(at, len(self.codes) - 1)] != own)] = len(self.codes)
        rank = self.rank[at]
        away = np.where(rank < 0, self.size, np.abs(rank - np.arange(len(own))[:, None])).sum(axis=0)
        best = int(away.argmin())
        return self.langs[best], float(1 - away[best] / (self.size * len(own)))


def learn_profiles(
    docs: DataFrame, lang: str = "lang", text: str = "text", id_col: str = "doc_id", size: int = SIZE, sample: int = SAMPLE
) -> dict[str, list[int]]:
    """Ranked n-gram codes by language, from about ``sample`` documents of each, chosen by a hash
    of the id (all, where there are fewer). Null languages, texts and ids teach nothing. What
    comes to the driver is ``size`` numbers per language; over MAX_LANGUAGES languages raise."""
    docs = docs.select(
        F.col(id_col).cast("string").alias("id"), F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text")
    ).where("id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL")
    known = docs.groupBy("lang").count()
    found = known.limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not found:
        return {}
    share = F.create_map(*[F.lit(x) for r in found for x in (r["lang"], min(1.0, sample / r["count"]))])
    place = F.pmod(F.xxhash64(F.lit("language profile"), "id"), F.lit(1 << 30)) / float(1 << 30)
    chosen = docs.where(place < share[F.col("lang")])

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        by_lang: dict[str, list] = {}
        for name, t in zip(batch.column("lang").to_pylist(), binary_column(batch, "text")):
            by_lang.setdefault(name, []).append(ngram_counts(t))
        out: tuple[list, list, list] = ([], [], [])
        for name, parts in by_lang.items():
            codes, at = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
            out[0].extend([name] * len(codes))
            out[1].append(codes)
            out[2].append(np.bincount(at, np.concatenate([n for _, n in parts]), len(codes)).astype(np.int64))
        joined = [pa.array(np.concatenate(x) if x else np.empty(0, np.int64), pa.int64()) for x in out[1:]]
        return pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), *joined], names=["lang", "code", "n"])

    total = arrow_map(chosen, rows, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    # the most frequent codes of each language: the most of every slice of codes, then of those
    for part in (F.pmod(F.xxhash64("code"), F.lit(64)), F.lit(0)):
        best = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("less"), "code"))), 1, size)
        total = (
            total.groupBy("lang", part.alias("part")).agg(best.alias("best"))
            .select("lang", F.explode("best").alias("b")).select("lang", F.col("b.code").alias("code"), (-F.col("b.less")).alias("n"))
        )
    ranked = stored(total, "language_profiles").groupBy("lang").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("less"), "code"))).alias("codes")
    )
    return {r.lang: [c.code for c in r.codes] for r in ranked.collect()}


def identify(docs: DataFrame, ranked: dict[str, list[int]], text: str = "text", size: int = SIZE) -> DataFrame:
    """``docs`` packed as ``doc`` (see ``common.annotate``) with ``lang_pred`` and ``score``.

    The whole text is compared; only the text is used. Null text, no letters, or no profiles:
    ``und`` with score 0. ``score`` is 1 - distance / largest possible distance.
    """
    made: list[Profiles] = []

    def compute(texts: list[bytes | None]) -> list[pa.Array]:
        if not made:
            made.append(Profiles(ranked, size))
        found = [made[0].predict(t) for t in texts]
        return [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]

    return annotate(docs, text, "lang_pred string, score double", compute)


def held_out(doc_id: str = "doc_id") -> Column:
    """True where crc32 of the id as text leaves 2 modulo 4; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))
