"""MinHash near-duplicates with sequential Bayesian verification.

Documents whose word sequences are equal form one class. Classes are banded by MinHash;
candidates compare their signatures batch by batch, and a pair is dropped as soon as the
posterior probability that its similarity reaches the threshold falls under the chosen miss
probability. Survivors are verified on their full shingle sets.

Candidates come in rounds, so that a bucket never expands into all its pairs:

1. star rounds: every member of a bucket with one member of it, first the smallest, then (with
   more rounds) one of the bucket's largest component by hash, unless they are in one component;
2. rest: only buckets whose members still lie in different components, members of
   different components only, dealt out as pairs of bounded blocks.

A pair that shares a bucket is either compared or already known to be in one component, so
the components are those of all candidate pairs.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache, reduce
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmlens.llm.common import arrow_map, binary_column, components, stored, stream_groups

BANDS, ROWS = 40, 4  # miss probability of banding at similarity 0.75: (1 - 0.75^4)^40 = 2.5e-7
BATCH = 16  # signature values compared per step
MISS = 1e-7  # a pair is dropped when P(similarity >= threshold | matches so far) is below
STARS = 1  # star rounds before the rest
TASK_DOCS = 20_000  # documents per task where results are a small part of what is read
BLOCK = 512  # members of a bucket compared in one block
CHUNK = 1 << 17  # bytes hashed at once
LONG_WORD = 1024  # longer words stand for themselves by digest

_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_MUL = _rng.integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(1, 2**63, BANDS * ROWS, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15  # odd: has an inverse modulo 2^64
_INVERSE = pow(_BASE, -1, 2**64)


@lru_cache(1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    def powers(base: int) -> np.ndarray:
        out = np.full(CHUNK + 64 * LONG_WORD, base, dtype=np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    return powers(_BASE), powers(_INVERSE)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _span_hashes(words: list[bytes], n: int) -> np.ndarray:
    """64-bit hashes of every run of ``n`` words, by prefix sums of a polynomial hash."""
    power, inverse = _powers()
    data = np.frombuffer(b" ".join(words), dtype=np.uint8)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * power[: len(data)], out=sums[1:])
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    end = np.cumsum(size + 1) - 1
    start = (end - size)[: len(words) - n + 1]
    end = end[n - 1 :]
    return _mix((sums[end] - sums[start]) * inverse[start])


def shingle_set(text: bytes | None, n: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's ``n``-word shingles (see ``near_duplicates``)."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    if max(map(len, words)) > LONG_WORD:
        words = [w if len(w) <= LONG_WORD else b"\0" + hashlib.sha256(w).hexdigest().encode() for w in words]
    if len(words) <= n:
        return _span_hashes(words, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    parts, at = [], 0
    while at < len(words) - n + 1:  # pieces of about CHUNK bytes that overlap by n - 1 words
        before = ends[at - 1] if at else 0
        to = max(at + n, int(np.searchsorted(ends, before + CHUNK)))
        parts.append(_span_hashes(words[at:to], n))
        at = to - n + 1
    return np.unique(np.concatenate(parts))


def signature(shingles: np.ndarray) -> np.ndarray:
    """MinHash signature (upper 16 bits of the minima) of a non-empty shingle set."""
    low = np.full(len(_MUL), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), 2048):
        values = shingles[None, at : at + 2048] * _MUL[:, None]
        values += _ADD[:, None]
        np.minimum(low, values.min(axis=1), out=low)
    return (low >> np.uint64(48)).astype(np.uint16)


@lru_cache(8)
def _least_matches(threshold: float, miss: float = MISS) -> dict[int, int]:
    """By number n of compared values: the fewest matches m that keep a pair. The posterior of
    the similarity under a uniform prior is Beta(m + 1, n - m + 1), whose upper tail at the
    threshold is P(Binomial(n + 1, threshold) <= m)."""
    out = {}
    for n in range(BATCH, BANDS * ROWS + 1, BATCH):
        tail, m = 0.0, 0
        while m <= n:
            tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if tail >= miss:
                break
            m += 1
        out[n] = m
    return out


def surviving_pairs(left: np.ndarray, right: np.ndarray, allowed: np.ndarray, threshold: float) -> np.ndarray:
    """Index pairs (i, j) of ``allowed`` whose signatures survive the sequential test."""
    i, j = np.nonzero(allowed)
    matches = np.zeros(len(i), dtype=np.int32)
    for n, least in _least_matches(threshold).items():
        if not len(i):
            break
        part = slice(n - BATCH, n)
        matches += (left[i, part] == right[j, part]).sum(axis=1, dtype=np.int32)
        keep = matches >= least
        i, j, matches = i[keep], j[keep], matches[keep]
    return np.stack([i, j], axis=1)


def _features(docs: DataFrame, n: int) -> DataFrame:
    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        size, key, sig = [], [], []
        for text in binary_column(batch, "text"):
            s = shingle_set(text, n)
            size.append(len(s))
            words = b" ".join((text or b"").lower().split())
            key.append(hashlib.blake2b(words, digest_size=16).digest() if words else None)
            sig.append(signature(s).tobytes() if len(s) else None)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(key, pa.binary()), pa.array(sig, pa.binary())],
            names=["doc_id", "n_shingles", "key", "sig"],
        )

    return arrow_map(docs, rows, "doc_id long, n_shingles long, key binary, sig binary")


def _bands(classes: DataFrame) -> DataFrame:
    """(id, band, bucket): one row per class and band; a bucket is the hash of band and values."""
    width = 2 * ROWS
    bucket = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda b: F.xxhash64(b, F.substring("sig", b * width + 1, F.lit(width))),
    )
    return classes.select("id", F.posexplode(bucket).alias("band", "bucket"))


def _sieve(pairs: DataFrame, sigs: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) whose signatures survive the sequential Bayesian test."""
    ratio = f"least(sa, sb) >= {threshold} * greatest(sa, sb)"
    joined = (
        pairs.join(sigs.selectExpr("id AS a", "sig AS x", "n_shingles AS sa"), "a")
        .join(sigs.selectExpr("id AS b", "sig AS y", "n_shingles AS sb"), "b")
        .where(ratio)
        .select("a", "b", "x", "y")
    )

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        x, y = (
            np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint16).reshape(batch.num_rows, -1) for c in "xy"
        )
        at, matches = np.arange(batch.num_rows), np.zeros(batch.num_rows, dtype=np.int32)
        for n, least in _least_matches(threshold).items():
            part = slice(n - BATCH, n)
            matches += (x[at, part] == y[at, part]).sum(axis=1, dtype=np.int32)
            at, matches = at[matches >= least], matches[matches >= least]
        return batch.select(["a", "b"]).take(pa.array(at))

    return arrow_map(joined, rows, "a long, b long")


def _block_pairs(t: pa.Table, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a pair of blocks that survive together: of different components, of sizes that
    allow the threshold, and in no earlier band together."""
    own = t.column("own").to_numpy()
    same = t.column("i")[0].as_py() == t.column("j")[0].as_py()
    l, r = (np.arange(len(own)),) * 2 if same else (np.nonzero(own == t.column(c)[0].as_py())[0] for c in "ij")
    ids, comp, size = (t.column(c).to_numpy() for c in ("id", "comp", "n_shingles"))
    sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), dtype=np.uint16).reshape(len(own), -1)
    least, most = np.minimum.outer(size[l], size[r]), np.maximum.outer(size[l], size[r])
    allowed = (comp[l][:, None] != comp[r][None, :]) & (least >= threshold * most)
    if same:
        allowed &= ids[l][:, None] > ids[r][None, :]
    found = surviving_pairs(sig[l], sig[r], allowed, threshold)
    x, y = l[found[:, 0]], r[found[:, 1]]
    band = t.column("band")[0].as_py()
    before = (sig[v, : band * ROWS].reshape(len(v), band, ROWS) for v in (x, y))
    first = ~np.equal(*before).all(axis=2).any(axis=1)
    return x[first], y[first]


def _rest(members: DataFrame, texts: DataFrame, n: int, threshold: float, parts: int) -> DataFrame:
    """Verified links between different components within buckets.

    ``members(bucket, band, id, comp, n_shingles, sig, size)``: a bucket of more than BLOCK members
    is dealt into blocks; every pair of blocks is one bounded group. The first pass keeps the
    members that survive with any other; they get their shingle sets, and the second
    verifies, but for pairs whose components the group has linked already. Members move, not pairs.
    """
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    dealt = (
        members.withColumn("blocks", blocks)
        .withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
            "own", "band", "id", "comp", "n_shingles", "sig",
        )
    )
    keys = ["bucket", "i", "j"]

    def involved(t: pa.Table) -> pa.Table:
        return t.take(pa.array(np.unique(np.concatenate(_block_pairs(t, threshold)))))

    kept = stored(stream_groups(dealt, keys, involved, dealt.schema.simpleString()[7:-1].replace(":", " ")), "near_dup_rest", parts)
    full = _shingle_sets(texts, kept.select("id").distinct(), n, parts)
    limit = round(100 * threshold)

    def verify(t: pa.Table) -> pa.Table:
        ids, comp = t.column("id").to_numpy(), t.column("comp").to_numpy()
        sets = [np.frombuffer(x, dtype=np.uint64) for x in t.column("shingles").to_pylist()]
        root: dict[int, int] = {}

        def find(c: int) -> int:
            while c in root:
                c = root[c]
            return c

        links = []
        for x, y in zip(*_block_pairs(t, threshold)):
            p, q = find(int(comp[x])), find(int(comp[y]))
            if p != q and linked(sets[x], sets[y], limit):
                root[p] = q
                links.append((max(ids[x], ids[y]), min(ids[x], ids[y])))
        return pa.table({c: pa.array([link[k] for link in links], pa.int64()) for k, c in enumerate("ab")})

    return stream_groups(kept.join(full, "id"), keys, verify, "a long, b long")


def linked(p: np.ndarray, q: np.ndarray, percent: int) -> bool:
    """Whether two shingle sets are similar enough."""
    common = len(np.intersect1d(p, q, assume_unique=True))
    return common > 0 and 100 * common >= percent * (len(p) + len(q) - common)


def _shingle_sets(texts: DataFrame, ids: DataFrame, n: int, parts: int) -> DataFrame:
    """``id, shingles`` (sorted 64-bit hashes) of the given ids."""

    def sets(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [shingle_set(t, n).tobytes() for t in binary_column(batch, "text")]
        return pa.RecordBatch.from_arrays([batch.column("id"), pa.array(made, pa.binary())], names=["id", "shingles"])

    return stored(arrow_map(texts.join(ids, "id"), sets, "id long, shingles binary"), "near_dup_sets", parts)


def _verified(pairs: DataFrame, texts: DataFrame, n: int, threshold: float, parts: int) -> DataFrame:
    """The (distinct) pairs whose full shingle sets reach the threshold; ``texts(id, text)`` holds both sides."""
    pairs = stored(pairs, "near_dup_pairs", parts)
    ids = pairs.selectExpr("a AS id").union(pairs.selectExpr("b AS id")).distinct()

    full = _shingle_sets(texts, ids, n, parts)
    joined = pairs.join(full.selectExpr("id AS a", "shingles AS x"), "a").join(
        full.selectExpr("id AS b", "shingles AS y"), "b"
    )
    limit = round(100 * threshold)

    def check(batch: pa.RecordBatch) -> pa.RecordBatch:
        x, y = ([np.frombuffer(v, dtype=np.uint64) for v in batch.column(c).to_pylist()] for c in "xy")
        keep = [at for at, (p, q) in enumerate(zip(x, y)) if linked(p, q, limit)]
        return batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    return arrow_map(joined.select("a", "b", "x", "y"), check, "a long, b long")


def near_duplicates(docs: DataFrame, n: int = 5, threshold: float = 0.75) -> DataFrame:
    """Components of near-duplicate documents: ``doc_id, n_shingles, component_id, kept``.

    A document's set holds its distinct ``n``-word shingles (words are runs without ASCII white
    space, A-Z lower-cased; fewer than ``n`` words are one shingle). Documents are linked from
    a Jaccard similarity of ``threshold`` (a whole percentage) on. ``component_id`` is the
    smallest doc_id reachable, ``kept`` marks that document.

    Null or empty text: no shingles, linked with nothing. Null doc_id: linked with nothing,
    component_id null, kept. Rows that repeat a doc_id count as one document with the links of
    all of them; each row is returned. Other columns are ignored. An empty table gives none.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    feats = stored(_features(docs, n), "near_dup_features")
    parts = max(24, feats.count() // TASK_DOCS)
    named = feats.where("doc_id IS NOT NULL AND key IS NOT NULL")
    reps = stored(named.groupBy("key").agg(F.min("doc_id").alias("rep")), "near_dup_classes")
    classes = stored(
        named.join(reps.withColumnRenamed("rep", "doc_id"), ["key", "doc_id"])
        .dropDuplicates(["doc_id", "key"])
        .select(F.col("doc_id").alias("id"), "n_shingles", "sig"),
        "near_dup_signatures",
    )
    bands = _bands(classes)
    crowded = bands.groupBy("bucket").count().where("count > 1").select("bucket")
    shared = stored(bands.join(crowded, "bucket"), "near_dup_buckets")
    # whole texts are shuffled once, at any size of the other side, and kept for the candidates only
    candidates = shared.select("id").distinct().hint("merge")
    texts = stored(docs.withColumnRenamed("doc_id", "id").join(candidates, "id").distinct(), "near_dup_texts", compression="zstd")
    labelled, links, roots = shared.withColumn("comp", F.col("id")), [], None
    for turn in range(STARS + 1):
        if roots is not None:
            joined = shared.join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("comp", F.coalesce("root", "id"))
            labelled = stored(joined.select("bucket", "band", "id", "comp"), "near_dup_labelled")
        first = F.xxhash64("id", "bucket", F.lit(turn)) if turn else F.col("id")
        sides = labelled.groupBy("bucket", "comp").agg(
            F.count("*").alias("n"), F.min(F.struct(first.alias("first"), "id")).alias("rep")
        )
        largest = F.struct("n", "comp", "rep.id") if turn else F.struct((-F.col("rep.first")).alias("n"), "comp", "rep.id")
        mixed = (
            sides.groupBy("bucket").agg(F.count("*").alias("sides"), F.sum("n").alias("size"), F.max(largest).alias("rep"))
            .where("sides > 1")
        )
        if turn < STARS:
            star = labelled.join(mixed, "bucket").where("comp <> rep.comp")
            found = _sieve(star.selectExpr("greatest(id, rep.id) AS a", "least(id, rep.id) AS b").distinct(), classes, threshold)
            links.append(stored(_verified(found, texts, n, threshold, parts), "near_dup_links", parts))
            roots = components(reduce(DataFrame.unionByName, links), rounds=1, parts=parts)
        else:
            members = labelled.join(mixed.select("bucket", "size"), "bucket").join(classes, "id")
            links.append(stored(_rest(members, texts, n, threshold, parts), "near_dup_links", parts))
    own = named.select("doc_id", "key").join(reps, "key").where("doc_id <> rep").selectExpr("doc_id AS a", "rep AS b")
    roots = components(reduce(DataFrame.unionByName, [*links, own]), parts=parts)
    return (
        feats.select("doc_id", "n_shingles")
        .join(roots.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .withColumn("component_id", F.coalesce("root", "doc_id"))
        .select("doc_id", "n_shingles", "component_id", F.coalesce(F.expr("doc_id = component_id"), F.lit(True)).alias("kept"))
    )
