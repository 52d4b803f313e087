"""Exact top-k search by inner product with multi-resolution segment statistics.

A vector is cut into segments, each summarised by its mean and deviation. With segments of
m components, the squared distance of q and x is at least the sum over segments of
m ((mean_q - mean_x)^2 + (dev_q - dev_x)^2); as |x|^2 is the sum of m (mean^2 + dev^2), the
inner product is at most the sum of m (mean_q mean_x + dev_q dev_x). Bounds go from few
segments to many; only candidates whose bound reaches the k-th best score so far go on,
and the survivors' scores are exact.

Queries and candidates meet in pairs of blocks of bounded size, one group per pair.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firmlens.llm.common import group_batches

LEVELS = (4, 16)  # segments, coarse to fine
BASE_BLOCK, QUERY_BLOCK = 65_536, 2_048
AT_ONCE = 32  # queries compared with a block at once
EXACT = 2.0**53


def segment_statistics(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Rows of sqrt(m) * mean and sqrt(m) * deviation of each segment: the dot product of two such
    rows bounds the inner product of the vectors from above."""
    size = vectors.shape[1]
    parts = np.array_split(np.arange(size), min(segments, size)) if size else []
    out = []
    for p in parts:
        v = vectors[:, p]
        mean = v.mean(axis=1)
        out += [mean * math.sqrt(len(p)), np.sqrt(np.maximum((v * v).mean(axis=1) - mean * mean, 0) * len(p))]
    return np.stack(out, axis=1) if out else np.zeros((len(vectors), 1))


def search_block(q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, x_ids: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(query index, vec_id, score) of each query's k best of a block: highest score, then smallest
    id; vectors with the query's id don't count. ``q`` and ``x`` hold whole numbers as doubles."""
    order = np.argsort(x_ids, kind="stable")
    x, x_ids = x[order], x_ids[order]
    big = q.shape[1] * (np.abs(q).max(initial=0) * np.abs(x).max(initial=0)) >= EXACT
    if big:  # beyond exact doubles: whole-number arithmetic, scores held at the ends of the long range
        rows = [[int(v) for v in r] for r in x]
        out = []
        for at, r in enumerate(q):
            r = [int(v) for v in r]
            score = sorted(((-sum(a * b for a, b in zip(r, v)), i) for v, i in zip(rows, x_ids.tolist()) if i != q_ids[at]))
            out += [(at, i, max(min(-s, 2**63 - 1), -(2**63))) for s, i in score[:k]]
        return out
    qs, xs = ([segment_statistics(v, n) for n in LEVELS] for v in (q, x))
    out = []
    for first in range(0, len(q), AT_ONCE):
        rough = qs[0][first : first + AT_ONCE] @ xs[0].T
        for at, bound in enumerate(rough, first):
            bound = np.where(x_ids == q_ids[at], -np.inf, bound)
            usable = int(np.count_nonzero(bound > -np.inf))
            if not usable:
                continue
            slack = 1e-6 * (1 + np.abs(bound[bound > -np.inf]).max())
            take = min(4 * k, usable)
            likely = np.argpartition(-bound, take - 1)[:take]
            best = np.sort(x[likely] @ q[at])[::-1][: min(k, usable)][-1]  # k-th score so far
            left = np.nonzero(bound >= best - slack)[0]
            for fine_q, fine_x in zip(qs[1:], xs[1:]):
                left = left[fine_x[left] @ fine_q[at] >= best - slack]
            score = x[left] @ q[at]
            top = left[np.lexsort((x_ids[left], -score))][:k]
            out += [(at, int(x_ids[t]), int(x[t] @ q[at])) for t in top]
    return out


def top_k_search(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the k rows of ``vectors`` with the highest inner product for
    each row of ``queries`` (both with ``id_col`` and ``vector``), ties to the smaller id; fewer, if there are
    fewer. Components count as floor(256 * x), so scores are whole numbers.

    Rows with the query's id are its own and no candidates. Null ids, null vectors and vectors
    that hold null or non-finite components take no part; only vectors of the query's length are
    candidates. Repeated candidate rows each count; repeated query rows are one query.
    Scores outside the long range are held at its ends. Empty tables give none.
    """

    def usable(df: DataFrame) -> DataFrame:
        v = F.col(vector).cast("array<double>")
        fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        whole = F.transform(v, lambda x: F.floor(x * 256.0).cast("double"))
        return df.where(F.col(id_col).isNotNull() & F.col(vector).isNotNull() & fine).select(
            F.col(id_col).cast("long").alias("id"), whole.alias("v")
        )

    base, asked = usable(vectors), usable(queries).distinct()
    cores = base.sparkSession.sparkContext.defaultParallelism
    q_blocks = max(1, math.ceil(asked.count() / QUERY_BLOCK))
    b_blocks = max(math.ceil(base.count() / BASE_BLOCK), math.ceil(2 * cores / q_blocks))
    block = F.pmod(F.xxhash64("id", F.spark_partition_id()), F.lit(b_blocks)).cast("int")
    pairs = base.select(
        block.alias("b"), F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))).alias("q"), F.lit(False).alias("asks"), "id", "v"
    ).unionByName(
        asked.select(
            F.explode(F.sequence(F.lit(0), F.lit(b_blocks - 1))).alias("b"),
            F.pmod(F.xxhash64("id", "v"), F.lit(q_blocks)).cast("int").alias("q"), F.lit(True).alias("asks"), "id", "v",
        )
    )

    def group(t: pa.Table) -> pa.Table:
        asks, ids = t.column("asks").to_numpy(), t.column("id").to_numpy()
        lists = t.column("v").combine_chunks()
        size = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        start = np.concatenate([[0], np.cumsum(size)])
        found: list[tuple[int, int, int, int]] = []
        for n in np.unique(size[asks]):
            pick = [np.nonzero((asks == side) & (size == n))[0] for side in (True, False)]
            q, x = (flat[start[p][:, None] + np.arange(n)] for p in pick)
            found += [(int(ids[pick[0][i]]), int(pick[0][i]), c, s) for i, c, s in search_block(q, ids[pick[0]], x, ids[pick[1]], k)]
        # a query is told apart by its id and vector
        digest = {i: hashlib.blake2b(flat[start[i] : start[i + 1]].tobytes(), digest_size=8).digest() for i in {f[1] for f in found}}
        mark = {i: int.from_bytes(d, "little", signed=True) for i, d in digest.items()}
        return pa.table({
            "query_id": pa.array([f[0] for f in found], pa.int64()), "mark": pa.array([mark[f[1]] for f in found], pa.int64()),
            "vec_id": pa.array([f[2] for f in found], pa.int64()), "score": pa.array([f[3] for f in found], pa.int64()),
        })

    found = group_batches(pairs, ["b", "q"], group, "query_id long, mark long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id", "mark").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
