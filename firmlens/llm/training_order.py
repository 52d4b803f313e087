"""Training-order materialisation of token sequences.

Documents' token ids are cut into sequences of fixed length, stored once; a sequence's index is its
place in that stored table (files by name, rows in order). A keyed Feistel permutation of
the indexes, cycle-walked into their range, gives every sequence its global slot. Range partitions of slots
are written as shards of equally many rows; every row's token bytes have the same length, so
slot s is row s mod ``shard_rows`` of shard s div ``shard_rows``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmlens.llm.common import map_batches, stored, vector_function
from firmlens.session import run_dir

ROUNDS = 6
MAX_FILES = 200_000  # files of the stored sequence table, at most; their row counts are sent to the tasks
MAX_TASKS = 20_000  # tasks that write shards, at most: each writes a run of shards


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """The keyed permutation of 0..n-1 at ``index``: a balanced Feistel network over the next even
    number of bits, applied again to results of n or more (cycle-walking)."""
    half = max(1, math.ceil(max(n - 1, 1).bit_length() / 2))
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    keys = [np.uint64((key * 0x9E3779B97F4A7C15 + r * 0xD1B54A32D192ED03 + 1) % 2**64) for r in range(ROUNDS)]

    def network(v: np.ndarray) -> np.ndarray:
        left, right = v >> shift, v & mask
        for k in keys:
            left, right = right, left ^ (_mix((right + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) ^ k) & mask)
        return (left << shift) | right

    out = network(index.astype(np.uint64))
    while len(far := np.nonzero(out >= np.uint64(n))[0]):
        out[far] = network(out[far])
    return out.astype(np.int64)


def cut_sequences(df: DataFrame, length: int, end_id: int, ids: str = "ids", id_col: str = "doc_id") -> DataFrame:
    """``doc_id, seq_no, n_tokens, tokens``: every document's ids (little-endian 32-bit) and one
    ``end_id``, cut into runs of ``length``; tokens as little-endian unsigned 16-bit integers (32-bit
    where an id needs it for the whole column: never mixed, ids above 65,535 raise).

    Documents without ids (null or empty) give no sequence; a null id stays null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, no, size, data = [], [], [], []
            for key, value in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
                tokens = np.frombuffer(value or b"", dtype="<u4")
                if not len(tokens):
                    continue
                if tokens.max() > 0xFFFF:
                    raise ValueError("token ids over 65,535 don't fit the 16-bit stride")
                tokens = np.append(tokens, end_id).astype("<u2")
                for at in range(0, len(tokens), length):
                    part = tokens[at : at + length]
                    doc.append(key)
                    no.append(at // length)
                    size.append(len(part))
                    data.append(part.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(no, pa.int64()), pa.array(size, pa.int64()), pa.array(data, pa.binary())],
                names=["doc_id", "seq_no", "n_tokens", "tokens"],
            )

    named = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids).alias("ids"))
    return map_batches(named, run, "doc_id long, seq_no long, n_tokens long, tokens binary")


@dataclass(frozen=True)
class Shards:
    """Where the shards are, how many sequences they hold and how they are laid out."""

    path: str
    sequences: int
    shard_rows: int
    stride: int  # bytes of a row's tokens
    key: int

    def read(self, spark: SparkSession, first: int = 0, count: int | None = None) -> DataFrame:
        """Slots first, first + 1, ... of the training order: only the shards that hold them are read."""
        to = self.sequences if count is None else min(self.sequences, first + count)
        rows = spark.read.schema("doc_id long, seq_no long, n_tokens long, slot long, tokens binary, shard long").parquet(self.path)
        return rows.where(
            F.col("shard").between(first // self.shard_rows, max(0, to - 1) // self.shard_rows)
            & (F.col("slot") >= first) & (F.col("slot") < to)
        )


def write_training_order(
    sequences: DataFrame, key: int, length: int, pad_id: int, shard_rows: int = 8192, path: str | None = None
) -> Shards:
    """Write ``doc_id, seq_no, n_tokens, tokens`` (16-bit) rows in keyed random order as shards.

    Shard k is the folder ``shard=k`` with one file of ``shard_rows`` rows (the last may be shorter)
    in slot order; tokens are padded with ``pad_id`` to ``length``. Repeated rows are sequences of their own. No rows: an empty order.
    """
    spark = sequences.sparkSession
    path = path or run_dir(spark, "training_order")
    table = stored(sequences, "training_sequences", parts=MAX_FILES, compression="zstd", maxRecordsPerFile="0")
    counts = table.groupBy(F.col("_metadata.file_path").alias("file")).count().collect()
    n, start = 0, []
    for r in sorted(counts, key=lambda r: r["file"]):
        start.append((r["file"], n))
        n += r["count"]
    shards = Shards(path, n, shard_rows, 2 * length, key)
    if not n:
        table.select("doc_id", "seq_no", "n_tokens", F.lit(0).cast("long").alias("slot"), "tokens", F.lit(0).cast("long").alias("shard")) \
            .write.partitionBy("shard").parquet(path)
        return shards
    first = spark.createDataFrame(start, "file string, first long")
    place = vector_function(spark, lambda i: permuted(i, n, key), "long")
    pad = F.lit(np.uint16(pad_id).astype("<u2").tobytes())
    slots = (
        table.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
        .join(F.broadcast(first), "file")  # a row per file: MAX_FILES at most
        .withColumn("slot", place(F.col("first") + F.col("row")))
        .withColumn("shard", F.floor(F.col("slot") / shard_rows))
        .select("doc_id", "seq_no", "n_tokens", "slot", "tokens", "shard")
    )
    dealt = slots.repartitionByRange(min(MAX_TASKS, math.ceil(n / shard_rows)), "shard").sortWithinPartitions("shard", "slot")
    dealt.withColumn("tokens", F.rpad("tokens", F.lit(2 * length), pad)).write.partitionBy("shard").option("compression", "zstd").parquet(path)
    return shards
