"""Table sinks on a shared file system (K2-K5): keyed idempotent append, replace,
two-table publication with a single commit, and row counts observed during the write.

Tables are folders of Parquet files under a path the caller gives (on a cluster: a folder
of the shared ``spark.checkpoint.dir`` or a warehouse location). Every write goes through
Spark's job committer, so a lost executor or a retried task never leaves partial output.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from ..session import materialize
from . import key_index as index
from .tables import read_table, table_exists
from .versions import latest_version, publish_together, read_published

__all__ = [
    "append_new", "latest_version", "not_stored", "one_per_key", "publish_together", "read_published", "read_table", "replace_table",
    "save_bucketed", "table_exists", "write_counted",
]

# Partition values of a batch that are brought to the driver to prune the target's scan.
PRUNE_VALUES = 1_000


def one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key (null parts match): the greatest by the other columns in order, so that a
    retried task chooses alike. Partially aggregated: a hot key costs one row per partition."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in rest])
    # maps have no order of their own: their sorted entries do
    order = [F.array_sort(F.map_entries(F.col(f"`{c}`"))) if isinstance(df.schema[c].dataType, MapType) else F.col(f"`{c}`") for c in rest]
    plain = not any(isinstance(df.schema[c].dataType, MapType) for c in rest)
    chosen = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg((F.max(row) if plain else F.max_by(row, F.struct(*order))).alias("__row"))
    return chosen.select(*[F.col(f"`{c}`") if c in keys else F.col(f"__row.`{c}`") for c in df.columns])


def not_stored(batch: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of a (materialized) batch whose key ``stored`` lacks; null key parts match null.

    ``stored`` is cut down to the batch's keys first: the batch has its size from files, so a small
    one is broadcast and the stored keys are scanned without a shuffle. What is left of them is kept, and has
    its size from files too: unless these are many, they are broadcast and a large batch isn't shuffled."""

    def matches(left: DataFrame, right: DataFrame) -> list[Column]:
        return [left[k].eqNullSafe(right[f"__{k}"]) for k in keys]

    wanted = batch.select(*[F.col(k).alias(f"__{k}") for k in keys])
    old = stored.select(*keys)
    old = old.join(wanted, on=matches(old, wanted), how="left_semi").distinct()
    old = materialize(old.select(*[F.col(k).alias(f"__{k}") for k in keys]), "stored_keys")
    return batch.join(old, on=matches(batch, old), how="left_anti")


def _pruned(stored: DataFrame, batch: DataFrame, partition_col: str) -> DataFrame:
    """``stored`` without partitions that the batch does not touch, as a static filter on the
    partition column (null included); all of it for a batch that touches very many."""
    values = [r[0] for r in batch.select(partition_col).distinct().limit(PRUNE_VALUES + 1).collect()]
    if len(values) > PRUNE_VALUES:
        return stored
    hit = F.col(partition_col).isin([v for v in values if v is not None])
    return stored.where(hit | F.col(partition_col).isNull() if None in values else hit)


def append_new(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    fmt: str = "parquet",
    partition_col: str | None = None,
    metrics: Mapping[str, Column] | None = None,
    key_index: bool = False,
) -> dict[str, object]:
    """K2 (+K5): append the rows whose key is not in the table yet (one row per key per
    batch, chosen by ``one_per_key``); returns ``{"rows": rows appended, **metrics}``, the metrics over
    the whole batch.

    A rerun of the same batch — e.g. after a failure between the data write and the mark
    update, or after a first write that died — adds nothing twice. Key parts, and partition
    values, compare null-safely. The batch is computed once and kept in the working folder;
    with ``partition_col`` the table is partitioned by it and only the partitions that the
    batch touches are read. ``partition_col`` must follow from the key: a key then always
    lands in one partition.

    With ``key_index`` the table is not partitioned: it has a side table of key ranges per file
    (``key_index``), and only files that may hold the batch's keys are opened; the result also has ``files_read``
    and ``files`` (before the append). A table that was written without it is entered by its first such append.
    """
    if key_index and partition_col is not None:
        raise ValueError("a table has a key index or a partition column")
    spark, keys = df.sparkSession, list(keys)
    batch = materialize(one_per_key(df, keys), "append_batch")
    out: dict[str, object] = {}
    if metrics:
        out = batch.agg(*[c.alias(n) for n, c in metrics.items()]).first().asDict()
    if key_index:
        existing, out["files_read"], out["files"] = index.may_hold(batch, path, keys, fmt)
        known = out["files_read"] > 0
    else:
        known = table_exists(spark, path)
        existing = read_table(spark, path, batch.schema, fmt) if known else None
        if known and partition_col is not None:
            existing = _pruned(existing, batch, partition_col)
    obs = Observation(f"append_{uuid.uuid4().hex[:12]}")
    new = not_stored(batch, existing, keys) if known else batch
    if partition_col is not None:
        new = new.hint("rebalance", F.col(partition_col))  # few files per partition; adaptive execution splits large ones
    elif key_index:
        new = index.clustered(new, keys)
    # counted last: what is sampled or found to be empty below would count wrongly
    writer = new.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("append").format(fmt)
    if partition_col is not None:
        writer = writer.partitionBy(partition_col)
    writer.save(path)
    if key_index:
        index.enter_files(spark, path, batch.schema, keys, fmt)
    return out | {"rows": dict(obs.get)["rows"]}


def save_bucketed(
    df: DataFrame, table: str, path: str, key: str, buckets: int, partition_by: str | None = None
) -> DataFrame:
    """Store a table bucketed (and sorted) by ``key`` at ``path`` and register it. A bucket is written by one
    task, a large one by several (adaptive rebalancing), so a table has few files.

    Tables bucketed the same way on the join key are joined without any shuffle of either
    side (the buckets line up), which removes the dominant cost of the repeated unit-key
    joins (establishments, units, accounts) when the same tables are queried many times.
    The bucket count should be fixed per deployment (≈ total size / 256 MB) and shared by
    every table joined on the key. Returns the registered table."""
    dealt = df.withColumn("__bucket", F.pmod(F.hash(F.col(f"`{key}`")), F.lit(buckets))).hint("rebalance", F.col("__bucket")).drop("__bucket")
    writer = dealt.write.mode("overwrite").format("parquet").option("path", path)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return df.sparkSession.table(table)


def replace_table(df: DataFrame, root: str) -> str:
    """K3: replace a table's content: a new version is written, then committed in place of the old one; until then, and
    after a failure, readers (``read_published(spark, root, "data")``) see the old content, which ``versions.expire``
    deletes in the end."""
    return publish_together({"data": df}, root, replace=True).version


def write_counted(df: DataFrame, write: Callable[[DataFrame], None], name: str = "rows_written") -> int:
    """K5: run a plain ``write`` and return how many rows it wrote, counted while writing
    (an observed metric) instead of re-running the input with a second ``count()``.
    ``append_new`` reports its own count."""
    obs = Observation(f"{name}_{uuid.uuid4().hex[:12]}")  # names must not repeat within a plan
    write(df.observe(obs, F.count(F.lit(1)).alias("n")))
    return int(obs.get["n"])
