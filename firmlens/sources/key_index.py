"""A side table of key ranges per file of a flat table, so that a keyed append opens only the files that may
hold its keys.

``<table>/_keys/ranges`` has, for each file and each of 65,536 slots of the key's hash that the file has keys in, the
lowest and highest hash. A small file has mostly one key per slot, so its ranges are its keys; a large table's files
are cut by hash, so each covers few slots. ``<table>/_keys/files`` names the files whose ranges are there: a file that
a run wrote before it died isn't among them, is opened by every append, and is entered by the next.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .tables import read_table, table_exists

HASH = "__hash"
SLOT_SHIFT = 48
_RANGES = "file string, slot int, low long, high long"
_FILES = "file string"


def key_hash(keys: Sequence[str]) -> Column:
    """Equal keys (null parts included) have equal hashes."""
    return F.xxhash64(*[F.col(f"`{k}`") for k in keys])


def slot_of(hashed: Column) -> Column:
    return F.shiftright(hashed, SLOT_SHIFT).cast("int")


def clustered(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows in ranges of the key's hash: as many tasks as the data need (adaptive execution joins small ones)."""
    return df.withColumn(HASH, key_hash(keys)).repartitionByRange(F.col(HASH)).sortWithinPartitions(HASH).drop(HASH)


def _files(spark: SparkSession, path: str, schema: StructType, fmt: str) -> dict[str, str]:
    """Names and paths of the table's files (Spark's own listing)."""
    if not table_exists(spark, path):
        return {}
    return {f.rpartition("/")[2]: f for f in read_table(spark, path, schema, fmt).inputFiles()}


def may_hold(batch: DataFrame, path: str, keys: Sequence[str], fmt: str = "parquet") -> tuple[DataFrame, int, int]:
    """The part of the table in files that may hold a key of the batch, how many files these are, and of how many."""
    spark, schema = batch.sparkSession, batch.schema
    files = _files(spark, path, schema, fmt)
    if not files:
        return spark.createDataFrame([], schema), 0, 0
    probes = batch.select(key_hash(keys).alias(HASH)).distinct().withColumn("slot", slot_of(F.col(HASH)))
    ranges = read_table(spark, f"{path}/_keys/ranges", _RANGES)
    hit = ranges.join(probes, "slot").where(F.col(HASH).between(F.col("low"), F.col("high"))).select("file").distinct()
    entered = read_table(spark, f"{path}/_keys/files", _FILES).select("file").distinct()
    # file names only, and no more of them than Spark lists to read the table at all
    state = entered.select("file", F.lit(0).alias("hit")).unionByName(hit.select("file", F.lit(1).alias("hit")))
    state = {r["file"]: r["hit"] for r in state.groupBy("file").agg(F.max("hit").alias("hit")).collect()}
    wanted = [f for name, f in files.items() if state.get(name, 1)]
    if not wanted:
        return spark.createDataFrame([], schema), 0, len(files)
    reader = spark.read.schema(schema).format(fmt).option("basePath", path)
    return reader.load(wanted), len(wanted), len(files)


def enter_files(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], fmt: str = "parquet") -> int:
    """Enter the ranges of all files that aren't in the side table yet; how many these were."""
    files = _files(spark, path, schema, fmt)
    known = {r["file"] for r in read_table(spark, f"{path}/_keys/files", _FILES).distinct().collect()}
    new = {name: f for name, f in files.items() if name not in known}
    if new:
        rows = spark.read.schema(schema).format(fmt).option("basePath", path).load(list(new.values()))
        rows = rows.select(F.col("_metadata.file_name").alias("file"), key_hash(keys).alias(HASH))
        ranges = rows.groupBy("file", slot_of(F.col(HASH)).alias("slot")).agg(F.min(HASH).alias("low"), F.max(HASH).alias("high"))
        ranges.hint("rebalance").sortWithinPartitions("slot").write.mode("append").parquet(f"{path}/_keys/ranges")
        spark.createDataFrame([(name,) for name in new], _FILES).coalesce(1).write.mode("append").parquet(f"{path}/_keys/files")
    return len(new)
