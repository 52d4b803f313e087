"""Versioned tables (K3, K4): several tables written as one version and committed together, stored in buckets of
their keys, compacted and expired.

``root/<name>/version=<v>`` holds the rows that version ``v`` adds to a table, ``root/_commits/version=<v>`` what the
commit does: the tables it adds to, and the versions it takes the place of. A commit is one small file, written last;
readers go by the commits alone, so they see all of a version or nothing, and what they see doesn't change under them
until ``expire`` deletes versions that were replaced long ago.

A table that is laid out by a key (``lay_out``) keeps each version in a fixed number of buckets of the key's hash. A
reader that looks for the keys of a batch then opens only their buckets. Versions pile up, one per run; ``compact``
merges them into one.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from .tables import delete_folder, read_table, sub_folders, table_exists

BUCKET = "bucket"
KEPT = dt.timedelta(days=7)  # how long replaced versions stay for readers that began before

_LAYOUT = "name string, key array<string>, buckets int"
_ADDED = "array<struct<version: string, name: string, buckets: int>>"
# ``state``: everything live as of this commit, so that readers need no earlier ones
_BODY = f"adds {_ADDED}, removes array<struct<version: string, name: string>>, state {_ADDED}"
_COMMIT = f"{_BODY}, version string"


@dataclass(frozen=True)
class Part:
    """The rows that one version adds to one table; without ``buckets``, in plain files."""

    version: str
    name: str
    buckets: int | None = None


@dataclass(frozen=True)
class Published:
    version: str
    rows: dict[str, int] = field(default_factory=dict)


def bucket_of(key: Sequence[str], buckets: int) -> Column:
    """The bucket of a row's key (null parts count as any other value)."""
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in key]), F.lit(buckets)).cast("int")


def lay_out(spark: SparkSession, root: str, keys: Mapping[str, Sequence[str]], buckets: int) -> None:
    """Store the named tables by key from now on: once per table, before it is first written. Aim at buckets of
    some 256 MB of the table in the end; an increment writes a file per bucket that it touches."""
    known = _layout(spark, root)
    for name, key in keys.items():
        if name in known and known[name][0] != list(key):
            raise ValueError(f"{name} is laid out by {known[name][0]}")
    new = [(name, list(key), buckets) for name, key in keys.items() if name not in known]
    if new:
        spark.createDataFrame(new, _LAYOUT).coalesce(1).write.mode("append").parquet(f"{root}/_layout")


def _layout(spark: SparkSession, root: str) -> dict[str, tuple[list[str], int]]:
    rows = read_table(spark, f"{root}/_layout", _LAYOUT).collect()  # one row per table
    return {r["name"]: (list(r["key"]), r["buckets"]) for r in rows}


def _new_version() -> str:
    return f"v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def _age(version: str) -> dt.timedelta:
    """Time since a version was begun (names that give no time count as new)."""
    digits = version[1:].partition("-")[0]
    return dt.timedelta(microseconds=(time.time_ns() - int(digits)) / 1000) if digits.isdigit() else dt.timedelta(0)


def _write(df: DataFrame, path: str, layout: tuple[list[str], int] | None) -> int:
    """Writes one part; its number of rows, counted on the way."""
    obs = Observation(f"publish_{uuid.uuid4().hex[:12]}")
    if layout is not None:
        key, buckets = layout
        # a bucket is written by one task, a large one by several (adaptive rebalancing), in the order of the key
        df = df.withColumn(BUCKET, bucket_of(key, buckets)).hint("rebalance", F.col(BUCKET))
        df = df.sortWithinPartitions(BUCKET, *[F.col(f"`{k}`") for k in key])
    writer = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists")
    (writer if layout is None else writer.partitionBy(BUCKET)).parquet(path)
    return int(obs.get["rows"])


def _commit(spark: SparkSession, root: str, version: str, adds: Sequence[Part], removes: Sequence[Part] = (), state: Sequence[Part] | None = None) -> None:
    row = (
        [(p.version, p.name, p.buckets) for p in adds], [(p.version, p.name) for p in removes],
        None if state is None else [(p.version, p.name, p.buckets) for p in state],
    )
    spark.createDataFrame([row], _BODY).coalesce(1).write.mode("errorifexists").parquet(f"{root}/_commits/version={version}")


def _commits(spark: SparkSession, root: str) -> list:
    """The commits from the last recorded state on, in order: few, as ``maintain`` records one."""
    rows = sorted(read_table(spark, f"{root}/_commits", _COMMIT).collect(), key=lambda r: r["version"])
    whole = [at for at, r in enumerate(rows) if r["state"] is not None]
    return rows[whole[-1] :] if whole else rows


def live_parts(spark: SparkSession, root: str) -> list[Part]:
    """What readers see, in the order of the commits. A commit that would replace a part which an
    earlier one has replaced already (two compactions at once) counts for nothing."""
    live: dict[tuple[str, str], Part] = {}
    for r in _commits(spark, root):
        if r["state"] is not None:
            live = {(p["version"], p["name"]): Part(*p) for p in r["state"]}
            continue
        gone = [(p["version"], p["name"]) for p in r["removes"]]
        if all(g in live for g in gone):
            live = {k: p for k, p in live.items() if k not in gone}
            live |= {(p["version"], p["name"]): Part(*p) for p in r["adds"]}
    return list(live.values())


def stage(df: DataFrame, root: str, name: str) -> Part:
    """Write a version of a table for a later commit (``publish_together``): computed once, before what follows from it,
    and not copied. Until then no reader sees it."""
    layout, version = _layout(df.sparkSession, root).get(name), _new_version()
    _write(df, f"{root}/{name}/version={version}", layout)
    return Part(version, name, layout[1] if layout else None)


def read_part(spark: SparkSession, root: str, part: Part, schema: StructType) -> DataFrame:
    """The rows of one part, committed or not."""
    return _read(spark, root, part.name, [part], schema, None)


def publish_together(
    frames: Mapping[str, DataFrame], root: str, columns: Mapping[str, Sequence[str]] | None = None, replace: bool = False,
    staged: Sequence[Part] = (),
) -> Published:
    """K4: write several tables (with an explicit column order, if given) as one version and commit them together.
    Readers see all new tables or none. With ``replace`` the version takes the place of all earlier ones of these
    tables. ``staged`` parts are committed with them. Returns the version and the rows written to each table."""
    spark = next(iter(frames.values())).sparkSession
    layout, version = _layout(spark, root), _new_version()
    before = [p for p in live_parts(spark, root) if p.name in {*frames, *(s.name for s in staged)}] if replace else []
    rows, adds = {}, [*staged]
    for name, df in frames.items():
        cols = (columns or {}).get(name)
        rows[name] = _write(df.select(*cols) if cols else df, f"{root}/{name}/version={version}", layout.get(name))
        adds.append(Part(version, name, layout[name][1] if name in layout else None))
    _commit(spark, root, version, adds, before)
    return Published(version, rows)


def latest_version(spark: SparkSession, root: str) -> str | None:
    """The last committed version."""
    return max((p.version for p in live_parts(spark, root)), default=None)


def read_published(
    spark: SparkSession, root: str, name: str, all_versions: bool = False, schema: StructType | None = None,
    touching: DataFrame | None = None,
) -> DataFrame:
    """The table as of its latest committed version; with ``all_versions`` the union of every live one (append
    semantics: each version holds one batch). Uncommitted versions — a run that died before its commit — are never
    read. With ``schema``, nothing committed yet is a table without rows.

    ``touching``, a batch with the table's key columns, cuts the read down to the buckets that its keys fall in: all
    rows of these keys are found, other rows may be among them."""
    parts = [p for p in live_parts(spark, root) if p.name == name]
    if not parts:
        if schema is None:
            raise FileNotFoundError(f"nothing committed of {name} under {root}")
        return spark.createDataFrame([], schema)
    parts = parts if all_versions else parts[-1:]
    return _read(spark, root, name, parts, schema, touching)


def _read(spark: SparkSession, root: str, name: str, parts: Sequence[Part], schema: StructType | None, touching: DataFrame | None) -> DataFrame:
    key = _layout(spark, root)[name][0] if touching is not None and name in _layout(spark, root) else None
    read = []
    for buckets in sorted({p.buckets or 0 for p in parts}):
        paths = [f"{root}/{name}/version={p.version}" for p in parts if (p.buckets or 0) == buckets]
        full = None if schema is None else StructType([*schema.fields]).add("version", "string")
        if full is not None and buckets:
            full = full.add(BUCKET, IntegerType())
        reader = spark.read.option("basePath", f"{root}/{name}")
        df = (reader if full is None else reader.schema(full)).parquet(*paths)
        if buckets and key is not None:
            held = [r[0] for r in touching.select(bucket_of(key, buckets).alias(BUCKET)).distinct().collect()]  # at most ``buckets``
            if len(held) < buckets:
                df = df.where(F.col(BUCKET).isin(held))
        read.append(df.drop("version", BUCKET) if buckets else df.drop("version"))
    return reduce(DataFrame.unionByName, read)


def compact(spark: SparkSession, root: str, name: str, buckets: int | None = None) -> str | None:
    """Merge all live versions of a table into one, in the buckets of its layout (or as many as given); nothing to do for
    one version. Rows that are appended meanwhile stay as they are. Readers see the same rows before and after."""
    parts = [p for p in live_parts(spark, root) if p.name == name]
    layout = _layout(spark, root).get(name)
    if layout is not None and buckets is not None:
        layout = (layout[0], buckets)
    target = layout[1] if layout else None
    if len(parts) < 2 and all(p.buckets == target for p in parts):
        return None
    version = _new_version()
    _write(_read(spark, root, name, parts, None, None), f"{root}/{name}/version={version}", layout)
    _commit(spark, root, version, [Part(version, name, target)], parts)
    return version


def expire(spark: SparkSession, root: str, keep: dt.timedelta = KEPT) -> list[str]:
    """Delete versions that no reader needs: replaced, or left by runs that died, and older than ``keep``; then the
    commits that the last recorded state covers. Returns the folders deleted."""
    live = live_parts(spark, root)
    _commit(spark, root, _new_version(), [], state=live)
    commits, needed, gone = _commits(spark, root), {(p.version, p.name) for p in live}, []
    replaced = {(p["version"], p["name"]): r["version"] for r in read_table(spark, f"{root}/_commits", _COMMIT).collect() for p in r["removes"]}
    for name in sub_folders(spark, root):
        if name.startswith("_commits") or name == "_layout":
            continue
        for folder in sub_folders(spark, f"{root}/{name}"):
            version = folder.removeprefix("version=")
            since = replaced.get((version, name), version)  # when it was replaced; of a run that died, when it began
            if (version, name) not in needed and _age(since) > keep:
                gone.append(f"{root}/{name}/{folder}")
    first = commits[0]["version"]
    gone += [f"{root}/_commits/{f}" for f in sub_folders(spark, f"{root}/_commits") if (v := f.removeprefix("version=")) < first and _age(v) > keep]
    for path in gone:
        delete_folder(spark, path)
    return gone


def maintain(spark: SparkSession, root: str, most: int, keep: dt.timedelta = KEPT) -> list[str]:
    """Compact the tables that have more than ``most`` live versions, then expire. Returns the tables compacted."""
    count: dict[str, int] = {}
    for p in live_parts(spark, root):
        count[p.name] = count.get(p.name, 0) + 1
    due = [name for name, n in count.items() if n > most]
    for name in due:
        compact(spark, root, name)
    if due:
        expire(spark, root, keep)
    return due


__all__ = [
    "Part", "Published", "bucket_of", "compact", "expire", "lay_out", "latest_version", "live_parts", "maintain", "publish_together",
    "read_part", "read_published", "stage", "table_exists",
]
