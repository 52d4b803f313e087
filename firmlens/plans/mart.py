"""The dashboard mart (X8) kept fresh: rebuilt where its inputs changed, and only there.

The mart's rows lie in ``root/rows/part=<run>/<place>=...``: a run writes the places that it recomputes into a part of
its own. Which part holds which place (``covers``), the inputs' files, and a hash of every input row by its key are
published together as one version at the end (``sources.versions``), so readers see the mart before or after a run, and a
run that dies changes nothing.

A run looks at the inputs' files first: same names, sizes and times, nothing to do. Otherwise it compares the rows' hashes
with those of the last run. Establishments that came, went or changed touch their place; units and labels that did touch the
places of their establishments. Only touched places are joined and written.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..session import materialize
from ..sources.tables import delete_folder, file_status, read_table, sub_folders
from ..sources.versions import KEPT, expire, live_parts, publish_together, read_part, read_published, stage
from .dashboard import C, Cols, dashboard_mart

PARTS = 16  # parts of the mart, one per run, before it is written anew as one
_COVERS = "place string, part string"
_FILES = "input string, state string"
_ROWS = "kind string, k1 string, k2 string, place string, n long, hash long"


@dataclass(frozen=True)
class Refresh:
    """What a run did: ``built`` whole, ``updated`` in places, or found ``unchanged``."""

    kind: str
    places: int = 0


FEW_FILES = 256  # so many are asked for by the driver itself, more by a job


def files_state(*inputs: DataFrame) -> str:
    """A digest of the names, sizes and times of the files that frames read."""
    files = sorted({f for df in inputs for f in df.inputFiles()})
    spark = inputs[0].sparkSession
    if len(files) <= FEW_FILES:
        return hashlib.sha256(repr([(f, *file_status(spark, f)) for f in files]).encode()).hexdigest()
    status = spark.read.format("binaryFile").load([unquote(f) for f in files]).select("path", "length", F.col("modificationTime").cast("string"))
    one = status.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("path", "length", "modificationTime")).alias("h")).first()
    return f"{one['n']}-{one['h']}"


def _hashes(etab: DataFrame, ul: DataFrame, naf: DataFrame, cols: Cols) -> DataFrame:
    """One row per row of each input: its key, a count of 1 and its hash. Nothing is gathered by key here: ``_touched``
    does that once, for both sides."""

    def rows(df: DataFrame, kind: str, k1: str, k2: Column, place: Column, using: list[str]) -> DataFrame:
        hashed = F.xxhash64(*[F.struct(F.col(f"`{c}`").isNull(), F.col(f"`{c}`")) for c in using])
        return df.select(F.col(k1).cast("string").alias("k1"), k2.alias("k2"), place.alias("place"), F.lit(1).cast("long").alias("n"), hashed.alias("hash")).select(
            F.lit(kind).alias("kind"), "k1", "k2", "place", "n", "hash"
        )

    none = F.lit(None).cast("string")
    unit_cols = [cols.siren, cols.sector, cols.name, cols.category, cols.category_year]
    return (
        rows(etab, "establishment", cols.siret, F.col(cols.siren).cast("string"), F.col(cols.place).cast("string"), etab.columns)
        .unionByName(rows(ul, "unit", cols.siren, none, none, unit_cols))
        .unionByName(rows(naf, "label", cols.code, none, none, [cols.code, cols.label]))
    )


def _touched(old: DataFrame, new: DataFrame, etab: DataFrame, ul: DataFrame, cols: Cols) -> DataFrame:
    """``(place)``: the places whose rows may differ: those of a key that has more or fewer rows than it had, or rows
    with another hash over them, whatever their order."""
    both = old.withColumn("n", -F.col("n")).unionByName(new)
    changed = both.groupBy("kind", "k1", "k2", "place").agg(F.sum("n").alias("n"), F.bit_xor("hash").alias("hash")).where("n <> 0 OR hash <> 0")
    changed = materialize(changed.select("kind", "k1", "place").distinct(), "mart_changed")
    codes = changed.where("kind = 'label'").select(F.col("k1").alias("__code")).distinct()
    relabelled = ul.join(codes, ul[cols.sector].cast("string").eqNullSafe(codes["__code"]), "left_semi").select(F.col(cols.siren).cast("string").alias("__unit"))
    units = changed.where("kind = 'unit'").select(F.col("k1").alias("__unit")).unionByName(relabelled).distinct()
    theirs = etab.join(units, etab[cols.siren].cast("string") == units["__unit"], "left_semi").select(F.col(cols.place).cast("string").alias("place"))
    return changed.where("kind = 'establishment'").select("place").unionByName(theirs).distinct()


def refresh_mart(
    etab: DataFrame, ul: DataFrame, naf: DataFrame, root: str, cols: Cols = C, parts: int = PARTS, keep: dt.timedelta = KEPT
) -> Refresh:
    """Bring the stored mart under ``root`` up to the inputs: built whole the first time, when its files are gone, and
    every ``parts`` runs; else rewritten in the places touched. Several rows of a key, null keys and null places count as
    any other. One run at a time per ``root``. Versions that were replaced, and parts that only these name, stay for ``keep``
    and go when the mart is built whole."""
    spark = etab.sparkSession
    state = files_state(etab, ul, naf)
    covers = read_published(spark, root, "covers", schema=StructType([StructField("place", StringType()), StructField("part", StringType())]))
    known = [p for p in live_parts(spark, root) if p.name == "covers"]
    there = {f.removeprefix("part=") for f in sub_folders(spark, f"{root}/rows")}
    used = {r[0] for r in covers.select("part").distinct().collect()} if known else set()  # one per run, ``parts`` at most
    whole = not known or not used <= there or len(used) >= parts
    if not whole and read_published(spark, root, "files").first()["state"] == state:
        return Refresh("unchanged")
    hashes = stage(_hashes(etab, ul, naf, cols), root, "hashes")  # before the rows: what changes meanwhile is found by the next run
    part = uuid.uuid4().hex
    mine = etab
    if not whole:
        new = read_part(spark, root, hashes, StructType.fromDDL(_ROWS))
        touched = materialize(_touched(read_published(spark, root, "hashes"), new, etab, ul, cols), "mart_touched")
        mine = etab.join(touched, etab[cols.place].cast("string").eqNullSafe(touched["place"]), "left_semi")
    mart = dashboard_mart(mine, ul, naf, cols, dealt_by=cols.place)
    path = f"{root}/rows/part={part}"
    mart.write.partitionBy(cols.place).parquet(path)
    now = _read_part(spark, path, mart.schema).select(F.col(cols.place).cast("string").alias("place")).distinct().withColumn("part", F.lit(part))
    if not whole:
        now = covers.join(touched.select(F.col("place").alias("__p")), F.col("place").eqNullSafe(F.col("__p")), "left_anti").unionByName(now)
    files = spark.createDataFrame([("all", state)], _FILES)
    publish_together({"covers": now.coalesce(1), "files": files}, root, replace=True, staged=[hashes])
    if whole:
        _expire(spark, root, keep)
        return Refresh("built")
    return Refresh("updated", touched.count())


def _expire(spark: SparkSession, root: str, keep: dt.timedelta) -> None:
    """Delete replaced versions and the parts that no version left refers to."""
    expire(spark, root, keep)
    named = {
        r[0] for f in sub_folders(spark, f"{root}/covers") for r in read_table(spark, f"{root}/covers/{f}", _COVERS).select("part").distinct().collect()
    }
    for folder in sub_folders(spark, f"{root}/rows"):
        if folder.removeprefix("part=") not in named:
            delete_folder(spark, f"{root}/rows/{folder}")


def _read_part(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path).select(*[F.col(f"`{c}`") for c in schema.fieldNames()])


def read_fresh_mart(spark: SparkSession, root: str, schema: StructType, cols: Cols = C) -> DataFrame:
    """The mart as of the last run. A scope of one place reads that place's files."""
    covers = read_published(spark, root, "covers")
    used = [r[0] for r in covers.select("part").distinct().collect()]
    if len(used) <= 1:
        return _read_part(spark, f"{root}/rows/part={used[0]}", schema) if used else spark.createDataFrame([], schema)
    full = StructType([*schema.fields, StructField("part", StringType())])
    rows = spark.read.schema(full).option("basePath", f"{root}/rows").parquet(*[f"{root}/rows/part={p}" for p in used])
    held = covers.select(F.col("place").alias("__place"), F.col("part").alias("__part"))
    mine = rows[cols.place].cast("string").eqNullSafe(held["__place"]) & (rows["part"] == held["__part"])
    return rows.join(held, mine, "left_semi").select(*[F.col(f"`{c}`") for c in schema.fieldNames()])
