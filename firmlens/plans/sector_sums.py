"""Revenue by sector and year (A5) kept up by increments: partial sums that merge, corrected when a unit changes sector.

Stored under one root as versioned tables (``sources.versions``): what each unit's accounts sum up to per year and
increment (``unit_year``), the sector each unit was given in each increment (``unit_sector``), both in buckets of the unit,
and what each increment adds to a sector's year (``sector_year``). An increment reads the buckets of its own units, never the
accounts that came before, and publishes all tables with its name at once: a rerun of an increment changes nothing.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import money, year_of
from ..session import materialize
from ..sources.versions import lay_out, maintain, publish_together, read_published
from .dashboard import C, Cols

BUCKETS = 16  # of the tables by unit; for many units, their size / 256 MB
COMPACT_AFTER = 32  # increments
_UNIT_YEAR = "siren string, annee int, n long, total decimal(38,2)"
_UNIT_SECTOR = "siren string, sector string, run long"
_SECTOR_YEAR = "sector string, annee int, n long, total decimal(38,2)"


def _table(spark: SparkSession, root: str, name: str, ddl: str, touching: DataFrame | None = None) -> DataFrame:
    schema = spark.createDataFrame([], ddl).schema
    return read_published(spark, root, name, all_versions=True, schema=schema, touching=touching)


def _latest(sectors: DataFrame) -> DataFrame:
    """The sector of each unit as of the last increment that gave one."""
    return sectors.groupBy("siren").agg(F.max(F.struct("run", "sector")).alias("l")).select("siren", F.col("l.sector").alias("sector"))


def add_increment(
    root: str, batch: str, accounts: DataFrame, units: DataFrame, cols: Cols = C, buckets: int = BUCKETS, compact_after: int = COMPACT_AFTER
) -> bool:
    """Add an increment named ``batch``: accounts that are new, and units that are new or may have changed sector; either
    may be empty. False if a batch of that name is in already.

    A unit has one sector, the one given last; of several given at once, the greatest. Without a sector, or with none known
    yet, its accounts wait and count once it has one. Accounts without a unit or a closing year are left out; amounts
    that are null count as 0.
    """
    spark = accounts.sparkSession
    if _table(spark, root, "_batches", "batch string").where(F.col("batch") == batch).count():
        return False
    lay_out(spark, root, {"unit_year": ["siren"], "unit_sector": ["siren"]}, buckets)
    dated = accounts.select(F.col(cols.siren).cast("string").alias("siren"), year_of(cols.closing).cast("int").alias("annee"), money(cols.revenue).alias("v"))
    sums = dated.where("siren IS NOT NULL AND annee IS NOT NULL").groupBy("siren", "annee").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("v"), F.lit(0)).cast("decimal(38,2)").alias("total")
    )
    sums = materialize(sums, "sector_sums")
    given = units.select(F.col(cols.siren).cast("string").alias("siren"), F.col(cols.sector).cast("string").alias("sector")).where("siren IS NOT NULL")
    given = given.groupBy("siren").agg(F.max("sector").alias("sector"))
    given = materialize(given, "sector_units")

    known = _latest(_table(spark, root, "unit_sector", _UNIT_SECTOR, given)).withColumnRenamed("sector", "old")
    changed = given.join(known, "siren", "left").where(~F.col("sector").eqNullSafe(F.col("old")))
    changed = materialize(changed, "sector_changed")
    # accounts of before go from the old sector to the new one
    before = _table(spark, root, "unit_year", _UNIT_YEAR, changed).join(changed, "siren")
    moved = before.select(F.col("old").alias("sector"), "annee", (-F.col("n")).alias("n"), (-F.col("total")).cast("decimal(38,2)").alias("total"))
    moved = moved.unionByName(before.select("sector", "annee", "n", "total"))
    # accounts of this increment go to the sector as of now
    now = _latest(_table(spark, root, "unit_sector", _UNIT_SECTOR, sums)).join(changed, "siren", "left_anti").unionByName(changed.select("siren", "sector"))
    added = moved.unionByName(sums.join(now, "siren").select("sector", "annee", "n", "total"))
    delta = added.where("sector IS NOT NULL").groupBy("sector", "annee").agg(F.sum("n").alias("n"), F.sum("total").cast("decimal(38,2)").alias("total"))
    run = time.time_ns()
    publish_together({
        "unit_year": sums, "unit_sector": changed.select("siren", "sector", F.lit(run).cast("long").alias("run")),
        "sector_year": delta.where("n <> 0 OR total <> 0"), "_batches": spark.createDataFrame([(batch,)], "batch string"),
    }, root)
    maintain(spark, root, compact_after)
    return True


def sector_sums(spark: SparkSession, root: str, cols: Cols = C) -> DataFrame:
    """Revenue per sector and year over all increments: the rows of ``dashboard.sector_year_revenue`` over all accounts and
    the units as of the last increment."""
    rows = _table(spark, root, "sector_year", _SECTOR_YEAR).groupBy(F.col("sector").alias(cols.sector), F.col("annee").alias(cols.year))
    return rows.agg(F.sum("n").alias("n"), F.sum("total").cast("double").alias(cols.revenue)).where("n > 0").drop("n")
