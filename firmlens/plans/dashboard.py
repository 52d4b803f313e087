"""Dashboard pipelines: the mart (X8), sector growth (X7, flagship), sector history (A6),
top revenue units (X10), the establishment card (X9) and the scoped frequency tables.

Every function is ``(DataFrame…, parameters) → DataFrame``, lazy but for the intermediate tables
that ``materialize`` writes; column names are the
register's (lower case) and can be overridden through the ``Cols`` record.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..fixed import ADDRESS_PARTS, GROWTH_YEARS, TOP_SECTORS, TOP_UNITS
from ..functions.geo import lambert93_defined, lambert93_to_wgs84
from ..functions.scalars import address_line, default_from, growth_pct, money, or_default, year_of
from ..operators.aggregates import distinct_rows, top_k_counts
from ..operators.joins import (
    join_label_lookup,
    join_left_parent,
    join_left_parent_salted,
    lookup_default,
    period_over_period,
    restrict_to,
    semi_join_keys,
)
from ..operators.topk import history, top_n
from ..operators.windows import latest_per_key
from ..session import materialize


@dataclass(frozen=True)
class Cols:
    siren: str = "siren"
    siret: str = "siret"
    sector: str = "activiteprincipaleunitelegale"
    name: str = "denominationunitelegale"
    category: str = "categorieentreprise"
    category_year: str = "anneecategorieentreprise"
    place: str = "libellecommuneetablissement"
    x: str = "coordonneelambertabscisseetablissement"
    y: str = "coordonneelambertordonneeetablissement"
    closing: str = "date_cloture_exercice"
    revenue: str = "chiffre_d_affaires"
    result: str = "resultat_net"
    year: str = "annee"
    code: str = "code"
    label: str = "libelle"


C = Cols()


def dashboard_mart(
    etab: DataFrame, ul: DataFrame, naf: DataFrame, cols: Cols = C, salt_buckets: int | None = None, dealt_by: str | None = None
) -> DataFrame:
    """Establishments ⟕ legal-unit attributes ⟕ sector labels, with coordinates in
    degrees; a missing name falls back to the establishment number; rows whose position
    cannot be converted are dropped. With ``salt_buckets`` the unit join salts hot units
    explicitly (for sessions without adaptive skew-join handling). ``dealt_by`` rebalances the rows by a column, for a
    writer that partitions by it: before labels and degrees are added, so that these aren't shuffled."""
    unit_cols = [cols.sector, cols.name, cols.category, cols.category_year]
    if salt_buckets:
        df = join_left_parent_salted(etab, ul, cols.siren, unit_cols, buckets=salt_buckets)
    else:
        df = join_left_parent(etab, ul, cols.siren, unit_cols)
    df = df.withColumn(cols.name, default_from(cols.name, cols.siret))
    df = df.where(lambert93_defined(cols.x, cols.y))
    if dealt_by:
        df = df.hint("rebalance", F.col(dealt_by))
    df = join_label_lookup(df, naf, cols.sector, cols.code, [cols.label], keep_code_as=cols.code)
    return lambert93_to_wgs84(df, cols.x, cols.y, "longitude", "latitude")


def publish_mart(mart: DataFrame, path: str, cols: Cols = C) -> DataFrame:
    """Store the mart partitioned by place: a dashboard scope (one place) then reads only
    that place's files (partition pruning) instead of the whole mart. A place is written by
    few tasks, a large one by several (adaptive rebalancing). Returns the stored mart."""
    mart.hint("rebalance", F.col(cols.place)).write.mode("overwrite").partitionBy(cols.place).parquet(path)
    return read_mart(mart.sparkSession, path, mart.schema)


def read_mart(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The stored mart."""
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def sector_year_revenue(scoped: DataFrame, fin: DataFrame, cols: Cols = C) -> DataFrame:
    """A2 → J2 → C5 → A5: revenue per (sector, year) of the units present in ``scoped``.

    Units are de-duplicated first (one row per unit and sector), so a unit with many
    establishments counts its accounts once. A (sector, year) appears when some unit of the
    sector has accounts that year; its revenue is 0 when all their amounts are null.
    The accounts are shuffled once, to meet the units in scope (not at all when those are few
    enough to be broadcast; a hot unit is split by adaptive execution), and summed per
    (sector, year) map-side: accounts out of scope are never aggregated."""
    units = distinct_rows(scoped, [cols.siren, cols.sector]).where(F.col(cols.sector).isNotNull())
    accounts = fin.select(cols.siren, year_of(cols.closing).alias(cols.year), money(cols.revenue).alias("__v"))
    merged = accounts.where(F.col(cols.year).isNotNull()).join(units, on=cols.siren, how="inner")
    return merged.groupBy(cols.sector, cols.year).agg(
        F.coalesce(F.sum("__v").cast("double"), F.lit(0.0)).alias(cols.revenue)
    )


def sector_growth(
    scoped: DataFrame,
    fin: DataFrame,
    naf: DataFrame,
    n_years: int = GROWTH_YEARS,
    top: int = TOP_SECTORS,
    cols: Cols = C,
) -> tuple[DataFrame, DataFrame]:
    """X7 (flagship): the ``top`` sectors by revenue growth between the latest year and
    ``n_years`` earlier, and the yearly revenue history of those sectors.

    Growth is (recent − past) / past × 100; sectors without a past value, or with a past
    value of 0, have no defined growth and are left out. Ties: sector code ascending.
    """
    per_year = materialize(sector_year_revenue(scoped, fin, cols))  # one pass over the facts
    evo = period_over_period(per_year, cols.sector, cols.year, cols.revenue, n_years, reuse=False)
    rev_r, rev_p = cols.revenue + "_recent", cols.revenue + "_past"
    evo = evo.withColumns({
        "evol_ca": F.col(rev_r) - F.col(rev_p),
        "evol_pct": growth_pct(rev_r, rev_p),
    }).where(F.col("evol_pct").isNotNull())
    best = top_n(evo, "evol_pct", top, tiebreak=[cols.sector])
    top5 = join_label_lookup(best, naf, cols.sector, cols.code, [cols.label], keep_code_as=cols.code)
    hist = restrict_to(per_year, best, cols.sector)
    hist = join_label_lookup(hist, naf, cols.sector, cols.code, [cols.label], keep_code_as=cols.code)
    hist = hist.withColumn("secteur_libelle", F.col(cols.label))
    return top5, hist


def sector_revenue_history(scoped: DataFrame, fin: DataFrame, sector: str, cols: Cols = C) -> DataFrame:
    """Yearly revenue of one sector's units within the scope."""
    one = scoped.where(F.col(cols.sector) == F.lit(sector))
    per_year = sector_year_revenue(one, fin, cols)
    return per_year.select(cols.year, cols.revenue).orderBy(cols.year)


def top_sectors(scoped: DataFrame, naf: DataFrame, k: int = TOP_SECTORS, cols: Cols = C) -> DataFrame:
    """A4 + J3: the ``k`` sectors with most establishments in scope, with their label."""
    counts = top_k_counts(scoped, cols.sector, k, out="nombre_etablissements")
    return join_label_lookup(counts, naf, cols.sector, cols.code, {cols.label: "secteur"})


def top_revenue_units(scoped: DataFrame, fin: DataFrame, n: int = TOP_UNITS, cols: Cols = C) -> DataFrame:
    """The ``n`` units with the largest revenue in their latest accounts.

    Per unit: the latest closing date wins (ties: larger revenue, then larger result);
    units without any dated account are left out; the displayed name is the unit's name or,
    when missing, its first establishment number. Accounts are restricted to the units in
    scope before ranking, so only their accounts are shuffled.
    """
    # the scoped units feed two branches (the key restriction and the final join): computed
    # once and materialized, so the establishments are scanned once
    units = materialize(scoped.groupBy(cols.siren).agg(F.min(cols.name).alias(cols.name)))
    accounts = semi_join_keys(fin, units, cols.siren)
    latest = latest_per_key(
        accounts, cols.siren, cols.closing,
        tiebreak=[F.col(cols.revenue).desc_nulls_last(), F.col(cols.result).desc_nulls_last()],
    )
    ranked = units.join(latest.select(cols.siren, cols.revenue), on=cols.siren, how="inner")
    return top_n(ranked, cols.revenue, n, tiebreak=[cols.siren]).select(cols.name, cols.siren, cols.revenue)


def establishment_card(
    mart: DataFrame,
    tranches: DataFrame,
    siren: str | None = None,
    cols: Cols = C,
    tranche_col: str = "trancheeffectifsetablissement",
) -> DataFrame:
    """The card shown for a unit: its first establishment (lowest establishment
    number) with name, identifiers, category, address line, workforce band label and
    years. ``siren=None`` builds the card of every unit (one row per unit)."""
    rows = mart if siren is None else mart.where(F.col(cols.siren) == F.lit(siren))
    first = latest_per_key(
        rows.withColumn("__first", F.lit(0)), cols.siren, "__first", tiebreak=[F.col(cols.siret).asc()]
    )
    card = first.select(
        F.col(cols.name).alias("denomination"),
        F.col(cols.siren),
        or_default(cols.siret).alias("siret"),
        or_default(cols.category).alias("categorie"),
        address_line(list(ADDRESS_PARTS)).alias("adresse"),
        F.col(tranche_col),
        or_default("anneeeffectifsetablissement").alias("annee_effectif"),
        or_default(cols.category_year).alias("annee_categorie"),
    )
    card = lookup_default(card, tranches, tranche_col, "tranche_effectif", cols.code, cols.label)
    return card.drop(tranche_col)


def financial_history(fin: DataFrame, siren: str, cols: Cols = C) -> DataFrame:
    """One unit's accounts in closing-date order."""
    return history(fin, cols.siren, siren, cols.closing, [cols.closing, cols.revenue, cols.result])


def financial_histories(scoped: DataFrame, fin: DataFrame, cols: Cols = C) -> DataFrame:
    """T3 for every unit in scope: their accounts ordered by unit, then closing date
    (a semi join on the scoped units, then one global sort)."""
    acc = semi_join_keys(fin, scoped.select(cols.siren), cols.siren)
    return acc.select(cols.siren, cols.closing, cols.revenue, cols.result).orderBy(cols.siren, cols.closing)
