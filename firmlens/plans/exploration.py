"""Exploration analytics (the notebook's questions): mean revenue by company category
(A8 over the establishment ⟕ unit ⟕ accounts chain), mean revenue of the leading sector
labels over the years (A9), and the region table behind the choropleth (X12)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed import TOP_LABELS
from ..functions.scalars import money, normalize_place, year_of
from ..operators.aggregates import top_k_counts
from ..operators.joins import join_label_lookup, region_metric, restrict_to
from ..operators.topk import top_n
from ..session import materialize


def mean_revenue_by_category(
    etab: DataFrame,
    ul: DataFrame,
    fin: DataFrame,
    key: str = "siren",
    category: str = "categorieentreprise",
    value: str = "chiffre_d_affaires",
) -> DataFrame:
    """A8 over the chained rows establishment ⟕ unit ⟕ accounts: every account of a unit
    counts once per establishment of the unit (the chain's fan-out is the weight).

    The chain is never materialised: establishments are counted per unit and accounts
    summed per unit (both map-side combined, so a unit with a third of all rows costs one
    partial row per partition); the mean is Σ n·sum / Σ n·count per category."""
    n_etab = etab.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    acc = fin.groupBy(key).agg(F.sum(money(value)).alias("__s"), F.count(money(value)).alias("__c"))
    per_unit = n_etab.join(ul.select(key, category), on=key, how="left").join(acc, on=key, how="inner")
    per_unit = per_unit.where(F.col(category).isNotNull() & (F.col("__c") > 0))
    return per_unit.groupBy(category).agg(
        (F.sum(F.col("__n") * F.col("__s")).cast("double") / F.sum(F.col("__n") * F.col("__c"))).alias(value)
    )


def mean_revenue_top_labels(
    fin: DataFrame,
    ul: DataFrame,
    naf: DataFrame,
    top: int = TOP_LABELS,
    key: str = "siren",
    sector: str = "activiteprincipaleunitelegale",
    closing: str = "date_cloture_exercice",
    value: str = "chiffre_d_affaires",
) -> DataFrame:
    """Mean revenue per (year, sector label) for the ``top`` labels with the highest
    mean in the latest year, every year × label present (gaps are 0), long form.

    The ``top`` labels (bounded by the parameter) are the columns of a wide form, from which the
    long form with every year × label comes back, without a cross join. Two jobs run while the
    plan is built: the means, and the choice of the leading labels."""
    # accounts meet their units (one shuffle of the accounts; a hot unit is split by adaptive
    # execution) and are summed per (year, label), map-side combined
    accounts = fin.select(key, year_of(closing).alias("annee"), money(value).alias("__v")).where(F.col("annee").isNotNull())
    df = accounts.join(ul.select(key, sector), on=key, how="inner")
    df = join_label_lookup(df, naf, sector, "code", ["libelle"]).where(F.col("libelle").isNotNull())
    means = materialize(  # one pass over the accounts; the small result feeds four branches
        df.groupBy("annee", "libelle").agg((F.sum("__v").cast("double") / F.count("__v")).alias("ca_moyen"))
    )
    last = means.select(F.max("annee")).scalar()
    last_year = means.where(F.col("annee") == last).select("libelle", F.col("ca_moyen").alias("__v"))
    cand = means.select("libelle").distinct().join(last_year, on="libelle", how="left")
    cand = cand.withColumn("__v", F.coalesce(F.col("__v"), F.lit(0.0)))
    leading = top_n(cand, "__v", top, tiebreak=["libelle"]).select("libelle")
    leaders = [r[0] for r in leading.collect()]  # at most ``top`` labels: the pivot values
    if not leaders:
        return means.where(F.lit(False))
    series = restrict_to(means, leading, "libelle")
    gaps = [
        F.struct(F.lit(v).alias("libelle"), F.coalesce(F.max(F.when(F.col("libelle") == v, F.col("ca_moyen"))), F.lit(0.0)).alias("ca_moyen"))
        for v in leaders
    ]
    return series.groupBy("annee").agg(F.array(*gaps).alias("__cells")).select("annee", F.inline("__cells"))


def active_by_region(
    etab: DataFrame,
    ul: DataFrame,
    regions: DataFrame,
    key: str = "siren",
    status: str = "etatadministratifetablissement",
    sector: str = "activiteprincipaleunitelegale",
) -> DataFrame:
    """Active establishments per region (via the unit's activity code), most first.
    Establishments are counted per unit before the join (map-side combined), so the join
    meets one row per unit however many establishments a unit has."""
    from ..operators.filters import filter_active

    per_unit = filter_active(etab, status).groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    df = per_unit.join(ul.select(key, sector), on=key, how="left")
    df = join_label_lookup(df, regions, sector, "code", {"libelle": "region"}).where(F.col("region").isNotNull())
    out = df.groupBy("region").agg(F.sum("__n").alias("nombre_etablissements"))
    return out.orderBy(F.col("nombre_etablissements").desc(), F.col("region"))


def region_table(
    features: DataFrame,
    etab: DataFrame,
    feature_name: str = "nom",
    place: str = "libellecommuneetablissement",
    metric: str = "nb_entreprises",
) -> DataFrame:
    """Every region feature with its number of establishments, names normalised on
    both sides (features without establishments get 0)."""
    counts = top_k_counts(etab.select(normalize_place(place).alias("commune")), "commune", None, out=metric)
    return region_metric(features, counts, feature_name, "commune", metric, normalize=normalize_place)


def merge_ratio_records(
    spark,
    ratio_pages: str,
    ratio_envelope,
    unit_pages: str,
    unit_envelope,
    target: str,
    columns,
    key: str = "siren",
) -> str:
    """X11: ratio pages (``results`` arrays) and unit records (``uniteLegale`` objects) → inner join
    on the key → the chosen columns (a missing one is an error) → the target table replaced
    (one committed version; read it with ``read_published(spark, target, "data")``). The records
    pass typed from the pages; no interim text files."""
    from ..operators.joins import join_inner_key
    from ..operators.project import project_fixed
    from ..sources.json import read_pages
    from ..sources.sinks import replace_table

    ratios = read_pages(spark, ratio_pages, ratio_envelope, "results")
    units = read_pages(spark, unit_pages, unit_envelope, None, single_field="uniteLegale")
    return replace_table(project_fixed(join_inner_key(ratios, units, key), columns), target)
