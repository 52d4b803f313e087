"""Hot keys: one unit holding a third of all establishments and accounts.

The operators must give the same answers as a brute-force computation (DuckDB over the
same rows), and the hot unit must reach the joins pre-aggregated — one row per (unit,
year) or per (place, unit) — rather than as a third of the table in one task.
"""

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from firmlens.operators import aggregates as A
from firmlens.operators.windows import latest_per_key
from firmlens.plans import dashboard as dash
from firmlens.plans.exploration import mean_revenue_by_category
from firmlens.roles import ROLE_VIEWS, role, table

from .test_plans import plan

SF = "/root/testdata/sf0.01"
HOT = "000000007"


def _hot_view(spark, view):
    """A role view over orders with every third order re-keyed to the hot unit."""
    v = ROLE_VIEWS[view]
    exprs = dict(v.columns)
    cols = [f"CASE WHEN o_orderkey % 3 = 0 THEN '{HOT}' ELSE {exprs['siren']} END AS siren"]
    cols += [f"{e} AS {n}" for n, e in v.columns if n != "siren"]
    return table(spark, SF, v.source).selectExpr(*cols)


@pytest.fixture(scope="module")
def hot(spark):
    etab = _hot_view(spark, "etablissements").cache()
    fin = _hot_view(spark, "donnees_financieres").cache()
    ul = role(spark, SF, "unite_legale")
    yield etab, fin, ul
    etab.unpersist()
    fin.unpersist()


def _duck(**frames):
    con = duckdb.connect()
    for name, pdf in frames.items():
        con.register(name, pdf)
    return con


def _pdf(df) -> pd.DataFrame:
    return df.toPandas()


def test_hot_key_holds_a_third(hot):
    etab, fin, _ = hot
    n = etab.count()
    assert etab.where(F.col("siren") == HOT).count() > n / 4


def test_revenue_by_group_under_skew(hot):
    etab, fin, _ = hot
    got = {r[0]: r[1] for r in A.revenue_by_group(etab, fin, "libellecommuneetablissement").collect()}
    con = _duck(e=_pdf(etab.select("siren", "libellecommuneetablissement")),
                f=_pdf(fin.select("siren", "chiffre_d_affaires")))
    want = dict(con.execute("""
        SELECT e.libellecommuneetablissement,
               coalesce(CAST(sum(CAST(f.chiffre_d_affaires AS DECIMAL(18,2))) AS DOUBLE), 0.0)
        FROM e LEFT JOIN f ON e.siren = f.siren
        WHERE e.libellecommuneetablissement IS NOT NULL GROUP BY 1""").fetchall())
    assert got == want


def test_mean_by_category_under_skew(hot):
    etab, fin, ul = hot
    ul = ul.unionByName(ul.limit(1).withColumn("siren", F.lit(HOT)))
    got = {r[0]: r[1] for r in mean_revenue_by_category(etab, ul, fin).collect()}
    con = _duck(e=_pdf(etab.select("siren")), u=_pdf(ul.select("siren", "categorieentreprise")),
                f=_pdf(fin.select("siren", "chiffre_d_affaires")))
    want = dict(con.execute("""
        SELECT u.categorieentreprise,
               CAST(sum(CAST(f.chiffre_d_affaires AS DECIMAL(18,2))) AS DOUBLE) / count(f.chiffre_d_affaires)
        FROM e LEFT JOIN u ON e.siren = u.siren LEFT JOIN f ON e.siren = f.siren
        WHERE f.chiffre_d_affaires IS NOT NULL AND u.categorieentreprise IS NOT NULL GROUP BY 1""").fetchall())
    assert got == want


def test_accounts_of_a_hot_unit_count_once_and_are_shuffled_once(spark, hot):
    """The units are de-duplicated, so the hot unit's accounts meet one row each; large inputs
    shuffle the accounts by unit once."""
    etab, fin, ul = hot
    scoped = etab.join(ul.select("siren", "activiteprincipaleunitelegale"), "siren").where("activiteprincipaleunitelegale IS NOT NULL")
    out = dash.sector_year_revenue(scoped, fin)
    units = scoped.select("siren", "activiteprincipaleunitelegale").distinct()
    want = (
        fin.where("year(date_cloture_exercice) IS NOT NULL").join(units, "siren")
        .groupBy("activiteprincipaleunitelegale", F.year("date_cloture_exercice").alias("annee"))
        .agg(F.coalesce(F.sum(F.col("chiffre_d_affaires").cast("decimal(38,2)")).cast("double"), F.lit(0.0)).alias("ca"))
    )
    assert sorted(tuple(r) for r in out.collect()) == sorted(tuple(r) for r in want.collect())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tree = plan(dash.sector_year_revenue(role(spark, SF, "unite_legale"), role(spark, SF, "donnees_financieres")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # accounts by unit, units (distinct, then by unit), partial sums by sector and year
    assert tree.split("\n\n")[0].count("Exchange") <= 4


def test_latest_per_key_under_skew(hot):
    _, fin, _ = hot
    out = latest_per_key(fin, "siren", "date_cloture_exercice",
                         tiebreak=[F.col("chiffre_d_affaires").desc_nulls_last(),
                                   F.col("resultat_net").desc_nulls_last()])
    got = out.where(F.col("siren") == HOT).collect()
    want = (fin.where((F.col("siren") == HOT) & F.col("date_cloture_exercice").isNotNull())
            .orderBy(F.col("date_cloture_exercice").desc(), F.col("chiffre_d_affaires").desc_nulls_last(),
                     F.col("resultat_net").desc_nulls_last()).first())
    assert len(got) == 1 and got[0]["date_cloture_exercice"] == want["date_cloture_exercice"]
    assert got[0]["chiffre_d_affaires"] == want["chiffre_d_affaires"]


def test_sector_growth_under_skew(hot):
    etab, fin, ul = hot
    naf = role(fin.sparkSession, SF, "code_naf")
    mart = dash.dashboard_mart(etab, ul, naf)
    top5, hist = dash.sector_growth(mart, fin, naf)
    assert top5.count() <= 5
    assert {r[0] for r in top5.collect()} <= {r[0] for r in hist.select("activiteprincipaleunitelegale").collect()}


def test_salted_parent_join_spreads_the_hot_key(hot, spark):
    from firmlens.operators.joins import join_left_parent, join_left_parent_salted

    etab, _, ul = hot
    ul = ul.unionByName(ul.limit(1).withColumn("siren", F.lit(HOT)))
    cols = ["activiteprincipaleunitelegale", "denominationunitelegale"]
    plain = join_left_parent(etab.select("siret", "siren"), ul, "siren", cols)
    salted = join_left_parent_salted(etab.select("siret", "siren"), ul, "siren", cols, buckets=8)
    assert sorted(map(tuple, salted.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        per_task = (join_left_parent_salted(etab.select("siret", "siren"), ul, "siren", cols, buckets=8)
                    .where(F.col("siren") == HOT)
                    .groupBy(F.spark_partition_id().alias("p")).count().collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(per_task) >= 4  # the hot unit's rows are joined in several tasks, not one


def test_salted_mart_equals_plain_mart(hot, spark):
    etab, _, ul = hot
    naf = role(spark, SF, "code_naf")
    cols = ["siret", "siren", "denominationunitelegale", "libelle", "longitude", "latitude"]
    plain = dash.dashboard_mart(etab, ul, naf).select(*cols)
    salted = dash.dashboard_mart(etab, ul, naf, salt_buckets=8).select(*cols)
    assert plain.exceptAll(salted).count() == 0 and salted.exceptAll(plain).count() == 0


def test_chain_join_salted_equals_plain(hot, spark):
    from firmlens.operators.joins import join_chain_left

    etab, fin, ul = hot
    ul = ul.unionByName(ul.limit(1).withColumn("siren", F.lit(HOT)))
    args = (etab.select("siret", "siren"), ul, fin, "siren", ["categorieentreprise"])
    plain = join_chain_left(*args).withColumn("detail_sum", F.col("detail_sum").cast("double"))
    salted = join_chain_left(*args, salt_buckets=8).withColumn("detail_sum", F.col("detail_sum").cast("double"))
    assert plain.exceptAll(salted).count() == 0 and salted.exceptAll(plain).count() == 0
    hot_row = plain.where(F.col("siren") == HOT).first()
    assert hot_row.detail_rows == fin.where(F.col("siren") == HOT).count()
