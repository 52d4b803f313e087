"""Query catalogue: key → (Spark query over the driver tables, DuckDB oracle SQL).

Each query reads the role views (``roles.py``) of the tables under ``sf_dir`` and runs one
operator or pipeline of SURVEY §2 over the whole tables. The oracle states the same
meaning in plain SQL over the same role views. Keys whose meaning SQL cannot state (file
round trips with side effects, streaming) still have an oracle where the end state is
expressible. (``NO_ORACLE`` would list keys without one; every key has one today.)
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle_sql as q
from .functions import scalars as S
from .functions.geo import lambert93_defined, lambert93_to_wgs84
from .operators import aggregates as A
from .operators import filters as FL
from .operators import joins as J
from .operators import project as P
from .operators.windows import latest_per_key as latest_row
from .fixed import ADDRESS_PARTS, ESTABLISHMENT_COLUMNS, FIRST_RECENT_YEAR
from .plans import dashboard as dash
from .plans.mart import files_state, read_fresh_mart, refresh_mart
from .roles import ROLE_VIEWS, role, table
from .session import run_dir
from .sources.tables import table_exists

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
NO_ORACLE: dict[str, str] = {}

# Dashboard scope used by the queries: the place with most establishments in the role data.
PLACE = "1-URGENT"
SECTOR = "03"


def register(key: str, sql: str | None = None, why_no_sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        elif why_no_sql:
            NO_ORACLE[key] = why_no_sql
        return fn
    return deco


def _built_mart(spark: SparkSession, sf: str) -> DataFrame:
    return dash.dashboard_mart(
        role(spark, sf, "etablissements"), role(spark, sf, "unite_legale"), role(spark, sf, "code_naf")
    )


_marts: dict[tuple[str, str], tuple[str, str, DataFrame]] = {}


def _mart(spark: SparkSession, sf: str) -> DataFrame:
    """X8 as the dashboard uses it: built from the whole tables, stored, and brought up to date when an input's files
    have changed or the stored files are gone; the dashboard queries read the stored table."""
    inputs = [role(spark, sf, name) for name in ("etablissements", "unite_legale", "code_naf")]
    state, key = files_state(*inputs), (spark.conf.get("spark.app.id"), sf)
    held, root, stored = _marts.get(key, (None, None, None))
    if root is None or not table_exists(spark, root):
        root = run_dir(spark, "mart")
    if held != state or not table_exists(spark, f"{root}/rows"):
        refresh_mart(*inputs, root)
        stored = read_fresh_mart(spark, root, dash.dashboard_mart(*inputs).schema)
        _marts[key] = (state, root, stored)
    return stored


def _scoped(spark: SparkSession, sf: str, sector: str | None = None) -> DataFrame:
    return FL.filter_scope(_mart(spark, sf), dash.C.place, dash.C.sector, PLACE, sector)


# ---------------------------------------------------------------- X7 flagship
_PER_YEAR_SQL = f"""scoped AS (SELECT * FROM mart WHERE libellecommuneetablissement = '{PLACE}'),
units AS (SELECT DISTINCT siren, activiteprincipaleunitelegale FROM scoped),
merged AS (
  SELECT u.activiteprincipaleunitelegale, CAST(year(f.date_cloture_exercice) AS INTEGER) AS annee,
         f.chiffre_d_affaires
  FROM units u LEFT JOIN donnees_financieres f ON u.siren = f.siren
),
per_year AS (
  SELECT activiteprincipaleunitelegale, annee,
         coalesce({q.money_sum('chiffre_d_affaires')}, 0.0) AS chiffre_d_affaires
  FROM merged
  WHERE activiteprincipaleunitelegale IS NOT NULL AND annee IS NOT NULL
  GROUP BY activiteprincipaleunitelegale, annee
),
evo AS (
  SELECT r.activiteprincipaleunitelegale,
         r.annee AS annee_recent, r.chiffre_d_affaires AS chiffre_d_affaires_recent,
         p.annee AS annee_past, p.chiffre_d_affaires AS chiffre_d_affaires_past,
         r.chiffre_d_affaires - p.chiffre_d_affaires AS evol_ca,
         CASE WHEN p.chiffre_d_affaires <> 0
              THEN (r.chiffre_d_affaires - p.chiffre_d_affaires) / p.chiffre_d_affaires * 100 END AS evol_pct
  FROM per_year r
  LEFT JOIN per_year p ON r.activiteprincipaleunitelegale = p.activiteprincipaleunitelegale
                      AND p.annee = (SELECT max(annee) FROM per_year) - 3
  WHERE r.annee = (SELECT max(annee) FROM per_year)
),
top5 AS (
  SELECT * FROM evo WHERE evol_pct IS NOT NULL
  ORDER BY evol_pct DESC, activiteprincipaleunitelegale ASC LIMIT 5
)
"""


_GROWTH = q.ctes(*q.MART, "donnees_financieres", _PER_YEAR_SQL.strip())


@register("sector_growth_top5", _GROWTH + """SELECT t.*, n.libelle, n.code
FROM top5 t LEFT JOIN code_naf n ON t.activiteprincipaleunitelegale IS NOT DISTINCT FROM n.code""")
def sector_growth_top5(spark: SparkSession, sf: str) -> DataFrame:
    top5, _ = dash.sector_growth(_scoped(spark, sf), role(spark, sf, "donnees_financieres"),
                                 role(spark, sf, "code_naf"))
    return top5


@register("sector_growth_history", _GROWTH + """SELECT p.*, n.libelle, n.code, n.libelle AS secteur_libelle
FROM per_year p LEFT JOIN code_naf n ON p.activiteprincipaleunitelegale IS NOT DISTINCT FROM n.code
WHERE p.activiteprincipaleunitelegale IN (SELECT activiteprincipaleunitelegale FROM top5)""")
def sector_growth_history(spark: SparkSession, sf: str) -> DataFrame:
    _, hist = dash.sector_growth(_scoped(spark, sf), role(spark, sf, "donnees_financieres"),
                                 role(spark, sf, "code_naf"))
    return hist


# ---------------------------------------------------------------- scalar functions


@register("clean_dates", q.ctes("etablissements_raw", "unite_legale_raw") + """
SELECT e.siret, try_cast(e.dateCreationEtablissement AS DATE) AS datecreationetablissement,
       u.siren, try_cast(u.dateCreationUniteLegale AS DATE) AS datecreationunitelegale
FROM etablissements_raw e LEFT JOIN unite_legale_raw u ON e.siren = u.siren""")
def clean_dates(spark, sf):
    e = role(spark, sf, "etablissements_raw").select(
        "siret", "siren", S.lenient_date("dateCreationEtablissement").alias("datecreationetablissement"))
    u = role(spark, sf, "unite_legale_raw").select(
        F.col("siren").alias("u_siren"), S.lenient_date("dateCreationUniteLegale").alias("datecreationunitelegale"))
    out = e.join(u, e.siren == u.u_siren, "left")
    return out.select("siret", "datecreationetablissement", F.col("u_siren").alias("siren"),
                      "datecreationunitelegale")


# some amounts as texts that are no plain numbers, marked with an x in front
_AMOUNT_SQL = """(CASE substr(coalesce((t), '0'), 1, 2) WHEN '11' THEN 'xNaN' WHEN '12' THEN 'xInfinity'
  WHEN '13' THEN 'x1e400' WHEN '14' THEN 'x12d' ELSE '' END)"""


@register("clean_numbers", q.ctes("etablissements_raw", "donnees_financieres_raw") + """
SELECT siret AS id,
       try_cast(coordonneeLambertAbscisseEtablissement AS DOUBLE) AS a,
       try_cast(coordonneeLambertOrdonneeEtablissement AS DOUBLE) AS b
FROM etablissements_raw UNION ALL
SELECT siren, CASE WHEN """ + _AMOUNT_SQL.replace("(t)", "(chiffre_d_affaires)") + """ LIKE 'x%' THEN NULL
         ELSE try_cast(chiffre_d_affaires AS DOUBLE) END, try_cast(resultat_net AS DOUBLE)
FROM donnees_financieres_raw""")
def clean_numbers(spark, sf):
    """C2 over both kinds of numbers: coordinates, and amounts among which some texts are no plain
    numbers (``NaN``, ``Infinity``, ``1e400``, ``12d``)."""
    e = role(spark, sf, "etablissements_raw").select(
        F.col("siret").alias("id"),
        S.lenient_double("coordonneeLambertAbscisseEtablissement").alias("a"),
        S.lenient_double("coordonneeLambertOrdonneeEtablissement").alias("b"),
    )
    f = role(spark, sf, "donnees_financieres_raw")
    odd = F.expr(_AMOUNT_SQL.replace("(t)", "(chiffre_d_affaires)"))
    amount = F.when(odd.startswith("x"), F.substring(odd, 2, 20)).otherwise(F.col("chiffre_d_affaires"))
    return e.unionByName(f.select(
        F.col("siren").alias("id"), S.lenient_double(amount).alias("a"), S.lenient_double("resultat_net").alias("b")))


@register("clean_postal", q.ctes("etablissements_raw") + """
SELECT siret, CASE WHEN length(codePostalEtablissement) = 5 THEN codePostalEtablissement END AS codepostaletablissement
FROM etablissements_raw""")
def clean_postal(spark, sf):
    e = role(spark, sf, "etablissements_raw")
    return e.select("siret", S.postal_or_null("codePostalEtablissement").alias("codepostaletablissement"))


@register("coalesce_name", q.ctes("etablissements", "unite_legale") + """
SELECT e.siret, e.siren, coalesce(u.denominationunitelegale, e.siret) AS denominationunitelegale
FROM etablissements e LEFT JOIN unite_legale u ON e.siren = u.siren""")
def coalesce_name(spark, sf):
    df = J.join_left_parent(role(spark, sf, "etablissements").select("siret", "siren"),
                            role(spark, sf, "unite_legale"), "siren", ["denominationunitelegale"])
    return df.withColumn("denominationunitelegale", S.default_from("denominationunitelegale", "siret"))


_ADDR = ", ".join(f"CASE WHEN trim({p}) <> '' THEN {p} END" for p in ADDRESS_PARTS)


@register("address_line", q.ctes("etablissements") + f"""
SELECT siret, coalesce(nullif(concat_ws(' ', {_ADDR}), ''), 'N/A') AS adresse FROM etablissements""")
def address_line(spark, sf):
    e = role(spark, sf, "etablissements")
    return e.select("siret", S.address_line(list(ADDRESS_PARTS)).alias("adresse"))


@register("normalize_place", q.ctes("communes_geo") + f"""
SELECT feature_id, nom, {q.normalize_place_sql('nom')} AS nom_normalise FROM communes_geo""")
def normalize_place(spark, sf):
    g = role(spark, sf, "communes_geo")
    return g.select("feature_id", "nom", S.normalize_place("nom").alias("nom_normalise"))


@register("code_label", q.ctes("code_naf") + """
SELECT code, libelle, concat(code, ' - ', libelle) AS affichage,
       split_part(concat(code, ' - ', libelle), ' - ', 1) AS code_lu,
       CASE WHEN position(' - ' IN concat(code, ' - ', libelle)) > 0
            THEN substr(concat(code, ' - ', libelle), position(' - ' IN concat(code, ' - ', libelle)) + 3)
            ELSE '' END AS libelle_lu
FROM code_naf""")
def code_label(spark, sf):
    n = role(spark, sf, "code_naf").withColumn("affichage", S.code_label("code", "libelle"))
    return n.select("code", "libelle", "affichage", S.code_of("affichage").alias("code_lu"),
                    S.label_of("affichage").alias("libelle_lu"))


@register("geo_lambert93", q.ctes(
    "etablissements",
    q.lambert_ctes("etablissements", "coordonneelambertabscisseetablissement",
                   "coordonneelambertordonneeetablissement", "geo", decimals=6)) + """
SELECT siret, longitude, latitude FROM geo WHERE latitude IS NOT NULL AND longitude IS NOT NULL""")
def geo_lambert93(spark, sf):
    e = role(spark, sf, "etablissements")
    x, y = "coordonneelambertabscisseetablissement", "coordonneelambertordonneeetablissement"
    e = e.where(lambert93_defined(x, y)).select("siret", x, y)
    return lambert93_to_wgs84(e, x, y, decimals=6).select("siret", "longitude", "latitude")


# ---------------------------------------------------------------- projections
@register("project_present", q.ctes("etablissements_raw") + "SELECT "
          + ", ".join(f"{c} AS {c.lower()}" for c in ESTABLISHMENT_COLUMNS) + " FROM etablissements_raw")
def project_present(spark, sf):
    # one wanted column does not exist in the source: it is skipped
    return P.project_present(role(spark, sf, "etablissements_raw"), [*ESTABLISHMENT_COLUMNS, "absentColumn"])


_REINDEX = {
    "siren": "siren",
    "denominationunitelegale": "denominationUniteLegale",
    "datecreationunitelegale": "dateCreationUniteLegale",
    "activiteprincipaleunitelegale": "activitePrincipaleUniteLegale",
    "nomenclatureactiviteprincipaleunitelegale": "nomenclatureActivitePrincipaleUniteLegale",
    "etatadministratifunitelegale": "etatAdministratifUniteLegale",
}


@register("project_reindex", q.ctes("unite_legale_raw") + """
SELECT siren, denominationUniteLegale AS denominationunitelegale,
       dateCreationUniteLegale AS datecreationunitelegale,
       activitePrincipaleUniteLegale AS activiteprincipaleunitelegale,
       CAST(NULL AS VARCHAR) AS nomenclatureactiviteprincipaleunitelegale,
       etatAdministratifUniteLegale AS etatadministratifunitelegale
FROM unite_legale_raw""")
def project_reindex(spark, sf):
    # the nomenclature column is absent from the source: it comes back as a typed null
    return P.project_reindex(role(spark, sf, "unite_legale_raw"), _REINDEX)


@register("json_flatten", """
SELECT event_id, event_type AS "kind",
       CAST(json_extract(props, '$.k') AS BIGINT) AS "props.k",
       user_id AS "who.user_id", value AS "who.detail.value"
FROM events""")
def json_flatten(spark, sf):
    ev = F.from_json("props", "k BIGINT")
    nested = table(spark, sf, "events").select(
        "event_id", F.col("event_type").alias("kind"), ev.alias("props"),
        F.struct(F.col("user_id"), F.struct(F.col("value")).alias("detail")).alias("who"),
    )
    return P.json_flatten(nested)


@register("project_fixed", q.ctes("etablissements") + """
SELECT siret, siren, libellecommuneetablissement FROM etablissements""")
def project_fixed(spark, sf):
    return P.project_fixed(role(spark, sf, "etablissements"), ["siret", "siren", "libellecommuneetablissement"])


# ---------------------------------------------------------------- filters
@register("filter_active", q.ctes("etablissements_raw") + """
SELECT siret, siren, etatAdministratifEtablissement AS etat FROM etablissements_raw
WHERE etatAdministratifEtablissement = 'A'""")
def filter_active(spark, sf):
    e = FL.filter_active(role(spark, sf, "etablissements_raw"), "etatAdministratifEtablissement")
    return e.select("siret", "siren", F.col("etatAdministratifEtablissement").alias("etat"))


TARGET_PLACES = ("1-URGENT", "2-HIGH")


@register("filter_in_list", q.ctes("etablissements") + f"""
SELECT siret, libellecommuneetablissement FROM etablissements
WHERE libellecommuneetablissement IN {TARGET_PLACES!r}""")
def filter_in_list(spark, sf):
    e = FL.filter_in_list(role(spark, sf, "etablissements"), "libellecommuneetablissement", TARGET_PLACES)
    return e.select("siret", "libellecommuneetablissement")


@register("drop_null_subset", q.ctes("etablissements") + """
SELECT siret, libellecommuneetablissement, coordonneelambertabscisseetablissement FROM etablissements
WHERE libellecommuneetablissement IS NOT NULL AND coordonneelambertabscisseetablissement IS NOT NULL""")
def drop_null_subset(spark, sf):
    e = role(spark, sf, "etablissements").select(
        "siret", "libellecommuneetablissement", "coordonneelambertabscisseetablissement")
    return FL.drop_null_subset(e, ["libellecommuneetablissement", "coordonneelambertabscisseetablissement"])


@register("filter_postal", q.ctes("etablissements_raw") + """
SELECT siret, codePostalEtablissement AS codepostaletablissement FROM etablissements_raw
WHERE codePostalEtablissement IS NOT NULL AND length(codePostalEtablissement) <= 5""")
def filter_postal(spark, sf):
    e = FL.filter_postal(role(spark, sf, "etablissements_raw"), "codePostalEtablissement")
    return e.select("siret", F.col("codePostalEtablissement").alias("codepostaletablissement"))


@register("filter_non_negative", q.ctes("donnees_financieres") + """
SELECT siren, date_cloture_exercice, chiffre_d_affaires FROM donnees_financieres WHERE chiffre_d_affaires >= 0""")
def filter_non_negative(spark, sf):
    f = role(spark, sf, "donnees_financieres").select("siren", "date_cloture_exercice", "chiffre_d_affaires")
    return FL.filter_non_negative(f, "chiffre_d_affaires")


@register("filter_scope", q.ctes(*q.MART) + f"""
SELECT siret, siren, activiteprincipaleunitelegale, libellecommuneetablissement FROM mart
WHERE libellecommuneetablissement = '{PLACE}' AND activiteprincipaleunitelegale = '{SECTOR}'""")
def filter_scope(spark, sf):
    return _scoped(spark, sf, SECTOR).select(
        "siret", "siren", "activiteprincipaleunitelegale", "libellecommuneetablissement")


MARK = "2000-01-01"


@register("incremental_filter", q.ctes("etablissements") + f"""
SELECT siret, datecreationetablissement FROM etablissements
WHERE datecreationetablissement >= DATE '{MARK}' AND etatadministratifetablissement = 'A'""")
def incremental_filter(spark, sf):
    import datetime as dt
    e = FL.incremental_filter(role(spark, sf, "etablissements"), "datecreationetablissement",
                              dt.date.fromisoformat(MARK), "etatadministratifetablissement")
    return e.select("siret", "datecreationetablissement")


# ---------------------------------------------------------------- joins
@register("join_inner_key", q.ctes("ratios", "unite_legale_raw") + """
SELECT r.siren, r.date_cloture_exercice, r.chiffre_d_affaires, u.categorieEntreprise AS categorieentreprise,
       u.statutDiffusionUniteLegale AS statutdiffusionunitelegale
FROM ratios r JOIN unite_legale_raw u ON r.siren = u.siren""")
def join_inner_key(spark, sf):
    r = role(spark, sf, "ratios").select("siren", "date_cloture_exercice", "chiffre_d_affaires")
    u = P.project_present(role(spark, sf, "unite_legale_raw"),
                          ["siren", "categorieEntreprise", "statutDiffusionUniteLegale"])
    return J.join_inner_key(r, u, "siren")


@register("join_left_parent", q.ctes("etablissements", "unite_legale") + """
SELECT e.siret, e.siren, u.activiteprincipaleunitelegale, u.denominationunitelegale
FROM etablissements e LEFT JOIN unite_legale u ON e.siren = u.siren""")
def join_left_parent(spark, sf):
    return J.join_left_parent(role(spark, sf, "etablissements").select("siret", "siren"),
                              role(spark, sf, "unite_legale"), "siren",
                              ["activiteprincipaleunitelegale", "denominationunitelegale"])


@register("join_label_lookup", q.ctes("unite_legale", "code_naf") + """
SELECT u.siren, u.activiteprincipaleunitelegale, n.libelle, n.code
FROM unite_legale u LEFT JOIN code_naf n ON u.activiteprincipaleunitelegale IS NOT DISTINCT FROM n.code""")
def join_label_lookup(spark, sf):
    u = role(spark, sf, "unite_legale").select("siren", "activiteprincipaleunitelegale")
    return J.join_label_lookup(u, role(spark, sf, "code_naf"), "activiteprincipaleunitelegale",
                               "code", ["libelle"], keep_code_as="code")


@register("join_chain_left", q.ctes("etablissements", "unite_legale", "donnees_financieres") + f"""
SELECT e.siret, e.siren, u.categorieentreprise, count(*) AS detail_rows,
       {q.money_sum('f.chiffre_d_affaires')} AS detail_sum, count(f.chiffre_d_affaires) AS detail_count
FROM etablissements e
LEFT JOIN unite_legale u ON e.siren = u.siren
LEFT JOIN donnees_financieres f ON e.siren = f.siren
GROUP BY e.siret, e.siren, u.categorieentreprise""")
def join_chain_left(spark, sf):
    out = J.join_chain_left(role(spark, sf, "etablissements").select("siret", "siren"),
                            role(spark, sf, "unite_legale"), role(spark, sf, "donnees_financieres"),
                            "siren", ["categorieentreprise"])
    return out.withColumn("detail_sum", F.col("detail_sum").cast("double"))


@register("semi_join_keys", q.ctes("etablissements", "donnees_financieres") + f"""
SELECT siren, date_cloture_exercice, chiffre_d_affaires FROM donnees_financieres
WHERE siren IN (SELECT siren FROM etablissements WHERE etatadministratifetablissement = 'A'
                AND libellecommuneetablissement IN {TARGET_PLACES!r})""")
def semi_join_keys(spark, sf):
    e = role(spark, sf, "etablissements")
    keys = FL.filter_in_list(FL.filter_active(e, "etatadministratifetablissement"),
                             "libellecommuneetablissement", TARGET_PLACES)
    f = role(spark, sf, "donnees_financieres").select("siren", "date_cloture_exercice", "chiffre_d_affaires")
    return J.semi_join_keys(f, keys, "siren")


_SECTOR_YEAR_ALL = f"""units AS (SELECT DISTINCT siren, activiteprincipaleunitelegale FROM mart),
per_year AS (
  SELECT u.activiteprincipaleunitelegale, CAST(year(f.date_cloture_exercice) AS INTEGER) AS annee,
         coalesce({q.money_sum('f.chiffre_d_affaires')}, 0.0) AS chiffre_d_affaires
  FROM units u LEFT JOIN donnees_financieres f ON u.siren = f.siren
  WHERE u.activiteprincipaleunitelegale IS NOT NULL AND f.date_cloture_exercice IS NOT NULL
  GROUP BY 1, 2
)
"""


@register("period_over_period", q.ctes(*q.MART, "donnees_financieres", _SECTOR_YEAR_ALL.strip()) + """
SELECT r.activiteprincipaleunitelegale, r.annee AS annee_recent, r.chiffre_d_affaires AS chiffre_d_affaires_recent,
       p.annee AS annee_past, p.chiffre_d_affaires AS chiffre_d_affaires_past
FROM per_year r LEFT JOIN per_year p
  ON r.activiteprincipaleunitelegale = p.activiteprincipaleunitelegale
 AND p.annee = (SELECT max(annee) FROM per_year) - 3
WHERE r.annee = (SELECT max(annee) FROM per_year)""")
def period_over_period(spark, sf):
    per_year = dash.sector_year_revenue(_mart(spark, sf), role(spark, sf, "donnees_financieres"))
    return J.period_over_period(per_year, "activiteprincipaleunitelegale", "annee", "chiffre_d_affaires", 3)


@register("lookup_default", q.ctes("etablissements", "tranches_effectifs") + """
SELECT e.siret, coalesce(t.libelle, 'N/A') AS tranche_effectif
FROM etablissements e LEFT JOIN tranches_effectifs t
  ON e.trancheeffectifsetablissement IS NOT DISTINCT FROM t.code""")
def lookup_default(spark, sf):
    e = role(spark, sf, "etablissements").select("siret", "trancheeffectifsetablissement")
    out = J.lookup_default(e, role(spark, sf, "tranches_effectifs"), "trancheeffectifsetablissement",
                           "tranche_effectif")
    return out.drop("trancheeffectifsetablissement")


@register("labels_in_use", q.ctes(*q.MART) + """
SELECT DISTINCT code, libelle FROM code_naf
WHERE code IN (SELECT activiteprincipaleunitelegale FROM mart WHERE activiteprincipaleunitelegale IS NOT NULL)""")
def labels_in_use(spark, sf):
    return J.labels_in_use(role(spark, sf, "code_naf"), _mart(spark, sf), "activiteprincipaleunitelegale")


# ---------------------------------------------------------------- aggregates
@register("distinct_keys", q.ctes("etablissements") +
          "SELECT DISTINCT siren FROM etablissements WHERE siren IS NOT NULL")
def distinct_keys(spark, sf):
    return A.distinct_keys(role(spark, sf, "etablissements"), "siren")


@register("distinct_rows", q.ctes(*q.MART) + "SELECT DISTINCT siren, activiteprincipaleunitelegale FROM mart")
def distinct_rows(spark, sf):
    return A.distinct_rows(_mart(spark, sf), ["siren", "activiteprincipaleunitelegale"])


@register("count_distinct", q.ctes("unite_legale") + "SELECT count(DISTINCT siren) AS n_distinct FROM unite_legale")
def count_distinct(spark, sf):
    return A.count_distinct(role(spark, sf, "unite_legale"), "siren")


@register("top_sectors", q.ctes(*q.MART) + f"""
, counts AS (
  SELECT activiteprincipaleunitelegale, count(*) AS nombre_etablissements FROM mart
  WHERE libellecommuneetablissement = '{PLACE}' AND activiteprincipaleunitelegale IS NOT NULL
  GROUP BY 1 ORDER BY nombre_etablissements DESC, activiteprincipaleunitelegale LIMIT 5
)
SELECT c.*, n.libelle AS secteur FROM counts c
LEFT JOIN code_naf n ON c.activiteprincipaleunitelegale IS NOT DISTINCT FROM n.code""")
def top_sectors(spark, sf):
    return dash.top_sectors(_scoped(spark, sf), role(spark, sf, "code_naf"), 5)


@register("top_labels", q.ctes("unite_legale", "code_naf") + """
SELECT n.libelle, count(*) AS nombre_entreprises
FROM unite_legale u LEFT JOIN code_naf n ON u.activiteprincipaleunitelegale IS NOT DISTINCT FROM n.code
WHERE n.libelle IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def top_labels(spark, sf):
    u = J.join_label_lookup(role(spark, sf, "unite_legale"), role(spark, sf, "code_naf"),
                            "activiteprincipaleunitelegale", "code", ["libelle"])
    return A.top_k_counts(u, "libelle", 10, out="nombre_entreprises")


@register("top_communes", q.ctes("etablissements") + """
SELECT libellecommuneetablissement, count(*) AS nombre_etablissements FROM etablissements
WHERE libellecommuneetablissement IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def top_communes(spark, sf):
    return A.top_k_counts(role(spark, sf, "etablissements"), "libellecommuneetablissement", 10,
                          out="nombre_etablissements")


@register("sum_by_sector_year", q.ctes(*q.MART, "donnees_financieres", _SECTOR_YEAR_ALL.strip()) +
          "SELECT * FROM per_year")
def sum_by_sector_year(spark, sf):
    return dash.sector_year_revenue(_mart(spark, sf), role(spark, sf, "donnees_financieres"))


@register("sector_revenue_history", q.ctes(*q.MART, "donnees_financieres") + f"""
, units AS (SELECT DISTINCT siren, activiteprincipaleunitelegale FROM mart
            WHERE libellecommuneetablissement = '{PLACE}' AND activiteprincipaleunitelegale = '{SECTOR}')
SELECT CAST(year(f.date_cloture_exercice) AS INTEGER) AS annee,
       coalesce({q.money_sum('f.chiffre_d_affaires')}, 0.0) AS chiffre_d_affaires
FROM units u LEFT JOIN donnees_financieres f ON u.siren = f.siren
WHERE f.date_cloture_exercice IS NOT NULL GROUP BY 1""")
def sector_revenue_history(spark, sf):
    return dash.sector_revenue_history(_scoped(spark, sf), role(spark, sf, "donnees_financieres"), SECTOR)


_CREATIONS = """cr AS (
  SELECT e.libellecommuneetablissement, CAST(year(u.datecreationunitelegale) AS INTEGER) AS annee_creation,
         count(DISTINCT e.siren) AS nombre_entreprises
  FROM etablissements e LEFT JOIN unite_legale u ON e.siren = u.siren
  WHERE e.libellecommuneetablissement IS NOT NULL AND u.datecreationunitelegale IS NOT NULL
  GROUP BY 1, 2
)"""


def _creations(spark, sf):
    e = role(spark, sf, "etablissements").select("libellecommuneetablissement", "siren")
    u = role(spark, sf, "unite_legale").select(
        "siren", S.year_of("datecreationunitelegale").alias("annee_creation"))
    df = J.join_left_parent(e, u, "siren", ["annee_creation"])
    df = A.count_distinct_by(df, ["libellecommuneetablissement", "annee_creation"], "siren", "nombre_entreprises")
    return FL.filter_min(df, "annee_creation", FIRST_RECENT_YEAR)


@register("creations_by_commune_year", q.ctes("etablissements", "unite_legale", _CREATIONS) +
          f"SELECT * FROM cr WHERE annee_creation >= {FIRST_RECENT_YEAR}")
def creations_by_commune_year(spark, sf):
    return _creations(spark, sf)


PLACES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@register("pivot_creations", q.ctes("etablissements", "unite_legale", _CREATIONS) + "SELECT annee_creation, "
          + ", ".join(f"coalesce(max(CASE WHEN libellecommuneetablissement = '{p}' THEN nombre_entreprises END), 0)"
                      f" AS \"{'ST. ' + p if p == PLACES[0] else p}\"" for p in PLACES[:-1])
          + f", count(*) FILTER (libellecommuneetablissement = '{PLACES[-1]}') AS unlisted"
          + f" FROM cr WHERE annee_creation >= {FIRST_RECENT_YEAR} GROUP BY annee_creation")
def pivot_creations(spark, sf):
    dotted = F.when(F.col("libellecommuneetablissement") == PLACES[0], "ST. " + PLACES[0]).otherwise(F.col("libellecommuneetablissement"))
    df = _creations(spark, sf).withColumn("libellecommuneetablissement", dotted)
    return A.pivot_wide(df, "annee_creation", "libellecommuneetablissement", "nombre_entreprises",
                        ["ST. " + PLACES[0], *PLACES[1:-1]], unlisted="unlisted")


@register("mean_by_category", q.ctes("etablissements", "unite_legale", "donnees_financieres") + f"""
SELECT u.categorieentreprise, {q.money_mean('f.chiffre_d_affaires')} AS chiffre_d_affaires
FROM etablissements e
LEFT JOIN unite_legale u ON e.siren = u.siren
LEFT JOIN donnees_financieres f ON e.siren = f.siren
WHERE f.chiffre_d_affaires IS NOT NULL AND u.categorieentreprise IS NOT NULL
GROUP BY 1""")
def mean_by_category(spark, sf):
    from .plans.exploration import mean_revenue_by_category
    return mean_revenue_by_category(role(spark, sf, "etablissements"), role(spark, sf, "unite_legale"),
                                    role(spark, sf, "donnees_financieres"))


@register("mean_top_labels", q.ctes("donnees_financieres", "unite_legale", "code_naf") + f"""
, df AS (
  SELECT CAST(year(f.date_cloture_exercice) AS INTEGER) AS annee, n.libelle, f.chiffre_d_affaires
  FROM donnees_financieres f LEFT JOIN unite_legale u ON f.siren = u.siren
  LEFT JOIN code_naf n ON u.activiteprincipaleunitelegale IS NOT DISTINCT FROM n.code
),
means AS (SELECT annee, libelle, {q.money_mean('chiffre_d_affaires')} AS ca_moyen FROM df
          WHERE annee IS NOT NULL AND libelle IS NOT NULL GROUP BY 1, 2),
cand AS (SELECT l.libelle, coalesce(m.ca_moyen, 0.0) AS v FROM (SELECT DISTINCT libelle FROM means) l
         LEFT JOIN means m ON m.libelle = l.libelle AND m.annee = (SELECT max(annee) FROM means)),
top AS (SELECT libelle FROM cand ORDER BY v DESC, libelle LIMIT 10),
years AS (SELECT DISTINCT annee FROM means)
SELECT y.annee, t.libelle, coalesce(m.ca_moyen, 0.0) AS ca_moyen
FROM years y CROSS JOIN top t LEFT JOIN means m ON m.annee = y.annee AND m.libelle = t.libelle""")
def mean_top_labels(spark, sf):
    from .plans.exploration import mean_revenue_top_labels
    return mean_revenue_top_labels(role(spark, sf, "donnees_financieres"), role(spark, sf, "unite_legale"),
                                   role(spark, sf, "code_naf"))


@register("revenue_by_commune", q.ctes("etablissements", "donnees_financieres") + f"""
SELECT e.libellecommuneetablissement, coalesce({q.money_sum('f.chiffre_d_affaires')}, 0.0) AS chiffre_d_affaires
FROM etablissements e LEFT JOIN donnees_financieres f ON e.siren = f.siren
WHERE e.libellecommuneetablissement IS NOT NULL GROUP BY 1""")
def revenue_by_commune(spark, sf):
    return A.revenue_by_group(role(spark, sf, "etablissements"), role(spark, sf, "donnees_financieres"),
                              "libellecommuneetablissement")


@register("log_histogram", q.ctes("donnees_financieres") + """
, pos AS (SELECT chiffre_d_affaires AS v FROM donnees_financieres WHERE chiffre_d_affaires > 0),
b AS (SELECT log10(min(v)) AS lo, log10(max(v)) AS hi FROM pos),
binned AS (SELECT CAST(CASE WHEN b.hi > b.lo THEN least(48, floor((log10(v) - b.lo) / ((b.hi - b.lo) / 49)))
                       ELSE 0 END AS INTEGER) AS bin FROM pos, b),
counts AS (SELECT bin, count(*) AS n FROM binned GROUP BY bin),
grid AS (SELECT CAST(range AS INTEGER) AS bin FROM range(49))
SELECT g.bin, round(pow(10.0, b.lo + g.bin * ((b.hi - b.lo) / 49)), 6) AS lower,
       round(pow(10.0, b.lo + (g.bin + 1) * ((b.hi - b.lo) / 49)), 6) AS upper, coalesce(c.n, 0) AS n
FROM grid g CROSS JOIN b LEFT JOIN counts c ON c.bin = g.bin WHERE b.lo IS NOT NULL""")
def log_histogram(spark, sf):
    h = A.log_histogram(role(spark, sf, "donnees_financieres"), "chiffre_d_affaires", 50)
    return h.withColumns({"lower": F.round("lower", 6), "upper": F.round("upper", 6)})


_NN_COLS = [n for n, _ in ROLE_VIEWS["etablissements"].columns]


@register("non_null_counts", q.ctes("etablissements") + "SELECT "
          + ", ".join(f"count({c}) AS {c}" for c in _NN_COLS) + " FROM etablissements")
def non_null_counts(spark, sf):
    return A.non_null_counts(role(spark, sf, "etablissements"))


@register("row_count", q.ctes("etablissements") + "SELECT count(*) AS n_rows FROM etablissements")
def row_count(spark, sf):
    return A.row_count(role(spark, sf, "etablissements"))


@register("active_by_region", q.ctes("etablissements", "unite_legale", "regions") + """
SELECT r.libelle AS region, count(*) AS nombre_etablissements
FROM etablissements e LEFT JOIN unite_legale u ON e.siren = u.siren
LEFT JOIN regions r ON u.activiteprincipaleunitelegale IS NOT DISTINCT FROM r.code
WHERE e.etatadministratifetablissement = 'A' AND r.libelle IS NOT NULL GROUP BY 1""")
def active_by_region(spark, sf):
    from .plans.exploration import active_by_region as plan
    return plan(role(spark, sf, "etablissements"), role(spark, sf, "unite_legale"), role(spark, sf, "regions"))


@register("creations_by_year", q.ctes("unite_legale") + """
SELECT CAST(year(datecreationunitelegale) AS INTEGER) AS annee_creation, count(DISTINCT siren) AS nombre_entreprises
FROM unite_legale WHERE datecreationunitelegale IS NOT NULL GROUP BY 1""")
def creations_by_year(spark, sf):
    u = role(spark, sf, "unite_legale").withColumn("annee_creation", S.year_of("datecreationunitelegale"))
    return A.count_distinct_by(u, ["annee_creation"], "siren", "nombre_entreprises")


# ---------------------------------------------------------------- window, top-k, cards
@register("latest_per_key", q.ctes("donnees_financieres") + """
SELECT siren, date_cloture_exercice, chiffre_d_affaires, resultat_net FROM (
  SELECT *, row_number() OVER (PARTITION BY siren ORDER BY date_cloture_exercice DESC,
         chiffre_d_affaires DESC NULLS LAST, resultat_net DESC NULLS LAST) AS rn
  FROM donnees_financieres WHERE date_cloture_exercice IS NOT NULL) WHERE rn = 1""")
def latest_per_key(spark, sf):
    return latest_row(role(spark, sf, "donnees_financieres"), "siren", "date_cloture_exercice",
                             tiebreak=[F.col("chiffre_d_affaires").desc_nulls_last(),
                                       F.col("resultat_net").desc_nulls_last()])



@register("top_revenue_units", q.ctes(*q.MART, "donnees_financieres") + f"""
, scoped AS (SELECT * FROM mart WHERE libellecommuneetablissement = '{PLACE}'
             AND activiteprincipaleunitelegale = '{SECTOR}'),
units AS (SELECT siren, min(denominationunitelegale) AS denominationunitelegale FROM scoped GROUP BY siren),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY siren ORDER BY date_cloture_exercice DESC,
         chiffre_d_affaires DESC NULLS LAST, resultat_net DESC NULLS LAST) AS rn
  FROM donnees_financieres WHERE date_cloture_exercice IS NOT NULL AND siren IN (SELECT siren FROM units))
SELECT u.denominationunitelegale, u.siren, r.chiffre_d_affaires
FROM units u JOIN ranked r ON u.siren = r.siren AND r.rn = 1
ORDER BY r.chiffre_d_affaires DESC NULLS LAST, u.siren LIMIT 5""")
def top_revenue_units(spark, sf):
    return dash.top_revenue_units(_scoped(spark, sf, SECTOR), role(spark, sf, "donnees_financieres"), 5)


@register("financial_history", q.ctes(*q.MART, "donnees_financieres") + f"""
SELECT siren, date_cloture_exercice, chiffre_d_affaires, resultat_net FROM donnees_financieres
WHERE siren IN (SELECT siren FROM mart WHERE libellecommuneetablissement = '{PLACE}'
                AND activiteprincipaleunitelegale = '{SECTOR}')""")
def financial_history(spark, sf):
    from .plans.dashboard import financial_histories
    return financial_histories(_scoped(spark, sf, SECTOR), role(spark, sf, "donnees_financieres"))


_CARD_ADDR = ", ".join(f"CASE WHEN trim({p}) <> '' THEN {p} END" for p in ADDRESS_PARTS)


@register("establishment_card", q.ctes(*q.MART, "tranches_effectifs") + f"""
, firsts AS (SELECT *, row_number() OVER (PARTITION BY siren ORDER BY siret) AS rn FROM mart)
SELECT denominationunitelegale AS denomination, siren, coalesce(siret, 'N/A') AS siret,
       coalesce(categorieentreprise, 'N/A') AS categorie,
       coalesce(nullif(concat_ws(' ', {_CARD_ADDR}), ''), 'N/A') AS adresse,
       coalesce(CAST(anneeeffectifsetablissement AS VARCHAR), 'N/A') AS annee_effectif,
       coalesce(CAST(anneecategorieentreprise AS VARCHAR), 'N/A') AS annee_categorie,
       coalesce(t.libelle, 'N/A') AS tranche_effectif
FROM firsts f LEFT JOIN tranches_effectifs t ON f.trancheeffectifsetablissement IS NOT DISTINCT FROM t.code
WHERE rn = 1""")
def establishment_card(spark, sf):
    return dash.establishment_card(_mart(spark, sf), role(spark, sf, "tranches_effectifs"))


_MART_COLS = [n for n, _ in ROLE_VIEWS["etablissements"].columns] + [
    "activiteprincipaleunitelegale", "denominationunitelegale", "categorieentreprise",
    "anneecategorieentreprise", "libelle", "code"]


@register("dashboard_mart", q.ctes(*q.MART) + "SELECT " + ", ".join(_MART_COLS)
          + ", round(longitude, 6) AS longitude, round(latitude, 6) AS latitude FROM mart")
def dashboard_mart(spark, sf):
    m = _built_mart(spark, sf)
    return m.select(*_MART_COLS, F.round("longitude", 6).alias("longitude"),
                    F.round("latitude", 6).alias("latitude"))


from . import catalog_io  # noqa: E402,F401  (registers the I/O, pipeline and incremental queries)
from . import catalog_tables  # noqa: E402,F401  (registers the queries on stored tables)
