"""Catalogue part 2: sources, sinks, cleaning pipelines and incremental loads.

These queries have side effects: they land files derived from the driver tables in a
fresh folder of the shared working directory (``spark.checkpoint.dir``), run the
operator, and return the frame read back from what was written, so the oracle still
compares values. Every run uses its own folder; nothing is shared between runs.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from . import oracle_sql as q
from .catalog import TARGET_PLACES, register
from .fixed import LEGAL_UNIT_COLUMNS, RATIO_COLUMNS
from .operators.project import project_reindex
from .plans import cleaning as X
from .plans.exploration import region_table
from .roles import ROLE_VIEWS, role, table
from .session import run_dir
from .sources import files, json, sinks
from .streaming import incremental as I


# ---------------------------------------------------------------- file sources / sinks


# texts that a CSV file must carry: a line break with quotes, a backslash, an empty text
AWKWARD = """CASE right({key}, 1) WHEN '1' THEN concat('a', chr(10), '"b", c')
  WHEN '2' THEN concat('back', chr(92), 'slash') WHEN '3' THEN '' ELSE {col} END"""


def _awkward_sql(col: str, key: str) -> str:
    return AWKWARD.format(col=col, key=key)


def _awkward(df: DataFrame, col: str, key: str) -> DataFrame:
    """The frame with awkward texts in some rows of a column."""
    return df.withColumn(col, F.expr(_awkward_sql(col, key)))


@register("scan_csv_typed", q.ctes("etablissements") + f"""SELECT * REPLACE (
  {_awkward_sql('complementadresseetablissement', 'siret')} AS complementadresseetablissement) FROM etablissements""")
def scan_csv_typed(spark: SparkSession, sf: str) -> DataFrame:
    """S3 (+K1): the clean establishments through a CSV file and back, with a declared
    schema: identifiers keep their leading zeros, dates and doubles are typed."""
    src = _awkward(role(spark, sf, "etablissements"), "complementadresseetablissement", "siret")
    path = run_dir(spark, "scan_csv_typed")
    files.write_csv(src, path)
    return files.read_csv_typed(spark, path, src.schema)


@register("sink_csv", q.ctes("donnees_financieres") + "SELECT * FROM donnees_financieres")
def sink_csv(spark: SparkSession, sf: str) -> DataFrame:
    """K1: accounts written as CSV (header, overwrite — written twice) and read back."""
    src = role(spark, sf, "donnees_financieres")
    path = run_dir(spark, "sink_csv")
    files.write_csv(src, path)
    files.write_csv(src, path)  # overwrite, not append
    return files.read_csv_typed(spark, path, src.schema)


@register("scan_labels", q.ctes("code_naf") + f"SELECT code, {_awkward_sql('libelle', 'code')} AS libelle FROM code_naf")
def scan_labels(spark: SparkSession, sf: str) -> DataFrame:
    """A ``code;label`` dictionary in Latin-1 read back as text columns."""
    path = run_dir(spark, "scan_labels")
    files.write_labels(_awkward(role(spark, sf, "code_naf"), "libelle", "code"), path)
    return files.read_labels(spark, path)


def _nested_establishments(raw: DataFrame) -> DataFrame:
    """Register-API-shaped establishment records: address in a struct, status in an
    array of periods (current period first or second; the previous one has an end date)."""
    cur = F.struct(F.lit(None).cast("string").alias("dateFin"),
                   F.col("etatAdministratifEtablissement"),
                   F.col("dateCreationEtablissement").alias("dateDebut"))
    prev = F.struct(F.col("dateCreationEtablissement").alias("dateFin"),
                    F.when(F.col("etatAdministratifEtablissement") == "A", "F").otherwise("A")
                    .alias("etatAdministratifEtablissement"),
                    F.lit("1990-01-01").alias("dateDebut"))
    key = F.col("siret").cast("long")
    return raw.select(
        "siret", "siren", "dateCreationEtablissement", "trancheEffectifsEtablissement",
        "anneeEffectifsEtablissement",
        F.struct(
            "complementAdresseEtablissement", "numeroVoieEtablissement", "typeVoieEtablissement",
            "libelleVoieEtablissement", "codePostalEtablissement", "libelleCommuneEtablissement",
            "coordonneeLambertAbscisseEtablissement", "coordonneeLambertOrdonneeEtablissement",
        ).alias("adresseEtablissement"),
        F.when(key % 2 == 0, F.array(prev, cur)).otherwise(F.array(cur, prev)).alias("periodesEtablissement"),
    )


def _envelope(records: DataFrame, field: str) -> StructType:
    return StructType().add("total", LongType()).add(field, ArrayType(records.schema))



# Schema of the place features the GeoJSON queries land (declared: no inference pass).
GEO_SCHEMA = (
    "type string, features array<struct<type: string, properties: struct<feature_id: bigint, nom: string>, "
    "geometry: struct<type: string, coordinates: array<double>>>>"
)


@register("scan_json_pages", q.ctes("etablissements_raw") + """
SELECT 'record' AS kind, siret, siren, codePostalEtablissement AS codepostaletablissement,
       libelleCommuneEtablissement AS libellecommuneetablissement, etatAdministratifEtablissement AS etat
FROM etablissements_raw UNION ALL SELECT 'malformed', NULL, NULL, NULL, NULL, NULL""")
def scan_json_pages(spark: SparkSession, sf: str) -> DataFrame:
    """All establishments landed as pages of 100 records (JSON envelopes), plus the
    envelope an API returns when paging past the end (a total, no records array) and a page
    that was cut off in transfer → one row per record, and one per page set aside."""
    recs = _nested_establishments(role(spark, sf, "etablissements_raw"))
    path = run_dir(spark, "scan_json_pages")
    page = F.floor(F.col("siret").cast("long") / 100)
    json.write_pages(recs, path, "etablissements", page)
    recs.agg(F.count(F.lit(1)).alias("total")).write.mode("append").json(path)  # past-the-end page
    one = recs.limit(1).select(F.to_json(F.struct(F.array(F.struct(*recs.columns)).alias("etablissements"))).alias("value"))
    one.select(F.expr("substring(value, 1, length(value) - 20)")).write.mode("append").text(path)  # a truncated page
    aside = run_dir(spark, "scan_json_pages")
    out = json.read_pages(spark, path, _envelope(recs, "etablissements"), "etablissements", quarantine=aside)
    out = out.withColumn("etat", F.element_at(
        F.filter("periodesEtablissement", lambda p: p["dateFin"].isNull()), 1)["etatAdministratifEtablissement"])
    records = project_reindex(out.withColumn("kind", F.lit("record")), {
        "kind": "kind", "siret": "siret", "siren": "siren",
        "codepostaletablissement": "adresseEtablissement.codePostalEtablissement",
        "libellecommuneetablissement": "adresseEtablissement.libelleCommuneEtablissement",
        "etat": "etat",
    })
    lost = json.quarantined(spark, aside).select(F.lit("malformed").alias("kind"))
    return records.unionByName(lost, allowMissingColumns=True)


@register("scan_geojson", q.ctes("communes_geo") + "SELECT feature_id, nom, lon, lat FROM communes_geo")
def scan_geojson(spark: SparkSession, sf: str) -> DataFrame:
    """Place features written as GeoJSON FeatureCollections and read back, one row per
    feature with its properties and point coordinates."""
    path = run_dir(spark, "scan_geojson")
    json.write_geojson(role(spark, sf, "communes_geo"), path, ["feature_id", "nom"], "lon", "lat",
                       F.floor(F.col("feature_id") / 100))
    feats = json.read_geojson(spark, path, multi_line=False, schema=GEO_SCHEMA)
    return feats.select(F.col("feature_id").cast("long").alias("feature_id"), "nom",
                        F.col("geometry.coordinates")[0].alias("lon"), F.col("geometry.coordinates")[1].alias("lat"))


@register("region_metric", q.ctes("etablissements", "communes_geo") + f"""
, counts AS (SELECT {q.normalize_place_sql('libellecommuneetablissement')} AS commune, count(*) AS n
             FROM etablissements WHERE libellecommuneetablissement IS NOT NULL GROUP BY 1)
SELECT g.feature_id, {q.normalize_place_sql('g.nom')} AS nom, coalesce(c.n, 0) AS nb_entreprises
FROM communes_geo g LEFT JOIN counts c ON {q.normalize_place_sql('g.nom')} = c.commune""")
def region_metric(spark: SparkSession, sf: str) -> DataFrame:
    """X12 (S6 → C7 → A4 → J10): region features from a GeoJSON file with the number of
    establishments of each, names normalised on both sides; features without any get 0."""
    path = run_dir(spark, "region_metric")
    json.write_geojson(role(spark, sf, "communes_geo"), path, ["feature_id", "nom"], "lon", "lat",
                       F.floor(F.col("feature_id") / 100))
    feats = json.read_geojson(spark, path, multi_line=False, schema=GEO_SCHEMA).select(
        F.col("feature_id").cast("long").alias("feature_id"), "nom")
    return region_table(feats, role(spark, sf, "etablissements"))


@register("sink_keyed_append", q.ctes("donnees_financieres") + "SELECT DISTINCT * FROM donnees_financieres")
def sink_keyed_append(spark: SparkSession, sf: str) -> DataFrame:
    """K2: an empty first batch, then two overlapping appends (a rerun, and new rows), into a table
    partitioned by the closing year (null for accounts without a date) → every account once.
    Keys: the whole account row."""
    fin = role(spark, sf, "donnees_financieres")
    keys = fin.columns
    path = run_dir(spark, "sink_keyed_append")
    fin = fin.withColumn("annee", F.year("date_cloture_exercice"))
    early = F.coalesce(F.col("date_cloture_exercice") < F.lit(dt.date(1998, 1, 1)), F.lit(True))
    for batch in (fin.limit(0), fin.where(early), fin.where(early), fin):  # nothing; new; a rerun; overlap and the rest
        sinks.append_new(batch, path, keys, partition_col="annee")
    return sinks.read_table(spark, path, fin.schema).select(*keys)


@register("sink_replace", q.ctes("unite_legale") + "SELECT * FROM unite_legale WHERE categorieentreprise <> 'BUILDING'")
def sink_replace(spark: SparkSession, sf: str) -> DataFrame:
    """K3: a table written, then replaced by a different content."""
    ul = role(spark, sf, "unite_legale")
    path = run_dir(spark, "sink_replace")
    sinks.replace_table(ul, path)
    sinks.replace_table(ul.where(F.col("categorieentreprise") != "BUILDING"), path)
    return sinks.read_published(spark, path, "data")


@register("sink_two_tables", q.ctes("etablissements", "unite_legale") + """
SELECT u.siren, u.denominationunitelegale, count(e.siret) AS n_etablissements
FROM unite_legale u LEFT JOIN etablissements e ON e.siren = u.siren GROUP BY 1, 2""")
def sink_two_tables(spark: SparkSession, sf: str) -> DataFrame:
    """K4: establishments and legal units published as one version with an explicit column
    order, then read back through the commit log (both or neither are visible)."""
    root = run_dir(spark, "sink_two_tables")
    sinks.publish_together(
        {"etablissements": role(spark, sf, "etablissements"), "unite_legale": role(spark, sf, "unite_legale")},
        root,
        columns={"etablissements": ["siret", "siren"], "unite_legale": ["siren", "denominationunitelegale"]},
    )
    e = sinks.read_published(spark, root, "etablissements")
    u = sinks.read_published(spark, root, "unite_legale")
    n = e.groupBy("siren").agg(F.count("siret").alias("n_etablissements"))
    return u.join(n, "siren", "left").select(
        "siren", "denominationunitelegale",
        F.coalesce(F.col("n_etablissements"), F.lit(0).cast("bigint")).alias("n_etablissements"))


@register("write_row_count", q.ctes("etablissements") + "SELECT count(*) AS rows_written FROM etablissements")
def write_row_count(spark: SparkSession, sf: str) -> DataFrame:
    """K5: rows written, observed during the write (no second pass over the input)."""
    path = run_dir(spark, "write_row_count")
    n = sinks.write_counted(role(spark, sf, "etablissements"), lambda d: d.write.parquet(path))
    return spark.createDataFrame([(n,)], "rows_written long")


# ---------------------------------------------------------------- cleaning pipelines
_X1_SQL = f"""x1 AS (
  SELECT siret, siren, etatAdministratifEtablissement AS etatadministratifetablissement,
         try_cast(dateCreationEtablissement AS DATE) AS datecreationetablissement,
         trancheEffectifsEtablissement AS trancheeffectifsetablissement,
         anneeEffectifsEtablissement AS anneeeffectifsetablissement,
         complementAdresseEtablissement AS complementadresseetablissement,
         numeroVoieEtablissement AS numerovoieetablissement, typeVoieEtablissement AS typevoieetablissement,
         libelleVoieEtablissement AS libellevoieetablissement,
         CASE WHEN length(codePostalEtablissement) = 5 THEN codePostalEtablissement END AS codepostaletablissement,
         libelleCommuneEtablissement AS libellecommuneetablissement,
         try_cast(coordonneeLambertAbscisseEtablissement AS DOUBLE) AS coordonneelambertabscisseetablissement,
         try_cast(coordonneeLambertOrdonneeEtablissement AS DOUBLE) AS coordonneelambertordonneeetablissement
  FROM etablissements_raw
  WHERE etatAdministratifEtablissement = 'A' AND libelleCommuneEtablissement IN {TARGET_PLACES!r}
    AND siret IS NOT NULL AND siren IS NOT NULL
)"""
_X2_SQL = """x2 AS (
  SELECT siren, denominationUniteLegale AS denominationunitelegale,
         try_cast(dateCreationUniteLegale AS DATE) AS datecreationunitelegale,
         activitePrincipaleUniteLegale AS activiteprincipaleunitelegale, categorieEntreprise AS categorieentreprise,
         anneeCategorieEntreprise AS anneecategorieentreprise,
         trancheEffectifsUniteLegale AS trancheeffectifsunitelegale,
         anneeEffectifsUniteLegale AS anneeeffectifsunitelegale,
         etatAdministratifUniteLegale AS etatadministratifunitelegale
  FROM unite_legale_raw
  WHERE etatAdministratifUniteLegale = 'A' AND siren IN (SELECT siren FROM x1) AND siren IS NOT NULL
)"""
_X3_SQL = """x3 AS (
  SELECT siren, try_cast(date_cloture_exercice AS DATE) AS date_cloture_exercice,
         try_cast(chiffre_d_affaires AS DOUBLE) AS chiffre_d_affaires,
         try_cast(resultat_net AS DOUBLE) AS resultat_net
  FROM donnees_financieres_raw WHERE siren IN (SELECT siren FROM x1) AND siren IS NOT NULL
)"""
_X123 = q.ctes("etablissements_raw", "unite_legale_raw", "donnees_financieres_raw", _X1_SQL, _X2_SQL, _X3_SQL)


def _raw(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (role(spark, sf, "etablissements_raw"), role(spark, sf, "unite_legale_raw"),
            role(spark, sf, "donnees_financieres_raw"))


@register("clean_establishments", _X123 + "SELECT * FROM x1")
def clean_establishments(spark: SparkSession, sf: str) -> DataFrame:
    return X.clean_establishments(_raw(spark, sf)[0], TARGET_PLACES)


@register("clean_legal_units", _X123 + "SELECT * FROM x2")
def clean_legal_units(spark: SparkSession, sf: str) -> DataFrame:
    e, u, _ = _raw(spark, sf)
    return X.clean_legal_units(u, X.clean_establishments(e, TARGET_PLACES))


@register("clean_financials", _X123 + "SELECT * FROM x3")
def clean_financials(spark: SparkSession, sf: str) -> DataFrame:
    e, _, f = _raw(spark, sf)
    return X.clean_financials(f, X.clean_establishments(e, TARGET_PLACES))


_TARGETS = ("etablissements", "unite_legale", "donnees_financieres")


def _all_targets(spark: SparkSession, root: str) -> DataFrame:
    """The rows of the three target tables as one frame: a table name and the columns of each."""
    parts = [spark.read.parquet(f"{root}/{t}").drop("annee_cloture").withColumn("table_name", F.lit(t)) for t in _TARGETS]
    return parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)


@register("run_clean_pipeline", _X123 + """
SELECT 'etablissements' AS table_name, * FROM x1
UNION ALL BY NAME SELECT 'unite_legale' AS table_name, * FROM x2
UNION ALL BY NAME SELECT DISTINCT 'donnees_financieres' AS table_name, * FROM x3""")
def run_clean_pipeline(spark: SparkSession, sf: str) -> DataFrame:
    """The whole clean-and-insert run into fresh target tables, run twice (the rerun
    must add nothing); returns the rows of the three target tables, read back."""
    root = run_dir(spark, "run_clean_pipeline")
    for _ in range(2):
        X.run_clean_pipeline(*_raw(spark, sf), root, TARGET_PLACES)
    return _all_targets(spark, root)


@register("monthly_staging", q.ctes("etablissements_raw", "unite_legale_raw", "donnees_financieres_raw") + """
SELECT 'etablissements' AS table_name, siret, siren, etatAdministratifEtablissement, dateCreationEtablissement, trancheEffectifsEtablissement,
       CAST(anneeEffectifsEtablissement AS VARCHAR) AS anneeEffectifsEtablissement,
       complementAdresseEtablissement, numeroVoieEtablissement, typeVoieEtablissement, libelleVoieEtablissement,
       codePostalEtablissement, libelleCommuneEtablissement,
       try_cast(coordonneeLambertAbscisseEtablissement AS DOUBLE) AS coordonneeLambertAbscisseEtablissement,
       try_cast(coordonneeLambertOrdonneeEtablissement AS DOUBLE) AS coordonneeLambertOrdonneeEtablissement
FROM etablissements_raw
WHERE etatAdministratifEtablissement = 'A' AND codePostalEtablissement IS NOT NULL
  AND length(codePostalEtablissement) <= 5
  AND try_cast(coordonneeLambertAbscisseEtablissement AS DOUBLE) IS NOT NULL
  AND try_cast(coordonneeLambertOrdonneeEtablissement AS DOUBLE) IS NOT NULL
UNION ALL BY NAME SELECT 'unite_legale' AS table_name, """ + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in LEGAL_UNIT_COLUMNS) + """
FROM unite_legale_raw WHERE etatAdministratifUniteLegale = 'A'
UNION ALL BY NAME SELECT DISTINCT 'donnees_financieres' AS table_name, siren, date_cloture_exercice,
  try_cast(chiffre_d_affaires AS DOUBLE) AS chiffre_d_affaires, try_cast(resultat_net AS DOUBLE) AS resultat_net
FROM donnees_financieres_raw WHERE try_cast(chiffre_d_affaires AS DOUBLE) >= 0""")
def monthly_staging(spark: SparkSession, sf: str) -> DataFrame:
    """Extract → staging → clean → staging → keyed append; returns the rows of the three
    target tables, read back."""
    root = run_dir(spark, "monthly_staging")
    X.monthly_staging(*_raw(spark, sf), f"{root}/staging", f"{root}/target")
    return _all_targets(spark, f"{root}/target")


@register("merge_ratios", q.ctes("ratios", "unite_legale_raw") + "SELECT "
          + ", ".join(("r." if i < 12 else "u.") + c for i, c in enumerate(RATIO_COLUMNS))
          + " FROM ratios r JOIN unite_legale_raw u ON r.siren = u.siren")
def merge_ratios(spark: SparkSession, sf: str) -> DataFrame:
    """X11: ratio records (paged ``results``) and unit records (single ``uniteLegale``
    objects) landed as JSON → inner join on the unit key → the 16 chosen columns → table
    replaced; returns the table read back."""
    from .plans.exploration import merge_ratio_records
    root = run_dir(spark, "merge_ratios")
    ratios = role(spark, sf, "ratios")
    units = role(spark, sf, "unite_legale_raw")
    json.write_pages(ratios, f"{root}/landing/ratios", "results", F.col("page"), exclude=["page"])
    units.select(F.struct(*units.columns).alias("uniteLegale")).write.json(f"{root}/landing/units")
    merge_ratio_records(
        spark, f"{root}/landing/ratios", _envelope(ratios.drop("page"), "results"),
        f"{root}/landing/units", StructType().add("uniteLegale", units.schema),
        f"{root}/entreprise", RATIO_COLUMNS,
    )
    return sinks.read_published(spark, f"{root}/entreprise", "data")


# ---------------------------------------------------------------- incremental
_LOST_TS = "CASE WHEN event_id % 53 = 7 THEN NULL ELSE ts END"
EVENT_COLS = ("event_id", "ts", "user_id", "event_type", "value")
DAY_CUT, DAY_OVERLAP = dt.datetime(2024, 1, 20), dt.datetime(2024, 1, 15)
FIRST_MARK = dt.datetime(2024, 1, 1)


FUTURE = dt.datetime(2099, 1, 1)
LATE = "event_id % 97 = 5"  # events of the overlap that arrive on the second day only


@register("incremental_batch", f"""SELECT {', '.join(EVENT_COLS)} FROM events WHERE ts >= TIMESTAMP '{FIRST_MARK}'
UNION ALL SELECT -1, TIMESTAMP '{FUTURE}', 0, 'future', 0.0""")
def incremental_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Two daily runs over the event source (day 1 sees events before the 20th, day 2
    those from the 15th: an overlap) with a mark on ``ts`` and ``event_id`` as key; plus a
    rerun of day 2 (as after a failure before the mark write). Day 1 also holds an event dated far
    in the future, which must not hide day 2, and lacks some events of the overlap, which
    arrive late. Every event lands once."""
    ev = table(spark, sf, "events").select(*EVENT_COLS)
    future = ev.limit(1).select(F.lit(-1).alias("event_id"), F.lit(FUTURE).cast(ev.schema["ts"].dataType).alias("ts"),
                                F.lit(0).alias("user_id"), F.lit("future").alias("event_type"), F.lit(0.0).alias("value"))
    late = F.expr(LATE) & (F.col("ts") >= F.lit(DAY_OVERLAP))
    first = ev.where((F.col("ts") < F.lit(DAY_CUT)) & ~late).unionByName(future)
    runs = [(first, DAY_CUT)] + [(ev.where(F.col("ts") >= F.lit(DAY_OVERLAP)), dt.datetime(2024, 12, 31))] * 2
    root = run_dir(spark, "incremental_batch")
    day = ("day", F.to_date("ts"))
    for source, limit in runs:
        I.incremental_batch(source, f"{root}/t", f"{root}/s", ["event_id"], "ts", FIRST_MARK, partition=day,
                            limit=limit, overlap=DAY_CUT - DAY_OVERLAP)
    return spark.read.parquet(f"{root}/t").drop("day")


@register("incremental_stream", f"""SELECT event_id, {_LOST_TS} AS ts, user_id, event_type, value FROM events
UNION ALL SELECT NULL, NULL, NULL, 'malformed page', NULL""")
def incremental_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Event pages land in a folder on two days (overlapping); a Structured Streaming
    run after each landing picks up only the new files and appends unseen events. Some events
    have lost their time (the null partition of the target); one page was cut off."""
    ev = table(spark, sf, "events").select(*EVENT_COLS)
    lost = ev.withColumn("ts", F.expr(_LOST_TS))
    root = run_dir(spark, "incremental_stream")
    env = _envelope(ev, "records")
    page = F.floor(F.col("event_id") / 100)
    day = ("day", F.to_date("ts"))
    for when in (F.col("ts") < F.lit(DAY_CUT), F.col("ts") >= F.lit(DAY_OVERLAP)):
        ids = ev.where(when).select("event_id")
        json.write_pages(lost.join(ids, "event_id", "left_semi"), f"{root}/landing", "records", page, mode="append")
        if I.table_exists(spark, f"{root}/t"):
            cut = ev.limit(1).select(F.lit('{"total": 1, "records": [{"event_id": 1, "ts"').alias("value"))
            cut.write.mode("append").text(f"{root}/landing")
        I.incremental_stream(spark, f"{root}/landing", env, "records", f"{root}/t", f"{root}/ckpt", ["event_id"],
                             partition=day, quarantine=f"{root}/aside")
    aside = I.quarantined_stream(spark, f"{root}/aside").select(F.lit("malformed page").alias("event_type"))
    return spark.read.parquet(f"{root}/t").drop("day").unionByName(aside, allowMissingColumns=True)


DAILY_MARK = dt.date(1995, 1, 1)
DAILY_RUNS = {"d1": dt.date(1998, 1, 1), "d2": dt.date(1999, 1, 1)}
DAILY_CUT, DAILY_OVERLAP = "1998-01-01", "1997-07-01"


@register("daily_incremental", q.ctes("etablissements_raw", "unite_legale_raw") + "SELECT "
          + ", ".join(
              "try_cast(dateCreationEtablissement AS DATE) AS datecreationetablissement"
              if k == "datecreationetablissement" else f"e.{p.split('.')[-1]} AS {k}"
              for k, p in I.ESTABLISHMENT_FIELDS.items())
          + ", " + ", ".join(
              "try_cast(u.dateCreationUniteLegale AS DATE) AS datecreationunitelegale" if k == "datecreationunitelegale"
              else f"u.{p} AS {k}"
              for k, p in I.LEGAL_UNIT_FIELDS.items() if k not in ("siren", "nomenclatureactiviteprincipaleunitelegale"))
          + f""", u.siren IS NOT NULL AS has_unit FROM etablissements_raw e LEFT JOIN unite_legale_raw u ON u.siren = e.siren
WHERE e.etatAdministratifEtablissement = 'A' AND try_cast(e.dateCreationEtablissement AS DATE) >= DATE '{DAILY_MARK}'""")
def daily_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Two days of establishment pages (day 1: created before 1998, day 2: created
    from mid-1997 or without a readable date — overlapping) and the matching unit records; each
    day's run keeps active establishments created since the mark and their units, both
    committed together. Returns the establishments with their loaded unit."""
    root = run_dir(spark, "daily_incremental")
    run_daily_days(spark, sf, root)
    e, u = (sinks.read_published(spark, f"{root}/target", t, all_versions=True) for t in ("etablissements", "unite_legale"))
    u = u.drop("nomenclatureactiviteprincipaleunitelegale").withColumn("has_unit", F.lit(True))
    return e.join(u, "siren", "left").withColumn("has_unit", F.coalesce("has_unit", F.lit(False)))


def run_daily_days(spark: SparkSession, sf: str, root: str) -> list[dict[str, int]]:
    """Land two overlapping days of pages under ``root/landing`` and run X6 for each day
    into ``root/target``; returns each day's counts."""
    raw = role(spark, sf, "etablissements_raw")
    recs = _nested_establishments(raw)
    units = role(spark, sf, "unite_legale_raw")
    page = F.floor(F.col("siret").cast("long") / 100)
    created = F.col("dateCreationEtablissement")
    days = {"d1": created < F.lit(DAILY_CUT), "d2": created >= F.lit(DAILY_OVERLAP)}  # "bad" too
    env_e = _envelope(recs, "etablissements")
    env_u = StructType().add("unitesLegales", ArrayType(units.schema)).add("uniteLegale", units.schema)
    counts = []
    for day, cond in days.items():
        day_recs = recs.where(cond)
        json.write_pages(day_recs, f"{root}/landing/{day}/etablissements", "etablissements", page)
        # the unit lookup of the day: the units of that day's establishments, half of them
        # delivered in batches, half as single records
        day_units = units.join(day_recs.select("siren").distinct(), "siren", "left_semi")
        even = F.substring("siren", -1, 1).isin("0", "2", "4", "6", "8")
        batched = day_units.where(even)
        # a batch = the keys sharing all but their last two characters (at most 100 keys)
        json.write_pages(batched, f"{root}/landing/{day}/units", "unitesLegales",
                         F.expr("substring(siren, 1, length(siren) - 2)"), with_total=False)
        (day_units.where(~even)
         .select(F.struct(*units.columns).alias("uniteLegale"))
         .write.mode("append").options(**json.LANDED_OPTIONS).json(f"{root}/landing/{day}/units"))
        counts.append(I.daily_incremental(
            spark, f"{root}/landing/{day}/etablissements", f"{root}/landing/{day}/units", env_e, env_u, f"{root}/target",
            DAILY_MARK, run_date=DAILY_RUNS[day], overlap_days=200))
    return counts

