"""Catalogue part 3: what keeps stored tables right and cheap over many runs — quarantines, rejects, files that many
tasks share, key indexes, versions. As in part 2, every run lands its own files and returns what is read back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle_sql as q
from .catalog import _MART_COLS, register
from .catalog_io import EVENT_COLS, GEO_SCHEMA, _envelope, _nested_establishments
from .plans.dashboard import C, dashboard_mart
from .plans.mart import read_fresh_mart, refresh_mart
from .plans.sector_sums import add_increment, sector_sums
from .roles import role, table
from .session import run_dir
from .sources import files, json, sinks, versions

PAGE = "cast(floor(cast(siret as bigint) / 100) as bigint)"


@register("quarantine_pages", q.ctes("etablissements_raw") + f"""
SELECT 'record' AS kind, siret, CAST(NULL AS BIGINT) AS page FROM etablissements_raw WHERE {PAGE} % 7 <> 3
UNION ALL SELECT DISTINCT 'malformed', NULL, {PAGE} FROM etablissements_raw WHERE {PAGE} % 7 = 3
UNION ALL SELECT 'rejected by each run', NULL, count(DISTINCT {PAGE}) FROM etablissements_raw WHERE {PAGE} % 7 = 3
UNION ALL SELECT 'rejected by each run', NULL, count(DISTINCT {PAGE}) FROM etablissements_raw WHERE {PAGE} % 7 = 3""")
def quarantine_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages of establishments, every seventh with a text for its total, a field that nobody uses. Such a page is set
    aside whole, and once, though it is read by two runs; each run counts its own."""
    recs = _nested_establishments(role(spark, sf, "etablissements_raw"))
    path, aside = run_dir(spark, "quarantine_pages"), run_dir(spark, "quarantine_pages")
    page = F.expr(PAGE)
    json.write_pages(recs.where(page % 7 != 3), path, "etablissements", page)
    faulty = recs.where(page % 7 == 3).groupBy(page.alias("p")).agg(F.collect_list(F.struct(*recs.columns)).alias("etablissements"))
    faulty.select(F.lit("many").alias("total"), "etablissements").write.mode("append").options(**json.LANDED_OPTIONS).json(path)
    runs = [json.parse_pages(spark, path, _envelope(recs, "etablissements"), quarantine=aside) for _ in range(2)]
    records = runs[1].records("etablissements").select(F.lit("record").alias("kind"), "siret")
    lost = json.quarantined(spark, aside).select(
        F.lit("malformed").alias("kind"), F.floor(F.get_json_object("document", "$.etablissements[0].siret").cast("long") / 100).alias("page")
    )
    counts = spark.createDataFrame([("rejected by each run", r.rejected) for r in runs], "kind string, page long")
    return records.unionByName(lost, allowMissingColumns=True).unionByName(counts, allowMissingColumns=True)


_BAD_ACCOUNT = """(date_cloture_exercice IS NOT NULL AND try_cast(date_cloture_exercice AS DATE) IS NULL
  OR resultat_net IS NOT NULL AND try_cast(resultat_net AS DOUBLE) IS NULL)"""


@register("scan_csv_rejects", q.ctes("donnees_financieres_raw") + f"""
SELECT 'record' AS kind, siren, try_cast(date_cloture_exercice AS DATE) AS date_cloture_exercice,
  try_cast(chiffre_d_affaires AS DOUBLE) AS chiffre_d_affaires, try_cast(resultat_net AS DOUBLE) AS resultat_net
FROM donnees_financieres_raw WHERE NOT {_BAD_ACCOUNT}
UNION ALL SELECT 'rejected', siren, NULL, NULL, NULL FROM (
  SELECT DISTINCT siren, date_cloture_exercice, chiffre_d_affaires, resultat_net FROM donnees_financieres_raw WHERE {_BAD_ACCOUNT})""")
def scan_csv_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """S3: raw accounts as CSV, read with dates and amounts declared: records with a value that is none are set aside,
    each once, and not loaded with nulls."""
    raw = role(spark, sf, "donnees_financieres_raw")
    path, lost = run_dir(spark, "scan_csv_rejects"), run_dir(spark, "scan_csv_rejects")
    files.write_csv(raw, path)
    schema = "siren string, date_cloture_exercice date, chiffre_d_affaires double, resultat_net double"
    rows = files.read_csv_typed(spark, path, schema, rejects=lost).select(F.lit("record").alias("kind"), "*")
    rejected = files.rejected_records(spark, lost).select(F.lit("rejected").alias("kind"), F.split("record", ",")[0].alias("siren"))
    return rows.unionByName(rejected, allowMissingColumns=True)


@register("scan_geojson_document", q.ctes("communes_geo") + "SELECT feature_id, nom, lon, lat FROM communes_geo")
def scan_geojson_document(spark: SparkSession, sf: str) -> DataFrame:
    """Pretty-printed documents of a thousand features, each document one file, read feature by feature."""
    geo = role(spark, sf, "communes_geo").withColumn("document", F.floor(F.col("feature_id") / 1000))
    feature = F.struct(
        F.lit("Feature").alias("type"), F.struct("feature_id", "nom").alias("properties"),
        F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates")).alias("geometry"),
    )
    last = geo.groupBy("document").agg(F.max("feature_id").alias("last"))
    body = geo.join(last, "document").select(
        "document", F.col("feature_id").alias("at"),
        F.concat(F.to_json(feature, {"pretty": "true"}), F.when(F.col("feature_id") < F.col("last"), ",").otherwise("")).alias("value"),
    )
    head = last.select("document", F.lit(-1).cast("long").alias("at"), F.lit('{\n  "type" : "FeatureCollection",\n  "features" : [').alias("value"))
    foot = last.select("document", (F.col("last") + 1).alias("at"), F.lit("  ]\n}").alias("value"))
    path = run_dir(spark, "scan_geojson_document")
    lines = body.unionByName(head).unionByName(foot).repartition("document").sortWithinPartitions("document", "at")
    lines.select("document", "value").write.partitionBy("document").text(path)
    feats = json.read_geojson(spark, path, schema=GEO_SCHEMA)
    at = F.col("geometry.coordinates")
    return feats.select(F.col("feature_id").cast("long").alias("feature_id"), "nom", at[0].alias("lon"), at[1].alias("lat"))


@register("keyed_append_indexed", f"SELECT {', '.join(EVENT_COLS)} FROM events")
def keyed_append_indexed(spark: SparkSession, sf: str) -> DataFrame:
    """K2: events of growing spans of time appended by id to a table with a key index, the last twice → every event once."""
    ev = table(spark, sf, "events").select(*EVENT_COLS)
    path = run_dir(spark, "keyed_append_indexed")
    for until in ("2024-01-10", "2024-01-20", "2100-01-01", "2100-01-01"):
        sinks.append_new(ev.where(F.col("ts") < F.lit(until).cast("timestamp")), path, ["event_id"], key_index=True)
    return sinks.read_table(spark, path, ev.schema)


@register("versions_compacted", f"""
SELECT 'events' AS table_name, {', '.join(EVENT_COLS)} FROM events
UNION ALL SELECT 'versions', count(DISTINCT CASE WHEN ts >= DATE '2024-01-15' THEN date_trunc('week', ts) END) + 1, NULL, NULL, NULL, NULL FROM events
UNION ALL SELECT 'events of the first user', event_id, ts, user_id, event_type, value FROM events WHERE user_id = (SELECT min(user_id) FROM events)""")
def versions_compacted(spark: SparkSession, sf: str) -> DataFrame:
    """K4: the events of each week published as a version, in buckets of the user; the versions before the 15th are compacted.
    Readers see every event once; a user's are found in the user's bucket."""
    ev = table(spark, sf, "events").select(*EVENT_COLS)
    root = run_dir(spark, "versions_compacted")
    versions.lay_out(spark, root, {"events": ["user_id"]}, 8)
    week = F.to_date(F.date_trunc("week", "ts"))
    weeks = [str(r.d) for r in ev.select(week.alias("d")).distinct().orderBy("d").collect()]  # the loop of a weekly job
    for d in weeks:
        if d == "2024-01-15":
            versions.compact(spark, root, "events")
        versions.publish_together({"events": ev.where(week == F.lit(d))}, root)
    live = [p for p in versions.live_parts(spark, root) if p.name == "events"]
    user = ev.agg(F.min("user_id").alias("user_id"))
    found = versions.read_published(spark, root, "events", all_versions=True, touching=user).join(user, "user_id", "left_semi")
    return (
        versions.read_published(spark, root, "events", all_versions=True).withColumn("table_name", F.lit("events"))
        .unionByName(found.withColumn("table_name", F.lit("events of the first user")))
        .unionByName(spark.createDataFrame([("versions", len(live))], "table_name string, event_id long"), allowMissingColumns=True)
    )


@register("mart_refreshed", q.ctes(*q.MART) + "SELECT " + ", ".join(_MART_COLS)
          + ", round(longitude, 6) AS longitude, round(latitude, 6) AS latitude FROM mart")
def mart_refreshed(spark: SparkSession, sf: str) -> DataFrame:
    """A mart built while a place, a category of units and some labels were still missing; these arrive in
    files of their own, and the mart is brought up to date → the mart of the whole tables."""
    root = run_dir(spark, "mart_refreshed")
    etab, ul, naf = (role(spark, sf, n) for n in ("etablissements", "unite_legale", "code_naf"))
    late = F.coalesce(F.col(C.place) == "3-MEDIUM", F.lit(False)), F.col(C.category) == "BUILDING"
    frames = {"etab": (etab, late[0]), "ul": (ul, late[1]), "naf": (naf, F.col(C.code) < "10")}
    schema = dashboard_mart(etab, ul, naf).schema
    for name, (df, missing) in frames.items():
        df.where(~missing).write.parquet(f"{root}/{name}")
    stored = [spark.read.schema(df.schema).parquet(f"{root}/{name}") for name, (df, _) in frames.items()]
    refresh_mart(*stored, f"{root}/mart")
    for name, (df, missing) in frames.items():
        df.where(missing).write.mode("append").parquet(f"{root}/{name}")
    stored = [spark.read.schema(df.schema).parquet(f"{root}/{name}") for name, (df, _) in frames.items()]
    refresh_mart(*stored, f"{root}/mart")
    mart = read_fresh_mart(spark, f"{root}/mart", schema)
    return mart.select(*_MART_COLS, F.round("longitude", 6).alias("longitude"), F.round("latitude", 6).alias("latitude"))


@register("sector_sums_incremental", q.ctes("unite_legale", "donnees_financieres") + f"""
SELECT u.activiteprincipaleunitelegale, CAST(year(f.date_cloture_exercice) AS INTEGER) AS annee,
  coalesce({q.money_sum('f.chiffre_d_affaires')}, 0.0) AS chiffre_d_affaires
FROM (SELECT DISTINCT siren, activiteprincipaleunitelegale FROM unite_legale WHERE activiteprincipaleunitelegale IS NOT NULL) u
JOIN donnees_financieres f ON u.siren = f.siren WHERE f.date_cloture_exercice IS NOT NULL GROUP BY 1, 2""")
def sector_sums_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """A5 by increments: the accounts in three spans of years. First the units of one category are in another sector and
    those of a second are unknown; later increments correct and add them → the sums of everything."""
    fin, ul = role(spark, sf, "donnees_financieres"), role(spark, sf, "unite_legale")
    root, closing = run_dir(spark, "sector_sums"), F.col(C.closing)
    wrong = F.when(F.col(C.category) == "BUILDING", F.lit("other")).otherwise(F.col(C.sector)).alias(C.sector)
    early = ul.where(F.col(C.category) != "MACHINERY").select(C.siren, wrong)
    spans = (closing < "1994-01-01", (closing >= "1994-01-01") & (closing < "1997-01-01"), closing >= "1997-01-01")
    units = (early, ul.where(F.col(C.category) == "MACHINERY"), ul.where(F.col(C.category) == "BUILDING"))
    for at, (span, given) in enumerate(zip(spans, units)):
        add_increment(root, f"increment {at}", fin.where(span), given)
    return sector_sums(spark, root)
