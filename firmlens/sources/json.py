"""JSON sources: paged API envelopes (S5) and GeoJSON feature collections (S6), plus the
writers that land such files (used to stage API pages and to build fixtures).

A landing folder holds one envelope per line (or per file with ``multi_line=True``); Spark
reads every file of the folder in parallel, so the paging loop of an API client becomes
a directory scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import materialize
from .sinks import append_new, read_table
from .spanning import Elements, block_states, read_lines, records

# Lossless timestamp text in landed JSON (the writer's default keeps milliseconds only).
TIMESTAMP_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


# Landed JSON is kept compressed. Such a file is read by one task: writers here make one per shuffle partition, which
# adaptive execution holds to its advisory size.
LANDED_OPTIONS = {**TIMESTAMP_OPTIONS, "compression": "gzip"}


QUARANTINE_SCHEMA = "hash string, document string, parsed string, read_at timestamp"


@dataclass(frozen=True)
class Pages:
    """Documents read: the well-formed ones by their schema, and how many were not (a document that was
    landed several times counts once)."""

    envelopes: DataFrame
    rejected: int = 0

    def records(self, records_field: str | None, single_field: str | None = None) -> DataFrame:
        """One row per record of the arrays and of the single objects."""
        env, parts = self.envelopes, []
        if records_field:
            parts.append(env.select(F.explode(F.col(records_field)).alias("__r")).select("__r.*"))
        if single_field:
            parts.append(env.where(F.col(single_field).isNotNull()).select(f"{single_field}.*"))
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def parse_documents(lines: DataFrame, schema: StructType | str, quarantine: str | None = None, text: str = "value") -> Pages:
    """JSON documents, one per row of ``lines``, by the whole of a declared schema.

    A document is malformed if it isn't JSON, isn't an object, or any field declared doesn't hold what it
    is declared as, whether the caller uses that field or not. Without ``quarantine`` it fails the read. With it,
    every document is parsed once and stored with its verdict; the malformed ones go to the quarantine, keyed by
    their hash, and nothing of them is in the result. Blank documents are skipped.
    """
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    body = F.col(text)
    lines = lines.where(F.length(F.trim(F.regexp_replace(body, r"[\s\uFEFF]+", " "))) > 0)
    # options keep the optimizer from cutting the schema down to the fields in use, which would hide faults in others
    if quarantine is None:
        parsed = lines.select(F.from_json(body, declared, {**TIMESTAMP_OPTIONS, "mode": "FAILFAST"}).alias("__p"))
        return Pages(parsed.select("__p.*"))
    marked = StructType([*declared.fields]).add(_BAD, "string")
    options = {**TIMESTAMP_OPTIONS, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
    parsed = lines.select(body.alias("__d"), F.from_json(body, marked, options).alias("__p"))
    bad = F.col("__p").isNull() | F.col(f"__p.{_BAD}").isNotNull()
    read = materialize(parsed.select(F.when(bad, F.col("__d")).alias("__d"), "__p", bad.alias("__bad")), "pages")
    lost = read.where("__bad").select(
        F.sha2("__d", 256).alias("hash"), F.col("__d").alias("document"),
        F.to_json(F.struct(*[F.col(f"__p.`{c}`").alias(c) for c in declared.fieldNames()])).alias("parsed"),
    ).dropDuplicates(["hash"])
    rejected = lost.count()
    if rejected:
        append_new(lost.withColumn("read_at", F.current_timestamp()), quarantine, ["hash"])
    good = read.where("NOT __bad").select([F.col(f"__p.`{c}`").alias(c) for c in declared.fieldNames()])
    return Pages(good, rejected)


_BAD = "__malformed"


def parse_pages(
    spark: SparkSession, path: str, schema: StructType | str, multi_line: bool = False, quarantine: str | None = None
) -> Pages:
    """The JSON documents of a folder: one per line (files are split among tasks), or one per file."""
    return parse_documents(spark.read.text(path, wholetext=multi_line), schema, quarantine)


def quarantined(spark: SparkSession, quarantine: str) -> DataFrame:
    """The malformed documents set aside under ``quarantine``, each once however often it was read: ``hash``,
    ``document``, ``parsed`` (what could be parsed), ``read_at`` (first). None yet: no rows."""
    return read_table(spark, quarantine, QUARANTINE_SCHEMA)


def read_pages(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    records_field: str | None,
    single_field: str | None = None,
    multi_line: bool = False,
    quarantine: str | None = None,
) -> DataFrame:
    """Envelopes → one row per record.

    ``records_field`` names the array of records (``{"total": n, "etablissements": [...]}``);
    an envelope without it contributes no rows. ``single_field`` names a single-object form
    (``{"uniteLegale": {...}}``); both forms may be mixed in one folder. A malformed envelope
    fails the read; with ``quarantine`` (a folder) it is set aside there instead, none of its records is
    loaded, and the others are read (``parse_documents``).
    """
    return parse_pages(spark, path, schema, multi_line, quarantine).records(records_field, single_field)


def _lists(records: DataFrame, group: Column, item: Column, most: int, out: str) -> DataFrame:
    """``(out)``: the items of each group as lists; groups of more than ``most`` in several lists of about that size."""
    rows = records.select(group.alias("__group"), item.alias("__item"))
    # the sizes of the large groups only, so that a hot group is dealt out before it is gathered
    large = rows.groupBy("__group").count().where(F.col("count") > most).select(F.col("__group").alias("__large"), F.ceil(F.col("count") / most).alias("__lists"))
    # at most one large group per ``most`` rows: broadcast, so that the records are shuffled once, by the grouping
    dealt = rows.join(F.broadcast(large), F.col("__group").eqNullSafe(F.col("__large")), "left")
    dealt = dealt.withColumn("__list", F.coalesce(F.pmod(F.monotonically_increasing_id(), F.col("__lists")), F.lit(0)))
    return dealt.groupBy("__group", "__list").agg(F.collect_list("__item").alias(out)).select(out)


def write_pages(
    records: DataFrame,
    path: str,
    records_field: str,
    page_of: Column,
    with_total: bool = True,
    mode: str = "overwrite",
    exclude: Sequence[str] = (),
    max_page: int = 100_000,
) -> None:
    """Land records as API-style pages, one JSON envelope per line.

    ``page_of`` assigns each record to a page. A page is built as one list, so one of more than ``max_page`` records is
    written as several of about that size. ``exclude`` lists columns used for paging only (not part of the records).
    """
    record = F.struct(*[F.col(f"`{c}`") for c in records.columns if c not in exclude])
    pages = _lists(records, page_of, record, max_page, records_field)
    if with_total:
        pages = pages.withColumn("total", records.select(F.count(F.lit(1))).scalar())
    pages.write.mode(mode).options(**LANDED_OPTIONS).json(path)


def read_geojson(
    spark: SparkSession, path: str, multi_line: bool = True, schema: StructType | str | None = None, quarantine: str | None = None
) -> DataFrame:
    """FeatureCollection files → one row per feature with its ``properties.*``, the
    feature ``type`` and the ``geometry`` kept as a nested value.

    ``schema`` declares the collection. ``multi_line=False``: one collection per line, malformed ones as in
    ``read_pages``. Otherwise a file holds one collection, its features on lines of their own or pretty-printed, and is
    split among tasks feature by feature (``spanning``): each feature is parsed, and set aside or an error, by
    itself. Without a schema, Spark infers it, and a file is one task.
    """
    if schema is None:
        coll = spark.read.options(**TIMESTAMP_OPTIONS, mode="FAILFAST").option("multiLine", multi_line).json(path)
    elif multi_line:
        declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        feature = declared["features"].dataType.elementType
        lines, shape = read_lines(spark, path), Elements(FEATURE_DEPTH)
        objects = records(lines, shape, block_states(lines, shape)).where(F.col("text").startswith("{"))
        found = parse_documents(objects, feature, quarantine, text="text").envelopes
        # a root member's own sub-objects stand as deep as features, but aren't any
        return _features(found.where(F.col("type") == "Feature").select(F.struct(*feature.fieldNames()).alias("__f")))
    else:
        coll = parse_pages(spark, path, schema, False, quarantine).envelopes
    return _features(coll.select(F.explode("features").alias("__f")))


FEATURE_DEPTH = 2  # brackets around a feature: the collection's and the array's


def _features(feats: DataFrame) -> DataFrame:
    return feats.select("__f.properties.*", F.col("__f.type").alias("feature_type"), F.col("__f.geometry"))


def write_geojson(
    features: DataFrame,
    path: str,
    properties: Sequence[str],
    lon: str,
    lat: str,
    collection_of: Column,
    max_features: int = 100_000,
) -> None:
    """Write point features as FeatureCollections, one collection per line; ``collection_of``
    groups features into collections, those of more than ``max_features`` into several."""
    feat = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(*[F.col(p) for p in properties]).alias("properties"),
        F.struct(F.lit("Point").alias("type"), F.array(F.col(lon), F.col(lat)).alias("coordinates")).alias(
            "geometry"
        ),
    )
    coll = _lists(features, collection_of, feat, max_features, "features")
    coll.select(F.lit("FeatureCollection").alias("type"), "features").write.mode("overwrite").json(path)
