"""Incremental loads with a high-water mark (I1, I2) and the daily register load.

Order of effects on every run: read the mark → select rows from the mark, less an overlap
for rows that arrive late, on → keyed append (``append_new``) → only then append the new mark.
A run that dies between the data write and the mark write is simply rerun: it re-selects
the same rows and the keyed append adds nothing twice. The mark is the largest value among
the selected rows, but no later than the run's ``limit``: a row dated in the future is
stored, and hides nothing that comes after it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DataType, StructType

from ..fixed import ACTIVE, ESTABLISHMENT_FIELDS, LEGAL_UNIT_FIELDS
from ..functions.scalars import lenient_date
from ..operators.aggregates import distinct_keys
from ..operators.filters import filter_active, incremental_filter
from ..operators.joins import semi_join_keys
from ..operators.project import json_flatten, project_reindex
from ..session import materialize
from ..sources.json import parse_documents, parse_pages, quarantined
from ..sources.sinks import append_new, not_stored, one_per_key, publish_together, read_published, read_table, table_exists
from ..sources.versions import lay_out, maintain

BUCKETS = 16  # of the daily tables; for a large history, its size / 256 MB
COMPACT_AFTER = 32  # versions of a table, one per day


def read_mark(spark: SparkSession, state: str, default: object, dtype: DataType) -> Column:
    """The current mark as a Column: the largest committed mark, else ``default``.
    Evaluated as a scalar sub-query over the (tiny) state table."""
    marks = read_table(spark, state, StructType().add("mark", dtype))
    return F.coalesce(marks.select(F.max("mark")).scalar(), F.lit(default))


def _commit_mark(spark: SparkSession, state: str, value: object, dtype: DataType) -> None:
    row = spark.createDataFrame([(value,)], StructType().add("mark", dtype))
    row.withColumn("committed_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(state)


#: As ``limit``: the mark follows even values dated in the future, and rows before them are never selected again.
UNLIMITED = object()


def _capped(mark_col: str, limit: object | None, dtype: DataType) -> Column:
    """Aggregate: the largest mark value that is not after ``limit`` (None: now, for marks that are times)."""
    value = F.col(mark_col)
    now = {"date": F.current_date, "timestamp": F.current_timestamp, "timestamp_ntz": F.localtimestamp}.get(dtype.simpleString())
    if limit is UNLIMITED or limit is None and now is None:
        return F.max(value)
    return F.max(F.when(value <= (now() if limit is None else F.lit(limit)), value))


def incremental_batch(
    source: DataFrame,
    target: str,
    state: str,
    keys: Sequence[str],
    mark_col: str,
    default_mark: object,
    status_col: str | None = None,
    active: str = ACTIVE,
    partition: tuple[str, Column] | None = None,
    limit: object | None = None,
    overlap: dt.timedelta | None = None,
) -> int:
    """One incremental run; returns the number of rows appended. The new mark is the
    latest mark value among the selected rows, ``limit`` (the run's date; by default now, if marks
    are times) at most, unless that is ``UNLIMITED``; rows that arrive up to ``overlap`` late are still selected.

    ``partition=(name, expr)`` stores the target partitioned by ``expr`` (e.g. the day of
    the mark column; it must be a function of the key's row so a key always lands in the
    same partition): the duplicate check then only reads the partitions a run touches,
    so its cost follows the increment, not the size of the table."""
    spark = source.sparkSession
    dtype = source.schema[mark_col].dataType
    since = read_mark(spark, state, default_mark, dtype)
    if overlap is not None:
        since = since - F.lit(overlap)
    new = incremental_filter(source, mark_col, since, status_col, active)
    part_col = None
    if partition is not None:
        part_col, expr = partition
        new = new.withColumn(part_col, expr)
    seen = append_new(new, target, keys, partition_col=part_col, metrics={"mark": _capped(mark_col, limit, dtype)})
    if seen["mark"] is not None:
        _commit_mark(spark, state, seen["mark"], dtype)
    return int(seen["rows"])


def incremental_stream(
    spark: SparkSession,
    landing: str,
    envelope: StructType | str,
    records_field: str,
    target: str,
    checkpoint: str,
    keys: Sequence[str],
    timeout_s: float | None = None,
    partition: tuple[str, Column] | None = None,
    trigger: Mapping[str, object] | None = None,
    max_files_per_batch: int = 1000,
    quarantine: str | None = None,
) -> StreamingQuery:
    """New page files in a landing folder → records → keyed append, as a Structured
    Streaming query with ``availableNow``: each run processes exactly the files that
    arrived since the last run (tracked in the checkpoint) and stops. A retried micro-batch
    re-appends nothing thanks to the keyed append, so the sink is effectively exactly-once.
    ``partition`` as in ``incremental_batch``. ``max_files_per_batch`` bounds each micro-batch (a
    backlog of landed files is worked off in several bounded batches).

    The call waits for an ``availableNow`` run to end, however long the backlog takes
    (``timeout_s`` bounds the wait, as an error). ``trigger`` replaces ``availableNow`` (e.g.
    ``{"processingTime": "1 hour"}`` for a long-running load); the query is then returned running,
    after ``timeout_s`` seconds if given. A malformed page fails the run; with ``quarantine`` it is
    set aside there, once however often it is landed or a batch is retried (``json.quarantined``).
    """
    lines = spark.readStream.option("maxFilesPerTrigger", max_files_per_batch).text(landing)

    def upsert(batch: DataFrame, batch_id: int) -> None:
        records = parse_documents(batch, envelope, quarantine).records(records_field)
        part_col = None
        if partition is not None:
            part_col, expr = partition
            records = records.withColumn(part_col, expr)
        append_new(records, target, keys, partition_col=part_col)

    query = (
        lines.writeStream.foreachBatch(upsert)
        .option("checkpointLocation", checkpoint)
        .trigger(**(dict(trigger) if trigger else {"availableNow": True}))
        .start()
    )
    if trigger:
        if timeout_s is not None:
            query.awaitTermination(timeout_s)
        return query
    finished = query.awaitTermination() if timeout_s is None else query.awaitTermination(timeout_s)
    if timeout_s is not None and not finished:
        query.stop()
        raise TimeoutError(f"incremental stream over {landing} did not finish in {timeout_s}s")
    if query.exception() is not None:
        raise query.exception()
    return query


def quarantined_stream(spark: SparkSession, quarantine: str) -> DataFrame:
    """The malformed pages that a stream set aside."""
    return quarantined(spark, quarantine)


def daily_incremental(
    spark: SparkSession,
    establishment_pages: str,
    unit_pages: str,
    establishment_envelope: StructType,
    unit_envelope: StructType,
    target_root: str,
    default_mark: dt.date,
    run_date: dt.date | None = None,
    overlap_days: int = 0,
    quarantine: str | None = None,
    buckets: int = BUCKETS,
    compact_after: int = COMPACT_AFTER,
) -> dict[str, int]:
    """One day's load of new establishments and their legal units.

    Establishment pages → records created at or after the mark (less ``overlap_days``) whose
    current period is active (the latest period per record, W1 over the nested array) →
    keys (A1) → the unit records of those keys (semi join) → flatten + reindex to the
    table columns → lenient dates → rows that the tables lack → both tables and the mark
    committed as one version (K4): readers, and a rerun, see all of a day or nothing. The
    mark is the latest creation date seen, ``run_date`` (by default today) at most. Records without a readable date are
    not selected. Read the tables with ``read_published(..., all_versions=True)``.

    The tables are stored in ``buckets`` of their key (fixed at the first run): a day reads only the buckets that its
    keys fall in, of the versions since the last compaction. More than ``compact_after`` versions are merged into one;
    replaced ones stay a week for their readers (``sources.versions``).

    Returns rows appended per table, ``unmatched_keys`` (units of the day's establishments
    without a unit record) and ``rejected_pages`` (malformed pages: an error without ``quarantine``,
    else set aside there).
    """
    created = "datecreationetablissement"
    bad = [f"{quarantine}/{t}" if quarantine else None for t in ("etablissements", "unite_legale")]
    pages = [
        parse_pages(spark, establishment_pages, establishment_envelope, quarantine=bad[0]),
        parse_pages(spark, unit_pages, unit_envelope, quarantine=bad[1]),
    ]
    recs = pages[0].records("etablissements")
    # current period = the one without an end date (first of the array when several)
    recs = recs.withColumn(
        "periode", F.element_at(F.filter("periodesEtablissement", lambda p: p["dateFin"].isNull()), 1)
    ).drop("periodesEtablissement")
    etab = project_reindex(json_flatten(recs), ESTABLISHMENT_FIELDS)
    etab = etab.withColumn(created, lenient_date(created))
    etab = filter_active(etab, "etatadministratifetablissement")
    marks = read_published(spark, target_root, "_mark", all_versions=True, schema=StructType().add("mark", "date"))
    since = F.coalesce(marks.select(F.max("mark")).scalar(), F.lit(default_mark))
    etab = incremental_filter(etab, created, F.date_sub(since, overlap_days))
    # the day's selection is read from the pages once and kept (small next to the history): it feeds
    # the comparison with the table, the unit keys and the mark
    etab = materialize(one_per_key(etab, ["siret"]), "daily_selection")

    keys = distinct_keys(etab, "siren")
    units = semi_join_keys(pages[1].records("unitesLegales", "uniteLegale"), keys, "siren")
    units = project_reindex(json_flatten(units), LEGAL_UNIT_FIELDS)
    units = units.withColumn("datecreationunitelegale", lenient_date("datecreationunitelegale"))
    units = materialize(one_per_key(units, ["siren"]), "daily_units")

    def new_rows(batch: DataFrame, name: str, key: str) -> DataFrame:
        stored = read_published(spark, target_root, name, all_versions=True, schema=batch.schema, touching=batch)
        return not_stored(batch, stored, [key])

    lay_out(spark, target_root, {"etablissements": ["siret"], "unite_legale": ["siren"]}, buckets)
    new = {"etablissements": new_rows(etab, "etablissements", "siret"), "unite_legale": new_rows(units, "unite_legale", "siren")}
    mark = etab.agg(_capped(created, run_date, etab.schema[created].dataType).alias("mark")).where(F.col("mark").isNotNull())
    written = publish_together({**new, "_mark": mark.coalesce(1)}, target_root)
    counts = {name: written.rows[name] for name in new}
    maintain(spark, target_root, compact_after)
    counts["unmatched_keys"] = keys.join(units, "siren", "left_anti").count()
    counts["rejected_pages"] = sum(p.rejected for p in pages)
    return counts
