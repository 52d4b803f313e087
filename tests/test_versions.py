"""Versioned, bucketed tables: what readers see through commits, compaction, expiry and runs that die."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from firmlens.sources import sinks, versions as V
from firmlens.sources.tables import sub_folders

from .test_plans import plan

NOW = dt.timedelta(0)


def keyed(spark, lo, hi, v=0):
    return spark.range(lo, hi).select(F.col("id").cast("string").alias("k"), F.lit(v).alias("v"))


def rows(spark, root, name="t", **how):
    return sorted(map(tuple, V.read_published(spark, root, name, all_versions=True, **how).collect()))


def test_a_day_reads_only_the_buckets_of_its_keys(spark, tmp_table):
    V.lay_out(spark, tmp_table, {"t": ["k"]}, 32)
    V.publish_together({"t": keyed(spark, 0, 1000)}, tmp_table)
    V.publish_together({"t": keyed(spark, 1000, 2000)}, tmp_table)
    batch = keyed(spark, 1998, 2001, 7)
    found = V.read_published(spark, tmp_table, "t", all_versions=True, schema=batch.schema, touching=batch)
    buckets = {r[0] for r in batch.select(V.bucket_of(["k"], 32)).collect()}
    text = plan(found)
    assert "PartitionFilters: [" in text and all(f"{b}" in text for b in buckets) and "bucket" in text
    assert {f.split("bucket=")[1].split("/")[0] for f in found.inputFiles()} <= {str(b) for b in range(32)}
    assert 0 < found.count() < 2000 * (len(buckets) + 1) / 32 * 1.6
    assert {r.k for r in found.collect()} >= {"1998", "1999"}
    assert [r.k for r in sinks.not_stored(batch, found, ["k"]).collect()] == ["2000"]


def test_null_keys_have_a_bucket(spark, tmp_table):
    df = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    V.lay_out(spark, tmp_table, {"t": ["k"]}, 4)
    V.publish_together({"t": df}, tmp_table)
    none = df.where("k IS NULL")
    assert (None, 1) in [tuple(r) for r in V.read_published(spark, tmp_table, "t", touching=none).collect()]


def test_compaction_keeps_the_view(spark, tmp_table):
    V.lay_out(spark, tmp_table, {"t": ["k"]}, 4)
    for n in range(5):
        V.publish_together({"t": keyed(spark, n * 10, n * 10 + 10, n), "u": keyed(spark, n, n + 1)}, tmp_table)
    before, early = rows(spark, tmp_table), V.read_published(spark, tmp_table, "t", all_versions=True)
    assert V.maintain(spark, tmp_table, 8) == []
    assert sorted(V.maintain(spark, tmp_table, 4)) == ["t", "u"]
    assert rows(spark, tmp_table) == before == sorted(map(tuple, early.collect()))  # an earlier reader's plan still works
    assert [p.name for p in V.live_parts(spark, tmp_table)].count("t") == 1 and len(rows(spark, tmp_table, "u")) == 5
    files = V.read_published(spark, tmp_table, "t", all_versions=True).inputFiles()
    assert len(files) == 4  # one per bucket
    V.publish_together({"t": keyed(spark, 50, 60, 9)}, tmp_table)
    assert len(rows(spark, tmp_table)) == 60
    # nothing is deleted before its time, all that was replaced after it
    assert len(sub_folders(spark, f"{tmp_table}/t")) == 7
    gone = V.expire(spark, tmp_table, keep=NOW)
    assert len([g for g in gone if "/t/" in g]) == 5 and len(sub_folders(spark, f"{tmp_table}/t")) == 2
    assert len(rows(spark, tmp_table)) == 60 and len(rows(spark, tmp_table, "u")) == 5
    V.publish_together({"t": keyed(spark, 60, 61, 9)}, tmp_table)
    assert len(rows(spark, tmp_table)) == 61 and len(sub_folders(spark, f"{tmp_table}/_commits")) < 6


def test_appends_during_a_compaction_stay(spark, tmp_table, monkeypatch):
    for n in range(2):
        V.publish_together({"t": keyed(spark, n, n + 1)}, tmp_table)
    commit = V._commit

    def later(*a, **b):
        monkeypatch.setattr(V, "_commit", commit)
        V.publish_together({"t": keyed(spark, 7, 8)}, tmp_table)  # commits before the compaction does
        commit(*a, **b)

    monkeypatch.setattr(V, "_commit", later)
    V.compact(spark, tmp_table, "t")
    assert [k for k, _ in rows(spark, tmp_table)] == ["0", "1", "7"]


def test_two_compactions_at_once_count_once(spark, tmp_table, monkeypatch):
    for n in range(2):
        V.publish_together({"t": keyed(spark, n, n + 1)}, tmp_table)
    parts = V.live_parts(spark, tmp_table)
    V.compact(spark, tmp_table, "t")
    monkeypatch.setattr(V, "live_parts", lambda *_: parts)
    V.compact(spark, tmp_table, "t")
    monkeypatch.undo()
    assert [k for k, _ in rows(spark, tmp_table)] == ["0", "1"]


def test_dead_runs_are_never_read_and_expire(spark, tmp_table):
    V.publish_together({"t": keyed(spark, 0, 3)}, tmp_table)
    keyed(spark, 0, 9).write.parquet(f"{tmp_table}/t/version={V._new_version()}")  # died before its commit
    assert len(rows(spark, tmp_table)) == 3
    assert V.expire(spark, tmp_table) == [] and len(V.expire(spark, tmp_table, NOW)) >= 1
    assert len(sub_folders(spark, f"{tmp_table}/t")) == 1 and len(rows(spark, tmp_table)) == 3


def test_replaced_tables_expire(spark, tmp_table):
    for n in (3, 5):
        sinks.replace_table(keyed(spark, 0, n), tmp_table)
    assert len(sub_folders(spark, f"{tmp_table}/data")) == 2
    V.expire(spark, tmp_table, NOW)
    assert len(sub_folders(spark, f"{tmp_table}/data")) == 1 and len(rows(spark, tmp_table, "data")) == 5


def test_rebucketing_and_layouts(spark, tmp_table):
    V.publish_together({"t": keyed(spark, 0, 50)}, tmp_table)  # written before the table was laid out
    V.lay_out(spark, tmp_table, {"t": ["k"]}, 4)
    V.lay_out(spark, tmp_table, {"t": ["k"]}, 8)  # the first stays
    V.publish_together({"t": keyed(spark, 50, 90)}, tmp_table)
    assert len(rows(spark, tmp_table)) == 90
    V.compact(spark, tmp_table, "t", buckets=16)
    V.publish_together({"t": keyed(spark, 90, 95)}, tmp_table)
    batch = keyed(spark, 93, 94)
    found = V.read_published(spark, tmp_table, "t", all_versions=True, touching=batch)
    assert "93" in {r.k for r in found.collect()} and found.count() < 60 and len(rows(spark, tmp_table)) == 95
    with pytest.raises(ValueError):
        V.lay_out(spark, tmp_table, {"t": ["v"]}, 4)


def test_rows_written_are_counted(spark, tmp_table):
    V.lay_out(spark, tmp_table, {"b": ["k"]}, 4)
    done = V.publish_together({"a": keyed(spark, 0, 5), "b": keyed(spark, 0, 0)}, tmp_table)
    assert done.rows == {"a": 5, "b": 0} and V.latest_version(spark, tmp_table) == done.version
    assert rows(spark, tmp_table, "b", schema=keyed(spark, 0, 0).schema) == []


# ---------------------------------------------------------------- key index of flat tables
def test_files_read_follow_the_batch(spark, tmp_table):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert sinks.append_new(keyed(spark, 0, 4000), tmp_table, ["k"], key_index=True) == {"files_read": 0, "files": 0, "rows": 4000}
        many = len(sinks.read_table(spark, tmp_table, keyed(spark, 0, 1).schema).inputFiles())
        assert many >= 8
        few = sinks.append_new(keyed(spark, 10, 12), tmp_table, ["k"], key_index=True)
        assert few["rows"] == 0 and 1 <= few["files_read"] <= 2 and few["files"] == many
        new = sinks.append_new(keyed(spark, 3999, 4001), tmp_table, ["k"], key_index=True)
        assert new["rows"] == 1 and new["files_read"] <= 2
        assert sinks.append_new(keyed(spark, 0, 4001), tmp_table, ["k"], key_index=True)["rows"] == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_small_appends_are_not_opened_for_other_keys(spark, tmp_table):
    for n in range(6):
        done = sinks.append_new(keyed(spark, n * 20, n * 20 + 20), tmp_table, ["k"], key_index=True)
        assert done["rows"] == 20 and done["files_read"] == 0
    again = sinks.append_new(keyed(spark, 35, 45), tmp_table, ["k"], key_index=True)
    assert again["rows"] == 0 and again["files_read"] < again["files"]


def test_files_of_a_run_that_died_are_found(spark, tmp_table):
    keyed(spark, 0, 30).write.parquet(tmp_table)  # data without entries in the side table
    assert sinks.append_new(keyed(spark, 20, 40), tmp_table, ["k"], key_index=True)["rows"] == 10
    assert sinks.append_new(keyed(spark, 0, 40), tmp_table, ["k"], key_index=True)["rows"] == 0
    assert sinks.read_table(spark, tmp_table, keyed(spark, 0, 1).schema).count() == 40


def test_null_keys_and_several_key_columns(spark, tmp_table):
    df = spark.createDataFrame([(None, None), (None, 1), ("a", None), ("a", 1), ("a", 1)], "k string, v int")
    assert [sinks.append_new(df, tmp_table, ["k", "v"], key_index=True)["rows"] for _ in range(2)] == [4, 0]


def test_index_or_partitions(spark, tmp_table):
    with pytest.raises(ValueError):
        sinks.append_new(keyed(spark, 0, 1), tmp_table, ["k"], partition_col="v", key_index=True)
    assert not os.path.exists(tmp_table)


def test_rows_with_maps_have_an_order(spark, tmp_table):
    rows = [("a", 1, {"x": 1}), ("a", 1, {"y": 0, "x": 2}), ("a", 1, None), ("b", None, None)]
    df = spark.createDataFrame(rows, "k string, n int, m map<string, int>")
    for parts in (1, 4):
        out = {r.k: r.m for r in sinks.one_per_key(df.repartition(parts), ["k"]).collect()}
        assert out == {"a": {"x": 2, "y": 0}, "b": None}
    assert [sinks.append_new(df, tmp_table, ["k"])["rows"] for _ in range(2)] == [2, 0]


def test_buckets_have_few_files(spark, tmp_table):
    df = spark.range(4000).repartition(8).select((F.col("id") % 50).cast("string").alias("siren"), "id")
    stored = sinks.save_bucketed(df, "few_files", f"{tmp_table}/b", "siren", 6)
    assert len(stored.inputFiles()) == 6 and stored.count() == 4000
    spark.sql("DROP TABLE few_files")
