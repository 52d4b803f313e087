"""What the ingest and sink layer does with the input a register really delivers: null partition
values, empty and died writes, rows out of date order, texts that files mangle, bad numbers."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from firmlens.functions import scalars as S
from firmlens.operators import aggregates as A
from firmlens.operators import joins as J
from firmlens.operators.topk import preview
from firmlens.session import run_dir, shared_dir, working_folders
from firmlens.sources import files, sinks
from firmlens.streaming import incremental as I

from .test_plans import plan

ROWS = "k string, day date, v int"
D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def test_null_partition_value_is_found_again(spark, tmp_table):
    batch = spark.createDataFrame([("a", D1, 1), ("b", None, 2), (None, None, 3)], ROWS)
    assert [sinks.append_new(batch, tmp_table, ["k"], partition_col="day")["rows"] for _ in range(3)] == [3, 0, 0]
    assert sinks.read_table(spark, tmp_table, batch.schema).count() == 3


def test_empty_first_batch_and_rerun(spark, tmp_table):
    batch = spark.createDataFrame([("a", D1, 1)], ROWS)
    for part in (None, "day"):
        path = f"{tmp_table}/{part}"
        assert sinks.append_new(batch.limit(0), path, ["k"], partition_col=part)["rows"] == 0
        assert [sinks.append_new(batch, path, ["k"], partition_col=part)["rows"] for _ in range(2)] == [1, 0]


def test_first_write_that_died(spark, tmp_table):
    os.makedirs(f"{tmp_table}/_temporary/0")
    batch = spark.createDataFrame([("a", D1, 1)], ROWS)
    assert [sinks.append_new(batch, tmp_table, ["k"])["rows"] for _ in range(2)] == [1, 0]


def test_file_system_errors_are_not_an_absent_table(spark):
    with pytest.raises(Exception, match="(?i)scheme"):
        sinks.table_exists(spark, "nosuchscheme://x/y")


def test_one_of_several_rows_of_a_key(spark):
    rows = [("a", D1, 1), ("a", D2, 0), ("a", D2, 5), ("a", None, 9), (None, D1, 1), (None, D1, 2)]
    for n in (1, 3):
        out = sinks.one_per_key(spark.createDataFrame(rows, ROWS).repartition(n), ["k"])
        assert sorted((tuple(r) for r in out.collect()), key=str) == [("a", D2, 5), (None, D1, 2)]


def test_target_scan_is_pruned_to_the_partitions_of_the_batch(spark, tmp_table):
    full = spark.createDataFrame([(f"k{n}", D1 + dt.timedelta(n), n) for n in range(20)], ROWS)
    sinks.append_new(full, tmp_table, ["k"], partition_col="day")
    stored = sinks.read_table(spark, tmp_table, full.schema)
    pruned = sinks._pruned(stored, full.where(F.col("day") == D2), "day")
    assert "PartitionFilters: [" in plan(pruned) and "2024-01-02" in plan(pruned)
    assert pruned.count() == 1 and len(pruned.inputFiles()) <= len(stored.inputFiles())


def test_small_increment_does_not_shuffle_the_target(spark, tmp_table):
    full = spark.range(5000).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"))
    full.write.parquet(f"{tmp_table}/t")
    batch = full.limit(3)
    batch.write.parquet(f"{tmp_table}/b")
    old = spark.read.parquet(f"{tmp_table}/t").select("k")
    wanted = spark.read.parquet(f"{tmp_table}/b").select(F.col("k").alias("__k"))
    semi = old.join(wanted, old["k"].eqNullSafe(wanted["__k"]), "left_semi")
    assert "BroadcastHashJoin" in plan(semi) and "hashpartitioning" not in plan(semi)


def ts(day, year=2024):
    return dt.datetime(year, 1, day)


def test_future_rows_hide_nothing_and_late_rows_land(spark, tmp_table):
    def day(rows, limit):
        df = spark.createDataFrame(rows, "id long, ts timestamp_ntz")
        return I.incremental_batch(df, f"{tmp_table}/t", f"{tmp_table}/s", ["id"], "ts", ts(1), limit=limit, overlap=dt.timedelta(3))

    assert day([(1, ts(2)), (2, ts(9)), (3, ts(1, 2099))], ts(10)) == 3
    assert day([(2, ts(9)), (4, ts(7)), (5, ts(12)), (6, ts(3))], ts(13)) == 2  # 6 is later than the overlap
    assert day([(7, ts(13))], ts(14)) == 1
    marks = [r.mark for r in spark.read.parquet(f"{tmp_table}/s").orderBy("mark").collect()]
    assert marks == [ts(9), ts(12), ts(13)]


def test_mark_moves_on_a_rerun_that_appends_nothing(spark, tmp_table):
    df = spark.createDataFrame([(1, ts(5))], "id long, ts timestamp_ntz")
    sinks.append_new(df, f"{tmp_table}/t", ["id"])  # the data of a run that died before its mark
    assert I.incremental_batch(df, f"{tmp_table}/t", f"{tmp_table}/s", ["id"], "ts", ts(1)) == 0
    assert [r.mark for r in spark.read.parquet(f"{tmp_table}/s").collect()] == [ts(5)]


def test_malformed_page_of_a_stream(spark, tmp_table):
    env = "total long, records array<struct<id: long>>"
    os.makedirs(f"{tmp_table}/in")
    with open(f"{tmp_table}/in/a.json", "w") as f:
        f.write('{"total": 2, "records": [{"id": 1}, {"id": 2}]}\n{"total": 1, "records": [{"id"\n')
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING"):
        I.incremental_stream(spark, f"{tmp_table}/in", env, "records", f"{tmp_table}/t0", f"{tmp_table}/c0", ["id"])
    for _ in range(2):
        I.incremental_stream(spark, f"{tmp_table}/in", env, "records", f"{tmp_table}/t", f"{tmp_table}/c", ["id"], quarantine=f"{tmp_table}/q")
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_table}/t").collect()) == [1, 2]
    assert [r.document for r in I.quarantined_stream(spark, f"{tmp_table}/q").collect()] == ['{"total": 1, "records": [{"id"']


@pytest.mark.parametrize("sep,encoding", [(",", "UTF-8"), (";", "ISO-8859-1")])
def test_csv_is_lossless(spark, tmp_table, sep, encoding):
    texts = ["a\nb", "", None, 'say "hi"', "back\\slash", "\\", "a,b;c", " lead", "trail ", "\r\n", "x\r", "é", "\t", '"', '""', "'", "#c", "\\n"]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, t string").repartition(2)
    files.write_csv(df, tmp_table, sep=sep, encoding=encoding)
    back = files.read_csv_typed(spark, tmp_table, df.schema, sep=sep, encoding=encoding)
    assert {r.n: r.t for r in back.collect()} == dict(enumerate(texts))


def test_replace_keeps_the_old_content_until_the_commit(spark, tmp_table):
    old, new = spark.range(3), spark.range(5)
    sinks.replace_table(old, tmp_table)
    broken = new.withColumn("id", F.when(F.col("id") == 4, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="lost"):
        sinks.replace_table(broken, tmp_table)
    assert sinks.read_published(spark, tmp_table, "data").count() == 3
    sinks.replace_table(new, tmp_table)
    assert sinks.read_published(spark, tmp_table, "data").count() == 5


def test_numbers_that_are_none(spark):
    texts = ["NaN", "Infinity", "-Infinity", "1d", "1e3f", "1e400", " 12.5 ", "-.5", "1.", "0x1p3", "+7E2", "", None]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(S.lenient_double("t").alias("v")).collect()
    assert [r.v for r in got] == [None] * 6 + [12.5, -0.5, 1.0, None, 700.0, None, None]
    doubles = spark.createDataFrame([(float("nan"),), (float("inf"),), (2.5,)], "v double")
    assert [r.v for r in doubles.select(S.lenient_double("v").alias("v")).collect()] == [None, None, 2.5]


def test_amounts_never_fail_the_job(spark):
    df = spark.createDataFrame([("a", 1e17), ("a", 0.5), ("b", float("nan")), ("b", 3.0), ("c", 1e300)], "k string, v double")
    out = {r.k: r.v for r in A.sum_by_keys(df, ["k"], "v").collect()}
    assert out == {"a": 1e17, "b": 3.0, "c": 0.0} and df.agg(S.money_rejects("v").alias("n")).first().n == 2
    assert {r.k: r.v for r in A.mean_by(df, "k", "v").collect()} == {"a": 5e16, "b": 3.0, "c": None}


def test_semi_joins_reduce_the_right_side(spark, tmp_table):
    keys = spark.range(1000).select((F.col("id") % 7).cast("string").alias("siren"))
    keys.write.parquet(tmp_table)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        used, df = spark.read.parquet(tmp_table), spark.range(10).select(F.col("id").cast("string").alias("siren"))
        for out in (J.semi_join_keys(df, used), J.labels_in_use(df.select(F.col("siren").alias("code"), F.lit("x").alias("libelle")), used, "siren")):
            tree = plan(out).split("\n\n")[0]
            # below the join, the used keys are aggregated before and after their exchange
            right = tree[tree.index("SortMergeJoin LeftSemi") :]
            assert right.count("HashAggregate") == 2 and right.rindex("HashAggregate") > right.rindex("Exchange")
            assert out.count() == 7
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_salted_join_spreads_null_keys(spark):
    child = spark.createDataFrame([(None, n) for n in range(200)] + [("u", 1)], "siren string, n int")
    parent = spark.createDataFrame([("u", "P")], "siren string, p string")
    out = J.join_left_parent_salted(child, parent)
    assert out.count() == 201 and out.where("p = 'P'").count() == 1


def test_working_folders_are_deleted(spark):
    with working_folders(spark):
        path = run_dir(spark, "test")
        spark.range(3).write.parquet(path)
        assert sinks.table_exists(spark, path)
    assert not sinks.table_exists(spark, path)


def test_a_cluster_session_must_name_the_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_preview(spark):
    df = spark.createDataFrame([(k, "own") for k in range(20)], "k int, n string")
    assert preview(df).count() == 5 and preview(df, 50).count() == 20
    assert {r.k for r in preview(df, 3).collect()} <= set(range(20))


def test_large_pages_are_written_as_several(spark, tmp_table):
    from firmlens.sources import json as J

    recs = spark.range(1000).select("id", F.when(F.col("id") < 900, F.lit(7)).when(F.col("id") < 950, F.lit(8)).alias("page"))
    J.write_pages(recs, f"{tmp_table}/p", "rs", F.col("page"), exclude=["page"], max_page=100)
    sizes = [r.n for r in spark.read.json(f"{tmp_table}/p").select(F.size("rs").alias("n")).collect()]
    assert sum(sizes) == 1000 and max(sizes) < 200 and len(sizes) >= 11 and sizes.count(50) >= 2
    got = J.read_pages(spark, f"{tmp_table}/p", "total long, rs array<struct<id: long>>", "rs")
    assert sorted(r.id for r in got.collect()) == list(range(1000))
    geo = spark.range(50).select("id", F.lit(1.0).alias("x"), F.lit(2.0).alias("y"))
    J.write_geojson(geo, f"{tmp_table}/g", ["id"], "x", "y", F.lit(0), max_features=10)
    assert spark.read.text(f"{tmp_table}/g").count() == 5


def test_pages_are_compressed_and_records_shuffled_once(spark, tmp_table):
    import os

    from firmlens.sources import json as J

    recs = spark.range(5000).select("id", F.expr("id % 40").alias("page"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")  # inputs are large next to it
    try:
        lists = J._lists(recs, F.col("page"), F.struct("id"), 100, "rs")
        assert "SortMergeJoin" not in lists._jdf.queryExecution().executedPlan().toString()
        J.write_pages(recs, f"{tmp_table}/p", "rs", F.col("page"), exclude=["page"], max_page=100)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    files = [f for f in os.listdir(f"{tmp_table}/p".removeprefix("file:")) if f.startswith("part-")]
    assert files and all(f.endswith(".json.gz") for f in files)
    got = J.read_pages(spark, f"{tmp_table}/p", "total long, rs array<struct<id: long>>", "rs")
    assert sorted(r.id for r in got.collect()) == list(range(5000))


def test_large_batch_is_not_shuffled_for_few_stored_keys(spark, tmp_table):
    from firmlens.sources import sinks

    spark.range(20000).select(F.col("id").cast("string").alias("k"), F.lit("x").alias("v")).write.parquet(f"{tmp_table}/b")
    spark.range(19990, 40000).select(F.col("id").cast("string").alias("k")).write.parquet(f"{tmp_table}/s")
    batch, stored = spark.read.parquet(f"{tmp_table}/b"), spark.read.parquet(f"{tmp_table}/s")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    try:
        new = sinks.not_stored(batch, stored, ["k"])
        assert "SortMergeJoin" not in new._jdf.queryExecution().executedPlan().toString()
        assert new.count() == 19990
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
