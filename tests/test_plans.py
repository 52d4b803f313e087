"""Plan-shape checks: what must (and must not) appear in the physical plans."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from firmlens import catalog
from firmlens.operators import joins as J
from firmlens.operators.topk import top_n
from firmlens.operators.windows import latest_per_key
from firmlens.plans import cleaning as X

from .conftest import SMALL


def plan(df) -> str:
    """The formatted physical plan, as ``explain`` prints it."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_status_and_place_filters_reach_the_scan(spark, tmp_table):
    raw = spark.createDataFrame(
        [("1", "9", "A", "MARSEILLE"), ("2", "9", "F", "MARSEILLE")],
        "siret string, siren string, etatAdministratifEtablissement string, libelleCommuneEtablissement string",
    )
    raw.write.parquet(tmp_table)
    out = X.clean_establishments(spark.read.parquet(tmp_table), ["MARSEILLE", "AIX-EN-PROVENCE"])
    text = plan(out)
    assert "PushedFilters: [IsNotNull(etatAdministratifEtablissement)" in text
    assert "EqualTo(etatAdministratifEtablissement,A)" in text and "In(libelleCommuneEtablissement" in text
    assert out.count() == 1


def test_key_restriction_is_a_semi_join(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("siren"))
    keys = spark.range(10).select(F.col("id").cast("string").alias("siren"))
    text = plan(J.semi_join_keys(df, keys))
    assert "LeftSemi" in text


def test_top_n_is_take_ordered(spark):
    df = spark.range(1000).withColumn("v", F.col("id") % 7)
    assert "TakeOrderedAndProject" in plan(top_n(df, "v", 5, tiebreak=["id"]))


def test_latest_per_key_partial_window_limit(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("k"), F.col("id").alias("d"))
    text = plan(latest_per_key(df, "k", "d"))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_chain_join_aggregates_before_joining(spark):
    etab = spark.range(100).select(F.col("id").cast("string").alias("siret"), (F.col("id") % 3).cast("string").alias("siren"))
    ul = spark.range(3).select(F.col("id").cast("string").alias("siren"), F.lit("PME").alias("categorieentreprise"))
    fin = spark.range(1000).select((F.col("id") % 3).cast("string").alias("siren"), F.col("id").cast("double").alias("chiffre_d_affaires"))
    out = J.join_chain_left(etab, ul, fin, "siren", ["categorieentreprise"])
    assert out.count() == 100  # one row per establishment, never the 100 x 1000 pairs


def _top_level_groups(args: str) -> int:
    """Number of top-level ``[...]`` groups in a formatted ``Arguments:`` line."""
    depth, groups = 0, 0
    for ch in args:
        if ch == "[":
            groups += depth == 0
            depth += 1
        elif ch == "]":
            depth -= 1
    return groups


def _unpartitioned_windows(text: str) -> int:
    lines = text.splitlines()
    bad = 0
    for i, line in enumerate(lines):
        if re.fullmatch(r"\(\d+\) Window", line.strip()):
            args = next(ln for ln in lines[i + 1:] if ln.startswith("Arguments:"))
            bad += _top_level_groups(args[len("Arguments:"):]) < 3  # [functions], [partition], [order]
    return bad


@pytest.mark.parametrize("key", sorted(catalog.QUERIES))
def test_no_cartesian_products_or_global_windows(spark, key):
    df = catalog.QUERIES[key](spark, SMALL)
    df.write.format("noop").mode("overwrite").save()
    text = plan(df)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert _unpartitioned_windows(text) == 0  # a window without PARTITION BY runs in one task


def test_global_window_detector(spark):
    from pyspark.sql import Window

    glob = spark.range(10).withColumn("r", F.row_number().over(Window.orderBy("id")))
    part = spark.range(10).withColumn("r", F.row_number().over(Window.partitionBy(F.col("id") % 2).orderBy("id")))
    assert _unpartitioned_windows(plan(glob)) == 1 and _unpartitioned_windows(plan(part)) == 0


def test_bucketed_tables_join_without_shuffle(spark, tmp_table):
    from firmlens.sources.sinks import save_bucketed

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        etab = spark.range(2000).select(F.col("id").cast("string").alias("siret"),
                                        (F.col("id") % 97).cast("string").alias("siren"))
        fin = spark.range(5000).select((F.col("id") % 97).cast("string").alias("siren"),
                                       F.col("id").cast("double").alias("chiffre_d_affaires"))
        e = save_bucketed(etab, "etab_b", f"{tmp_table}/e", "siren", 8)
        f = save_bucketed(fin, "fin_b", f"{tmp_table}/f", "siren", 8)
        joined = e.join(f, "siren")
        text = plan(joined)
        assert "SortMergeJoin" in text and "Exchange" not in text
        from collections import Counter

        ne, nf = Counter(i % 97 for i in range(2000)), Counter(i % 97 for i in range(5000))
        assert joined.count() == sum(ne[k] * nf[k] for k in ne)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_published_mart_prunes_by_place(spark, tmp_table):
    from firmlens.plans.dashboard import publish_mart

    mart = spark.createDataFrame([("1", "A"), ("2", "B")], "siren string, libellecommuneetablissement string")
    stored = publish_mart(mart, tmp_table)
    scoped = stored.where(F.col("libellecommuneetablissement") == "A")
    assert "PartitionFilters: [isnotnull(libellecommuneetablissement" in plan(scoped)
    assert scoped.count() == 1
