"""Literal edge cases of the operators (null keys, ties, zero divisors, empty inputs,
round trips, reruns) on tiny frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from firmlens.functions import scalars as S
from firmlens.functions.geo import lambert93_defined, lambert93_to_wgs84
from firmlens.operators import aggregates as A
from firmlens.operators import filters as FL
from firmlens.operators import joins as J
from firmlens.operators import project as P
from firmlens.operators.topk import top_n
from firmlens.operators.windows import latest_per_key
from firmlens.plans import dashboard as dash
from firmlens.sources import files, sinks
from firmlens.streaming import incremental as I


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_label_lookup_null_matches_null(spark):
    df = spark.createDataFrame([("1", "a"), ("2", None)], "id string, code string")
    labels = spark.createDataFrame([("a", "LA"), (None, "NONE")], "code string, libelle string")
    out = J.join_label_lookup(df, labels, "code", "code", ["libelle"])
    assert rows(out, "id", "libelle") == [("1", "LA"), ("2", "NONE")]


def test_group_sum_and_mean_nulls(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", 2.0), ("b", None), (None, 5.0)], "k string, v double"
    )
    assert rows(A.sum_by_keys(df, ["k"], "v"), "k", "v") == [("a", 3.0), ("b", 0.0)]
    assert rows(A.mean_by(df.where("k is not null"), "k", "v"), "k", "v") == [("a", 1.5)]


def test_top_counts_ties_by_key(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,), (None,), (None,)], "x string")
    out = A.top_k_counts(df, "x", 2)
    assert [tuple(r) for r in out.collect()] == [("c", 2), ("a", 1)]


def test_growth_undefined_when_past_zero(spark):
    df = spark.createDataFrame([(10.0, 0.0), (0.0, 0.0), (15.0, 10.0), (1.0, None)], "r double, p double")
    out = df.select(S.growth_pct("r", "p").alias("g"))
    assert [r.g for r in out.collect()] == [None, None, 50.0, None]


def test_latest_per_key_drops_all_null_dates_and_breaks_ties(spark):
    df = spark.createDataFrame(
        [("k1", dt.date(2020, 1, 1), 1.0), ("k1", dt.date(2021, 1, 1), 2.0), ("k1", dt.date(2021, 1, 1), 3.0),
         ("k2", None, 9.0)],
        "k string, d date, v double",
    )
    out = latest_per_key(df, "k", "d", tiebreak=[F.col("v").desc()])
    assert rows(out, "k", "v") == [("k1", 3.0)]


def test_n_largest_nulls_fill_up(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None), ("c", 3.0)], "k string, v double")
    out = top_n(df, "v", 5, tiebreak=["k"])
    assert [(r.k, r.v) for r in out.collect()] == [("c", 3.0), ("a", 1.0), ("b", None)]


def test_histogram_single_value_and_maximum(spark):
    one = spark.createDataFrame([(7.0,), (7.0,)], "v double")
    h = A.log_histogram(one, "v", 50).collect()
    assert len(h) == 49 and sum(r.n for r in h) == 2 and [r.n for r in h if r.bin == 0] == [2]
    many = spark.createDataFrame([(1.0,), (10.0,), (100.0,), (1000.0,), (-3.0,), (None,)], "v double")
    h = {r.bin: r.n for r in A.log_histogram(many, "v", 50).collect()}
    assert sum(h.values()) == 4 and h[48] == 1 and h[0] == 1


def test_csv_round_trip_keeps_leading_zeros(spark, tmp_table):
    df = spark.createDataFrame([("005520135", "01000")], "siren string, cp string")
    files.write_csv(df, tmp_table)
    back = files.read_csv_typed(spark, tmp_table, df.schema).collect()
    assert (back[0].siren, back[0].cp) == ("005520135", "01000")


def test_code_label_with_separator_in_label(spark):
    df = spark.createDataFrame([("47", "Shops - retail")], "code string, libelle string")
    d = df.select(S.code_label("code", "libelle").alias("t"))
    r = d.select(S.code_of("t").alias("c"), S.label_of("t").alias("l")).first()
    assert (r.c, r.l) == ("47", "Shops - retail")


def test_address_all_blank_is_na(spark):
    df = spark.createDataFrame([(None, "  ", ""), ("BAT A ", None, "12")], "a string, b string, c string")
    assert [r.x for r in df.select(S.address_line(["a", "b", "c"]).alias("x")).collect()] == ["N/A", "BAT A  12"]


def test_absent_column_both_rules(spark):
    df = spark.createDataFrame([("1", "x")], "Siren string, Nom string")
    assert P.project_present(df, ["siren", "absent"]).columns == ["siren"]
    re = P.project_reindex(df, ["siren", "absent"])
    assert re.columns == ["siren", "absent"] and re.first().absent is None


def test_flatten_keeps_arrays(spark):
    df = spark.createDataFrame([(1, (2, [3, 4]))], "id int, s struct<a: int, b: array<int>>")
    flat = P.json_flatten(df)
    assert flat.columns == ["id", "s.a", "s.b"]
    assert flat.first()["s.b"] == [3, 4]


def test_empty_key_set(spark):
    df = spark.createDataFrame([("1", 1.0)], "siren string, v double")
    keys = spark.createDataFrame([], "siren string")
    assert J.semi_join_keys(df, keys).count() == 0


def test_scope_without_place_is_empty(spark):
    df = spark.createDataFrame([("p", "s")], "place string, sector string")
    assert FL.filter_scope(df, "place", "sector", None).count() == 0
    assert FL.filter_scope(df, "place", "sector", "p", "s").count() == 1
    assert FL.filter_scope(df, "place", "sector", None, place_optional=True).count() == 1
    assert FL.filter_scope(df, "place", "sector", None, "other", place_optional=True).count() == 0


def test_latest_per_key_is_deterministic_without_a_tiebreak(spark):
    data = [("k", dt.date(2021, 1, 1), float(v), "x") for v in range(6)]
    for n in (1, 4):
        out = latest_per_key(spark.createDataFrame(data[::-1], "k string, d date, v double, s string").repartition(n), "k", "d")
        assert [r.v for r in out.collect()] == [5.0]


def test_append_rerun_adds_nothing(spark, tmp_table):
    df = spark.createDataFrame([("1", None), ("2", 2.0), ("2", 2.0)], "k string, v double")
    assert sinks.append_new(df, tmp_table, ["k", "v"])["rows"] == 2
    assert sinks.append_new(df, tmp_table, ["k", "v"])["rows"] == 0
    assert spark.read.parquet(tmp_table).count() == 2


def test_partitioned_append_prunes_target(spark, tmp_table):
    df = spark.createDataFrame([("1", "d1"), ("2", "d2")], "k string, day string")
    sinks.append_new(df, tmp_table, ["k"], partition_col="day")
    more = spark.createDataFrame([("1", "d1"), ("3", "d3")], "k string, day string")
    assert sinks.append_new(more, tmp_table, ["k"], partition_col="day")["rows"] == 1
    assert spark.read.parquet(tmp_table).count() == 3


def test_failure_between_data_and_mark(spark, tmp_table):
    src = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 2))], "id long, ts timestamp_ntz")
    target, state = f"{tmp_table}/t", f"{tmp_table}/s"
    # the data write commits but the job dies before the mark: simulate with a bare append
    sinks.append_new(src, target, ["id"])
    assert I.incremental_batch(src, target, state, ["id"], "ts", dt.datetime(2024, 1, 1)) == 0
    more = src.unionByName(spark.createDataFrame([(3, dt.datetime(2024, 1, 3))], "id long, ts timestamp_ntz"))
    assert I.incremental_batch(more, target, state, ["id"], "ts", dt.datetime(2024, 1, 1)) == 1
    assert spark.read.parquet(target).count() == 3
    assert spark.read.parquet(state).agg(F.max("mark")).first()[0] == dt.datetime(2024, 1, 3)


def test_lambert_origin(spark):
    df = spark.createDataFrame([(700000.0, 6600000.0), (None, 1.0), (1.0, 2e7)], "x double, y double")
    out = lambert93_to_wgs84(df, "x", "y").collect()
    assert out[0].longitude == pytest.approx(3.0, abs=1e-9)
    assert out[0].latitude == pytest.approx(46.5, abs=1e-9)
    assert out[1].latitude is None and out[2].latitude is None
    assert df.where(lambert93_defined("x", "y")).count() == 1


@pytest.mark.parametrize("raw,expected", [
    ("Marseille 8e Arrondissement", "MARSEILLE"),
    ("L'Estaque", "L ESTAQUE"),
    ("Aix-en-Provence", "AIX-EN-PROVENCE"),
    ("  saint   -  chamas ", "SAINT CHAMAS"),
])
def test_normalize_place(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "n string")
    assert df.select(S.normalize_place("n").alias("x")).first().x == expected


def test_lenient_parsing(spark):
    df = spark.createDataFrame([("2020-02-03", "1.5"), ("bad", "n/a")], "d string, v string")
    out = df.select(S.lenient_date("d").alias("d"), S.lenient_double("v").alias("v")).collect()
    assert (out[0].d, out[0].v) == (dt.date(2020, 2, 3), 1.5)
    assert (out[1].d, out[1].v) == (None, None)


def test_revenue_by_group_counts_each_row(spark):
    rows_ = spark.createDataFrame([("p", "u1"), ("p", "u1"), ("q", "u2"), (None, "u1")], "place string, siren string")
    amounts = spark.createDataFrame([("u1", 10.0), ("u1", 5.0), ("u3", 1.0)], "siren string, chiffre_d_affaires double")
    out = A.revenue_by_group(rows_, amounts, "place")
    assert rows(out, "place", "chiffre_d_affaires") == [("p", 30.0), ("q", 0.0)]


def test_chain_left_matches_fan_out(spark):
    etab = spark.createDataFrame([("e1", "u1"), ("e2", "u1"), ("e3", "u2")], "siret string, siren string")
    ul = spark.createDataFrame([("u1", "PME"), ("u2", "GE")], "siren string, categorieentreprise string")
    fin = spark.createDataFrame([("u1", 10.0), ("u1", None)], "siren string, chiffre_d_affaires double")
    out = J.join_chain_left(etab, ul, fin, "siren", ["categorieentreprise"])
    got = rows(out.withColumn("detail_sum", F.col("detail_sum").cast("double")),
               "siret", "detail_rows", "detail_sum", "detail_count")
    assert got == [("e1", 2, 10.0, 1), ("e2", 2, 10.0, 1), ("e3", 1, None, 0)]


def test_top_revenue_units_name_fallback(spark):
    scoped = spark.createDataFrame(
        [("u1", "s2", "s2"), ("u1", "s1", "s1"), ("u2", "s3", "NAME")],
        "siren string, siret string, denominationunitelegale string")
    fin = spark.createDataFrame(
        [("u1", dt.date(2020, 1, 1), 5.0, 1.0), ("u1", dt.date(2021, 1, 1), 1.0, 1.0),
         ("u2", dt.date(2021, 1, 1), 3.0, 0.0)],
        "siren string, date_cloture_exercice date, chiffre_d_affaires double, resultat_net double")
    out = dash.top_revenue_units(scoped, fin, 5).collect()
    assert [(r.denominationunitelegale, r.chiffre_d_affaires) for r in out] == [("NAME", 3.0), ("s1", 1.0)]


def test_two_tables_commit_together(spark, tmp_table):
    a = spark.createDataFrame([("1", "x")], "k string, v string")
    b = spark.createDataFrame([("1", 2)], "k string, n int")
    sinks.publish_together({"a": a, "b": b}, tmp_table, columns={"b": ["n", "k"]})
    assert sinks.read_published(spark, tmp_table, "b").columns == ["n", "k"]
    # a second batch whose commit never happens stays invisible
    a.write.parquet(f"{tmp_table}/a/version=v99999999999999999999-dead")
    sinks.publish_together({"a": a, "b": b}, tmp_table)
    assert sinks.read_published(spark, tmp_table, "a", all_versions=True).count() == 2


def test_geojson_document(spark, tmp_table):
    import json as _json
    import os

    doc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"nom": "Marseille 8e Arrondissement", "code": "13208"},
         "geometry": {"type": "Polygon", "coordinates": [[[5.3, 43.2], [5.4, 43.2], [5.4, 43.3], [5.3, 43.2]]]}},
        {"type": "Feature", "properties": {"nom": "Aix-en-Provence", "code": "13001"},
         "geometry": {"type": "Point", "coordinates": [5.45, 43.53]}},
    ]}
    os.makedirs(tmp_table, exist_ok=True)
    with open(f"{tmp_table}/communes.geojson", "w") as fh:
        _json.dump(doc, fh, indent=2)
    from firmlens.sources.json import read_geojson

    feats = read_geojson(spark, tmp_table, multi_line=True)
    names = sorted(r.nom for r in feats.select(S.normalize_place("nom").alias("nom")).collect())
    assert names == ["AIX-EN-PROVENCE", "MARSEILLE"] and "geometry" in feats.columns


def test_latin1_labels(spark, tmp_table):
    import os

    os.makedirs(tmp_table, exist_ok=True)
    with open(f"{tmp_table}/code_naf.csv", "wb") as fh:
        fh.write("Code;Libelle\n56.10A;Restauration traditionnelle - cafés\n".encode("latin-1"))
    row = files.read_labels(spark, tmp_table).first()
    assert (row.code, row.libelle) == ("56.10A", "Restauration traditionnelle - cafés")


def test_recommended_conf_is_bounded():
    from firmlens.session import MAX_PARTITIONS, recommended_conf

    sizes = (10 * 2**30, 2 * 2**40, 100 * 2**40)
    assert [int(recommended_conf(b)["spark.sql.shuffle.partitions"]) for b in sizes] == [200, 2048, MAX_PARTITIONS]


def test_card_point_lookup_and_band_default(spark):
    mart = spark.createDataFrame(
        [("u1", "s2", "N1", "PME", "05", 2020, 2019.0, None, "12", "RUE", "X", "13001", "MARSEILLE"),
         ("u1", "s1", "N1", "PME", "01", 2021, 2019.0, "BAT A", None, None, None, None, None)],
        "siren string, siret string, denominationunitelegale string, categorieentreprise string, "
        "trancheeffectifsetablissement string, anneeeffectifsetablissement int, anneecategorieentreprise double, "
        "complementadresseetablissement string, numerovoieetablissement string, typevoieetablissement string, "
        "libellevoieetablissement string, codepostaletablissement string, libellecommuneetablissement string")
    bands = spark.createDataFrame([("01", "1 or 2")], "code string, libelle string")
    card = dash.establishment_card(mart, bands, "u1").collect()
    assert len(card) == 1
    c = card[0]
    assert (c.siret, c.adresse, c.tranche_effectif, c.annee_effectif) == ("s1", "BAT A", "1 or 2", "2021")
    other = dash.establishment_card(mart.where("siret = 's2'"), bands, "u1").first()
    assert (other.adresse, other.tranche_effectif) == ("12 RUE X 13001 MARSEILLE", "N/A")


def test_pivot_values_with_dots_and_unlisted_ones(spark):
    df = spark.createDataFrame([(2020, "ST. A", 3), (2020, "B`", 1), (2021, "other", 7), (2021, None, 8)], "y int, c string, n bigint")
    out = A.pivot_wide(df, "y", "c", "n", ["ST. A", "B`"], unlisted="rest")
    assert sorted(tuple(r) for r in out.collect()) == [(2020, 3, 1, 0), (2021, 0, 0, 2)]


def test_pivot_gaps_are_zero(spark):
    df = spark.createDataFrame([(2020, "A", 3), (2021, "B", 1)], "y int, c string, n bigint")
    out = {r.y: (r.A, r.B, r.C) for r in A.pivot_wide(df, "y", "c", "n", ["A", "B", "C"]).collect()}
    assert out == {2020: (3, 0, 0), 2021: (0, 1, 0)}


def test_stream_backlog_in_bounded_batches(spark, tmp_table):
    from firmlens.sources.json import write_pages

    ev = spark.range(500).select(F.col("id").alias("event_id"), (F.col("id") % 7).cast("double").alias("value"))
    env = "total long, records array<struct<event_id: long, value: double>>"
    for lo in (0, 200, 400):  # three landings: at least three files
        part = ev.where((F.col("event_id") >= lo) & (F.col("event_id") < lo + 200))
        write_pages(part, f"{tmp_table}/landing", "records", F.floor(F.col("event_id") / 50), mode="append")
    q = I.incremental_stream(spark, f"{tmp_table}/landing", env, "records", f"{tmp_table}/t",
                             f"{tmp_table}/ckpt", ["event_id"], max_files_per_batch=1)
    assert len(q.recentProgress) >= 3  # the backlog ran as several one-file batches
    assert spark.read.parquet(f"{tmp_table}/t").count() == 500


def test_sector_growth_empty_scope(spark):
    scoped = spark.createDataFrame([], "siren string, activiteprincipaleunitelegale string")
    fin = spark.createDataFrame(
        [("u1", dt.date(2020, 1, 1), 1.0)], "siren string, date_cloture_exercice date, chiffre_d_affaires double")
    naf = spark.createDataFrame([("01", "X")], "code string, libelle string")
    top5, hist = dash.sector_growth(scoped, fin, naf)
    assert top5.count() == 0 and hist.count() == 0


def test_sector_growth_semantics(spark):
    scoped = spark.createDataFrame(
        [("u1", "A"), ("u1", "A"), ("u2", "B"), ("u3", "C"), ("u4", None)],
        "siren string, activiteprincipaleunitelegale string")
    fin = spark.createDataFrame(
        [("u1", dt.date(2021, 6, 30), 150.0), ("u1", dt.date(2018, 6, 30), 100.0),
         ("u2", dt.date(2021, 6, 30), 10.0), ("u2", dt.date(2018, 6, 30), 0.0),
         ("u3", dt.date(2021, 6, 30), 5.0), ("u4", dt.date(2021, 6, 30), 99.0)],
        "siren string, date_cloture_exercice date, chiffre_d_affaires double")
    naf = spark.createDataFrame([("A", "Alpha")], "code string, libelle string")
    top5, hist = dash.sector_growth(scoped, fin, naf)
    rows = top5.collect()
    # A grows 50 % (the duplicated establishment counts the unit once); B had 0 in the past
    # (undefined growth); C has no past year; the unit without a sector is not a sector
    assert [(r.activiteprincipaleunitelegale, r.evol_pct, r.libelle) for r in rows] == [("A", 50.0, "Alpha")]
    assert sorted((r.activiteprincipaleunitelegale, r.annee) for r in hist.collect()) == [("A", 2018), ("A", 2021)]
