"""Records that span lines, read by several tasks from one file, against readers that give it to one."""

import csv
import io
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from firmlens.sources import files
from firmlens.sources import json as J
from firmlens.sources.spanning import Elements, Quoted, block_states, read_lines, records


@pytest.fixture()
def small_blocks(spark):
    def use(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield use
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def put(path, text, name="a.txt"):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w", newline="") as f:
        f.write(text)


TEXTS = ["a\nb", "\n\n\n", "", 'say "hi"\n"', "x,y", "é\n", " lead", "plain", "\n", '"', '""\n""', "long " * 40 + "\n" + "tail " * 40, "z\r"]


def written(n, seed):
    r = random.Random(seed)
    rows = [(k, r.choice(TEXTS), r.choice(TEXTS)) for k in range(n)]
    out = io.StringIO()
    w = csv.writer(out, lineterminator="\n", quoting=csv.QUOTE_MINIMAL)
    w.writerow(["k", "t", "u"])
    for k, t, u in rows:
        out.write(f'{k},"{t.replace(chr(34), chr(34) * 2)}","{u.replace(chr(34), chr(34) * 2)}"\n')
    return rows, out.getvalue()


@pytest.mark.parametrize("size", [64, 700, 100_000])
def test_one_csv_file_by_several_tasks(spark, tmp_table, small_blocks, size):
    rows, text = written(300, size)
    put(tmp_table, text)
    put(tmp_table, written(0, 1)[1], "b.txt")  # a header only
    small_blocks(size)
    schema = "k int, t string, u string"
    got = files.read_csv_typed(spark, tmp_table, schema)
    assert sorted(tuple(r) for r in got.collect()) == rows
    lines = read_lines(spark, tmp_table)
    states = block_states(lines, Quoted()).states
    assert size > 1000 or any(s[1].any() for s in states.values())  # some block begins inside quotes
    tasks = lines.select(F.spark_partition_id()).distinct().count()
    assert tasks > 3 if size < 1000 else tasks >= 1


def test_as_the_reader_of_one_task(spark, tmp_table, small_blocks):
    _, text = written(80, 5)
    put(tmp_table, text.replace("\n12,", "\n\n   \n12,").replace("\n20,", "\nbad,").replace("\n30,", '\n"30",'))
    small_blocks(100)
    schema = "k int, t string, u string"
    old = spark.read.schema(schema).options(**files._csv_options(",", "UTF-8", True, files.NULL_MARK)).option("multiLine", True).csv(tmp_table)
    assert sorted(map(repr, files.read_csv_typed(spark, tmp_table, schema).collect())) == sorted(map(repr, old.collect()))


def test_windows_line_ends(spark, tmp_table, small_blocks):
    put(tmp_table, 'k,t\r\n1,"a\r\nb"\r\n2,c\r\n')
    small_blocks(5)
    assert sorted(map(tuple, files.read_csv_typed(spark, tmp_table, "k int, t string").collect())) == [(1, "a\r\nb"), (2, "c")]


def test_rejects_are_counted_not_nulled(spark, tmp_table, small_blocks):
    put(f"{tmp_table}/in", 'k,t\n1,a\nx,"b\nc"\n3\n4,d,e\n5,\\N\n,f\n')
    small_blocks(7)
    for _ in range(2):
        got = files.read_csv_typed(spark, f"{tmp_table}/in", "k int, t string", rejects=f"{tmp_table}/lost")
        assert sorted(map(tuple, got.collect()), key=repr) == [(1, "a"), (5, None), (None, "f")]
        assert sorted(r.record for r in files.rejected_records(spark, f"{tmp_table}/lost").collect()) == ["3", "4,d,e", 'x,"b\nc"']
    for mode, n in (("PERMISSIVE", 6), ("DROPMALFORMED", 3)):
        assert files.read_csv_typed(spark, f"{tmp_table}/in", "k int, t string", mode=mode).count() == n
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        files.read_csv_typed(spark, f"{tmp_table}/in", "k int, t string", mode="FAILFAST").collect()


def test_quotes_without_a_partner(spark, tmp_table, small_blocks):
    put(tmp_table, 'k,t\n1,a"b\n2,c\n')
    put(tmp_table, 'k,t\n3,"d\ne"\n', "b.txt")
    small_blocks(6)
    assert sorted(map(tuple, files.read_csv_typed(spark, tmp_table, "k int, t string").collect())) == [(1, 'a"b'), (2, "c"), (3, "d\ne")]


SCHEMA = "type string, features array<struct<type: string, properties: struct<n: bigint, nom: string>, geometry: struct<type: string, coordinates: array<double>>>>"


def collection(n, seed=0):
    r = random.Random(seed)
    names = ['a "quoted" {brace', "[x]", "back\\slash", "}{", "é\n", "plain", ""]
    return {
        "type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "{[urn"}}, "bbox": [[1, 2], [3, 4]],
        "features": [{"type": "Feature", "properties": {"n": k, "nom": r.choice(names)}, "geometry": {"type": "Point", "coordinates": [k / 4, -1.5]}} for k in range(n)],
    }


@pytest.mark.parametrize("indent,size", [(2, 80), (1, 1000), (None, 100), (0, 30)])
def test_one_document_by_several_tasks(spark, tmp_table, small_blocks, indent, size):
    coll = collection(60)
    put(tmp_table, json.dumps(coll, indent=indent))
    small_blocks(size)
    got = J.read_geojson(spark, tmp_table, schema=SCHEMA)
    assert sorted((r.n, r.nom, r.feature_type, r.geometry.coordinates) for r in got.collect()) == [
        (f["properties"]["n"], f["properties"]["nom"], "Feature", f["geometry"]["coordinates"]) for f in coll["features"]
    ]
    if indent is not None and size < 500:
        lines = read_lines(spark, tmp_table)
        assert lines.select(F.spark_partition_id()).distinct().count() > 3
        assert (block_states(lines, Elements(2)).states.popitem()[1][1] > 2).any()


def test_features_on_lines_of_their_own(spark, tmp_table, small_blocks):
    coll = collection(20)
    body = ",\n".join(json.dumps(f) for f in coll["features"])
    put(tmp_table, '{"type": "FeatureCollection",\n"features": [\n' + body + "\n]\n}\n")
    put(tmp_table, '{"type": "FeatureCollection", "features": [' + body + "]}", "b.txt")  # the first starts on the header's line
    put(tmp_table, '{"type": "FeatureCollection", "features": []}', "c.txt")
    small_blocks(150)
    assert sorted(r.n for r in J.read_geojson(spark, tmp_table, schema=SCHEMA).collect()) == sorted([*range(20)] * 2)


def test_a_faulty_feature_is_set_aside(spark, tmp_table, small_blocks):
    coll = collection(9)
    coll["features"][4]["properties"]["n"] = "x"
    put(f"{tmp_table}/in", json.dumps(coll, indent=1) + json.dumps(collection(3), indent=1)[:-60])  # and one that is cut off
    small_blocks(90)
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        J.read_geojson(spark, f"{tmp_table}/in", schema=SCHEMA).collect()
    got = J.read_geojson(spark, f"{tmp_table}/in", schema=SCHEMA, quarantine=f"{tmp_table}/q")
    assert sorted(r.n for r in got.collect()) == sorted([0, 1, 2, 3, 5, 6, 7, 8, 0, 1])
    assert J.quarantined(spark, f"{tmp_table}/q").count() == 2


def test_empty_files(spark, tmp_table):
    put(tmp_table, "")
    lines = read_lines(spark, tmp_table)
    assert records(lines, Quoted(), block_states(lines, Quoted())).count() == 0
    assert files.read_csv_typed(spark, tmp_table, "k int").count() == 0
    assert J.read_geojson(spark, tmp_table, schema=SCHEMA).count() == 0
