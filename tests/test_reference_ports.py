"""The reference's own three tests, ported: the inner merge on the unit key directly, and
the fetch success/failure pair re-aimed at the JSON page source (a landed page yields
records; a malformed page fails the read, or is set aside)."""

import pytest

from firmlens.operators.joins import join_inner_key
from firmlens.sources.json import quarantined, read_pages


def test_merge_on_key(spark):
    inpi = spark.createDataFrame([("111", 10), ("222", 20), ("333", 30)], "siren string, val_inpi int")
    insee = spark.createDataFrame([("111", "A"), ("222", "B"), ("444", "C")], "siren string, val_insee string")
    merged = join_inner_key(inpi, insee, "siren")
    assert {r.siren for r in merged.collect()} == {"111", "222"}
    assert "val_inpi" in merged.columns and "val_insee" in merged.columns


def _write(path, text):
    import os

    os.makedirs(path, exist_ok=True)
    with open(f"{path}/page.json", "w") as fh:
        fh.write(text)


ENVELOPE = "total long, results array<struct<result: string>>"


def test_page_ok(spark, tmp_table):
    _write(tmp_table, '{"total": 1, "results": [{"result": "ok"}]}\n')
    rows = read_pages(spark, tmp_table, ENVELOPE, "results").collect()
    assert [r.result for r in rows] == ["ok"]


def test_page_failure(spark, tmp_table):
    _write(tmp_table, '{"total": 1, "results": [{"result": "ok"}\n')
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING"):
        read_pages(spark, tmp_table, ENVELOPE, "results").collect()


def test_failed_page_is_set_aside(spark, tmp_table):
    cut = '{"total": 1, "results": [{"result": "lost"}'
    _write(f"{tmp_table}/pages", '{"total": 1, "results": [{"result": "ok"}]}\n' + cut + "\n" + '{"total": 9}\n')
    rows = read_pages(spark, f"{tmp_table}/pages", ENVELOPE, "results", quarantine=f"{tmp_table}/aside").collect()
    assert [r.result for r in rows] == ["ok"]
    assert [r.document for r in quarantined(spark, f"{tmp_table}/aside").collect()] == [cut]


def _land(path, lines):
    import os

    os.makedirs(path)
    with open(f"{path}/a.json", "w") as f:
        f.write("\n".join(lines) + "\n")


PAGES = "total long, results array<struct<siren: string, chiffre_d_affaires: double>>"
FAULTY = [
    '{"total": "many", "results": [{"siren": "2", "chiffre_d_affaires": 1.0}]}',  # a field that no caller reads is mistyped
    '{"total": 2, "results": [{"siren": "3", "chiffre_d_affaires": "x"}, {"siren": "4", "chiffre_d_affaires": 1.0}]}',
    '[{"total": 1}]', "5", "null", '{"total',
]
SOUND = ['{"total": 1, "results": [{"siren": "1", "chiffre_d_affaires": 1.5}]}', "", "  ", '{"total": 0}', "{}"]


def test_a_page_is_loaded_or_set_aside(spark, tmp_table):
    """Also faults in fields that the caller doesn't use; a second run, or a page landed twice, counts once."""
    from firmlens.sources.json import parse_pages

    _land(f"{tmp_table}/pages", FAULTY + SOUND + FAULTY[:1])
    aside = f"{tmp_table}/aside"
    assert quarantined(spark, aside).count() == 0
    for _ in range(2):
        pages = parse_pages(spark, f"{tmp_table}/pages", PAGES, quarantine=aside)
        assert [tuple(r) for r in pages.records("results").collect()] == [("1", 1.5)] and pages.rejected == len(FAULTY)
        assert sorted(r.document for r in quarantined(spark, aside).collect()) == sorted(FAULTY)
    _land(f"{tmp_table}/next", SOUND)
    assert parse_pages(spark, f"{tmp_table}/next", PAGES, quarantine=aside).rejected == 0


@pytest.mark.parametrize("bad", FAULTY)
def test_without_a_quarantine_a_faulty_page_fails_the_read(spark, tmp_table, bad):
    _land(tmp_table, SOUND + [bad])
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING"):
        read_pages(spark, tmp_table, PAGES, "results").collect()


def test_documents_of_several_lines(spark, tmp_table):
    _land(tmp_table, ["{", '"total": 1,', '"results": [{"siren": "1"}]', "}"])
    assert [r.siren for r in read_pages(spark, tmp_table, PAGES, "results", multi_line=True).collect()] == ["1"]
