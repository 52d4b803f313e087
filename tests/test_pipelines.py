"""End states of the multi-step pipelines beyond what the catalogue query returns."""

import duckdb
import pytest

from firmlens.catalog_io import DAILY_MARK, DAILY_RUNS, run_daily_days
from firmlens.roles import TABLES, with_roles
from firmlens.sources.sinks import read_published

from .conftest import SMALL


def test_daily_load_units_are_those_of_the_new_establishments(spark, tmp_table):
    counts = run_daily_days(spark, SMALL, tmp_table)
    units = read_published(spark, f"{tmp_table}/target", "unite_legale", all_versions=True)
    got = sorted(tuple(r) for r in units
                 .select("siren", "denominationunitelegale", "datecreationunitelegale",
                         "nomenclatureactiviteprincipaleunitelegale").collect())
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    want = sorted(con.execute(with_roles(["etablissements_raw", "unite_legale_raw"], f"""
        SELECT u.siren, u.denominationUniteLegale, try_cast(u.dateCreationUniteLegale AS DATE), NULL
        FROM unite_legale_raw u
        WHERE u.siren IN (SELECT siren FROM etablissements_raw WHERE etatAdministratifEtablissement = 'A'
                          AND try_cast(dateCreationEtablissement AS DATE) >= DATE '{DAILY_MARK}')""")).fetchall())
    assert got == want
    marks = read_published(spark, f"{tmp_table}/target", "_mark", all_versions=True).collect()
    assert len(marks) == 2 and all(m.mark <= run for m, run in zip(sorted(marks), DAILY_RUNS.values()))
    landed = sum(spark.read.text(f"{tmp_table}/landing/{d}/etablissements").count() for d in DAILY_RUNS)
    assert landed > 0 and sum(c["unite_legale"] for c in counts) == len(got)
    # units without a record are those of the unmatched keys of the fixture
    assert all(c["unmatched_keys"] > 0 and c["rejected_pages"] == 0 for c in counts)


def test_daily_load_commits_both_tables_or_none(spark, tmp_table, monkeypatch):
    """A run that dies before its commit shows nothing; its rerun loads the day once."""
    from firmlens.streaming import incremental as I

    real = I.publish_together

    def dies(frames, root, columns=None):
        frames["etablissements"].write.parquet(f"{root}/etablissements/version=v0-dead")
        raise RuntimeError("lost")

    monkeypatch.setattr(I, "publish_together", dies)
    with pytest.raises(RuntimeError):
        run_daily_days(spark, SMALL, tmp_table)
    with pytest.raises(FileNotFoundError):
        read_published(spark, f"{tmp_table}/target", "etablissements", all_versions=True)
    monkeypatch.setattr(I, "publish_together", real)
    run_daily_days(spark, SMALL, tmp_table)
    rows = read_published(spark, f"{tmp_table}/target", "etablissements", all_versions=True)
    assert rows.count() == rows.select("siret").distinct().count() > 0


def _duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


def test_monthly_staging_all_targets(spark, tmp_table):
    from firmlens.catalog_io import _raw
    from firmlens.fixed import FINANCIAL_COLUMNS, LEGAL_UNIT_COLUMNS
    from firmlens.plans.cleaning import monthly_staging

    counts = monthly_staging(*_raw(spark, SMALL), f"{tmp_table}/staging", f"{tmp_table}/target")
    con = _duck()
    ul = sorted(tuple(r) for r in spark.read.parquet(f"{tmp_table}/target/unite_legale")
                .select(*LEGAL_UNIT_COLUMNS).collect())
    want_ul = sorted(con.execute(with_roles(["unite_legale_raw"], "SELECT "
                     + ", ".join(f"CAST({c} AS VARCHAR)" for c in LEGAL_UNIT_COLUMNS)
                     + " FROM unite_legale_raw WHERE etatAdministratifUniteLegale = 'A'")).fetchall())
    assert ul == want_ul and counts["unite_legale"] == len(ul)
    fin = sorted(tuple(r) for r in spark.read.parquet(f"{tmp_table}/target/donnees_financieres")
                 .select(*FINANCIAL_COLUMNS).collect())
    want_fin = sorted(con.execute(with_roles(["donnees_financieres_raw"], """
        SELECT DISTINCT siren, date_cloture_exercice, try_cast(chiffre_d_affaires AS DOUBLE),
               try_cast(resultat_net AS DOUBLE)
        FROM donnees_financieres_raw WHERE try_cast(chiffre_d_affaires AS DOUBLE) >= 0""")).fetchall())
    assert fin == want_fin
    # a second monthly run over the same sources adds nothing
    again = monthly_staging(*_raw(spark, SMALL), f"{tmp_table}/staging2", f"{tmp_table}/target")
    assert again == {"unite_legale": 0, "etablissements": 0, "donnees_financieres": 0}


def test_daily_load_compacts_its_versions(spark, tmp_table, monkeypatch):
    from firmlens.sources.versions import live_parts
    from firmlens.streaming import incremental as I

    real = I.maintain
    monkeypatch.setattr(I, "maintain", lambda s, root, most: real(s, root, 1))
    counts = run_daily_days(spark, SMALL, tmp_table)
    for name in ("etablissements", "unite_legale"):
        rows = read_published(spark, f"{tmp_table}/target", name, all_versions=True)
        assert rows.count() == sum(c[name] for c in counts)
        assert [p.name for p in live_parts(spark, f"{tmp_table}/target")].count(name) == 1
        assert rows.inputFiles() and all("bucket=" in f for f in rows.inputFiles())


def test_clean_run_loads_the_units_of_its_own_establishments(spark, tmp_table):
    from firmlens.catalog_io import _raw
    from firmlens.plans.cleaning import run_clean_pipeline

    raw = _raw(spark, SMALL)
    first = run_clean_pipeline(*raw, tmp_table, ["1-URGENT"])
    fewer = (raw[0].limit(0), raw[1], raw[2])
    assert set(run_clean_pipeline(*fewer, tmp_table, ["2-HIGH"]).values()) == {0}
    both = run_clean_pipeline(*raw, f"{tmp_table}/both", ["1-URGENT", "2-HIGH"])
    second = run_clean_pipeline(*raw, tmp_table, ["2-HIGH"])
    assert {n: first[n] + second[n] for n in both} == both
