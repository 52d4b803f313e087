"""Sums kept by increments against sums of everything."""

import datetime as dt

from firmlens.plans import sector_sums as S
from firmlens.plans.dashboard import sector_year_revenue

ACC = "siren string, date_cloture_exercice date, chiffre_d_affaires double"
UNIT = "siren string, activiteprincipaleunitelegale string"


def acc(siren, year, value):
    return (siren, dt.date(year, 5, 1) if year else None, value)


INCREMENTS = [
    ([acc("1", 2020, 10.5), acc("1", 2020, 1.0), acc("2", 2021, None), acc("3", 2020, 7.0), acc(None, 2020, 9.0), acc("1", None, 3.0)],
     [("1", "A"), ("2", "B"), ("9", "C"), (None, "A")]),
    ([acc("1", 2021, 5.25), acc("3", 2021, 1.0), acc("4", 2020, -2.0)], [("1", "B"), ("3", "A"), ("4", None)]),  # 1 changes, 3 is known now
    ([acc("2", 2020, 4.0)], [("1", "B"), ("2", None), ("4", "A"), ("3", "C")]),  # 2 loses its sector
    ([], [("1", "A"), ("2", "B"), ("2", "A")]),
]


def check(spark, root, upto):
    accounts = [a for accs, _ in INCREMENTS[:upto] for a in accs]
    units = {}
    for _, given in INCREMENTS[:upto]:
        now = {}
        for siren, sector in given:
            now[siren] = max(now.get(siren) or "", sector or "") or None
        units |= now
    want = sector_year_revenue(spark.createDataFrame(list(units.items()), UNIT), spark.createDataFrame(accounts, ACC))
    got = S.sector_sums(spark, root)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_increments_with_changes_of_sector(spark, tmp_table):
    assert S.sector_sums(spark, tmp_table).count() == 0
    for at, (accs, units) in enumerate(INCREMENTS):
        frames = spark.createDataFrame(accs, ACC), spark.createDataFrame(units, UNIT)
        assert S.add_increment(tmp_table, f"day{at}", *frames, buckets=4, compact_after=2)
        check(spark, tmp_table, at + 1)
        if at == 1:
            assert not S.add_increment(tmp_table, "day1", *frames)  # a rerun
            check(spark, tmp_table, at + 1)


def test_a_run_that_dies_is_rerun(spark, tmp_table, monkeypatch):
    frames = [(spark.createDataFrame(a, ACC), spark.createDataFrame(u, UNIT)) for a, u in INCREMENTS]
    S.add_increment(tmp_table, "day0", *frames[0])
    real = S.publish_together

    def dies(tables, root):
        tables["unit_year"].write.parquet(f"{root}/unit_year/version=v0-dead")
        raise RuntimeError("lost")

    monkeypatch.setattr(S, "publish_together", dies)
    try:
        S.add_increment(tmp_table, "day1", *frames[1])
    except RuntimeError:
        pass
    monkeypatch.setattr(S, "publish_together", real)
    check(spark, tmp_table, 1)
    assert S.add_increment(tmp_table, "day1", *frames[1])
    check(spark, tmp_table, 2)
