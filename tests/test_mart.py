"""The stored mart: what a run rewrites, and that it always equals the mart built anew."""

import datetime as dt
import os
import shutil

import pytest
from pyspark.sql import functions as F

from firmlens.plans import mart as M
from firmlens.plans.dashboard import C, dashboard_mart
from firmlens.sources.tables import sub_folders

from .test_plans import plan

ETAB = ("siret string, siren string, libellecommuneetablissement string, coordonneelambertabscisseetablissement double, "
        "coordonneelambertordonneeetablissement double, note int")
UNIT = "siren string, activiteprincipaleunitelegale string, denominationunitelegale string, categorieentreprise string, anneecategorieentreprise double"


def etab(n, place, unit, note=0):
    return (f"{n:03d}", unit, place, 650000.0 + n, 6850000.0, note)


ETABS = [etab(n, p, u) for n, (p, u) in enumerate([("A", "1"), ("A", "2"), ("B", "2"), ("B", "3"), ("C", "4"), (None, "1"), ("D d", None), ("E", "9")])]
UNITS = [("1", "01", "one", "PME", 2020.0), ("2", "02", "two", "PME", 2020.0), ("3", "01", None, None, None), ("4", None, "four", "GE", 2021.0)]
NAF = [("01", "farms"), ("02", "mines")]


class Inputs:
    """Input tables as folders of files, which a test replaces."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        self.put("etab", ETABS, ETAB), self.put("ul", UNITS, UNIT), self.put("naf", NAF, "code string, libelle string")

    def put(self, name, rows, schema):
        self.spark.createDataFrame(rows, schema).repartition(2).write.mode("overwrite").parquet(f"{self.root}/{name}")

    def frames(self):
        return [self.spark.read.parquet(f"{self.root}/{n}") for n in ("etab", "ul", "naf")]

    def refresh(self, **how):
        done = M.refresh_mart(*self.frames(), f"{self.root}/mart", **how)
        want = dashboard_mart(*self.frames())
        got = M.read_fresh_mart(self.spark, f"{self.root}/mart", want.schema)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
        return done


@pytest.fixture()
def inputs(spark, tmp_table):
    return Inputs(spark, tmp_table)


def test_built_once_and_then_only_where_touched(inputs):
    assert inputs.refresh() == M.Refresh("built")
    assert inputs.refresh() == M.Refresh("unchanged")
    changed = [etab(0, "A", "1", note=7), *ETABS[1:]]
    inputs.put("etab", changed, ETAB)
    assert inputs.refresh() == M.Refresh("updated", 1)
    inputs.put("etab", changed, ETAB)  # the same rows in other files
    assert inputs.refresh() == M.Refresh("updated", 0)
    assert inputs.refresh() == M.Refresh("unchanged")
    assert len(sub_folders(inputs.spark, f"{inputs.root}/mart/rows")) == 3  # one of each run that wrote


def test_units_and_labels_touch_the_places_of_their_establishments(inputs):
    inputs.refresh()
    inputs.put("ul", [*UNITS[:1], ("2", "01", "two", "PME", 2020.0), *UNITS[2:]], UNIT)
    assert inputs.refresh().places == 2  # A and B
    inputs.put("naf", [("01", "farms"), ("02", "pits"), ("03", "new")], "code string, libelle string")
    assert inputs.refresh().places == 0  # no unit is in sector 02 any more
    inputs.put("naf", [("01", "fields")], "code string, libelle string")
    assert inputs.refresh().places == 3  # units 1, 2 and 3: A, B and no place


def test_rows_that_come_go_and_move(inputs):
    inputs.refresh()
    inputs.put("etab", ETABS[:4] + ETABS[5:] + [etab(20, "F", "4")], ETAB)  # the last of C is gone, F is new
    assert inputs.refresh().places == 2
    inputs.put("etab", [etab(0, "B", "1"), *ETABS[1:4], *ETABS[5:]], ETAB)  # from A to B, F gone
    assert inputs.refresh().places == 3
    inputs.put("etab", [*ETABS[:5], ETABS[0], etab(5, None, "4"), *ETABS[6:]], ETAB)  # a row twice, a null place
    assert inputs.refresh().kind == "updated"
    inputs.put("etab", ETABS[:0], ETAB)
    assert inputs.refresh().kind == "updated"


def test_written_anew_after_so_many_runs_and_when_files_are_gone(inputs):
    assert inputs.refresh(parts=2, keep=dt.timedelta(0)).kind == "built"
    for note, kind in ((1, "updated"), (2, "built"), (3, "updated")):
        inputs.put("etab", [etab(0, "A", "1", note), *ETABS[1:]], ETAB)
        assert inputs.refresh(parts=2, keep=dt.timedelta(0)).kind == kind
    assert len(sub_folders(inputs.spark, f"{inputs.root}/mart/rows")) == 2
    shutil.rmtree(f"{inputs.root}/mart/rows")
    assert inputs.refresh().kind == "built"


def test_a_run_that_dies_changes_nothing(inputs, monkeypatch):
    inputs.refresh()
    before = inputs.spark.read.parquet(f"{inputs.root}/etab").collect()
    inputs.put("etab", [etab(0, "Z", "1"), *ETABS[1:]], ETAB)
    real = M.publish_together

    def dies(*a, **b):
        raise RuntimeError("lost")

    monkeypatch.setattr(M, "publish_together", dies)
    with pytest.raises(RuntimeError):
        M.refresh_mart(*inputs.frames(), f"{inputs.root}/mart")
    schema = dashboard_mart(*inputs.frames()).schema
    assert "Z" not in {r.libellecommuneetablissement for r in M.read_fresh_mart(inputs.spark, f"{inputs.root}/mart", schema).collect()} and before
    monkeypatch.setattr(M, "publish_together", real)
    assert inputs.refresh() == M.Refresh("updated", 2)


def test_a_scope_reads_its_places_files(inputs):
    inputs.refresh()
    inputs.put("etab", [etab(0, "A", "1", note=7), *ETABS[1:]], ETAB)
    inputs.refresh()
    schema = dashboard_mart(*inputs.frames()).schema
    scoped = M.read_fresh_mart(inputs.spark, f"{inputs.root}/mart", schema).where(F.col(C.place) == "A")
    assert "PartitionFilters: [isnotnull(libellecommuneetablissement" in plan(scoped) and scoped.count() == 2
    assert os.path.exists(f"{inputs.root}/mart/rows")


def test_hashes_are_written_once_and_without_a_shuffle(inputs):
    frames = inputs.frames()
    assert "Exchange" not in M._hashes(*frames, C)._jdf.queryExecution().executedPlan().toString()
    inputs.refresh()
    inputs.put("etab", [*ETABS, ETABS[0]], ETAB)  # a row twice: only its place is written anew
    assert inputs.refresh() == M.Refresh("updated", 1)
    made = [p for p in M.live_parts(inputs.spark, f"{inputs.root}/mart") if p.name == "hashes"]
    assert len(made) == 1
