"""Every registered query against its DuckDB oracle on the smallest scale (row count,
column names and the multiset of values)."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as E
from firmlens import catalog
from firmlens.roles import TABLES

from .conftest import SMALL


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _rows(rs):
    return sorted((tuple(_norm(x) for x in r) for r in rs), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLE)
    assert set(catalog.QUERIES) <= set(E.queries()) and set(catalog.ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("key", sorted(catalog.ORACLE))
def test_query_matches_oracle(spark, duck, key):
    sdf = E.queries()[key](spark, SMALL)
    cols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(E.oracle_sql()[key])
    dcols = [c[0] for c in res.description]
    assert sorted(cols) == sorted(dcols)
    drows = [tuple(r[dcols.index(c)] for c in cols) for r in res.fetchall()]
    assert _rows(srows) == _rows(drows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 5 and [r.evol_pct for r in rows] == sorted((r.evol_pct for r in rows), reverse=True)
