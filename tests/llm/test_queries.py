"""Registered queries against their DuckDB statements, and the shape of the registration."""

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from firmlens.llm import queries
from firmlens.roles import TABLES

from ..conftest import SMALL


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    yield con
    con.close()


@pytest.mark.parametrize("key", sorted(queries.ORACLE))
def test_query_equals_sql(spark, duck, key):
    got = queries.QUERIES[key](spark, SMALL)
    cols = sorted(got.columns)
    found = sorted((tuple(r[c] for c in cols) for r in got.collect()), key=repr)
    res = duck.execute(queries.ORACLE[key])
    names = [c[0] for c in res.description]
    assert sorted(names) == cols
    assert found == sorted((tuple(r[names.index(c)] for c in cols) for r in res.fetchall()), key=repr)


def test_one_query_per_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES) == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(E.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontaminate", "bpe"]
