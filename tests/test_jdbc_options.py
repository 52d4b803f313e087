"""JDBC option building (no database is started in tests)."""

import pytest

from firmlens.sources.jdbc import jdbc_options


def test_partitioned_table_read():
    o = jdbc_options("jdbc:postgresql://db/app", table="etablissements_raw",
                     properties={"user": "u", "password": "p"}, partition_column="siret_num",
                     lower_bound=0, upper_bound=1000, num_partitions=16)
    assert o["dbtable"] == "etablissements_raw"
    assert (o["partitionColumn"], o["lowerBound"], o["upperBound"], o["numPartitions"]) == ("siret_num", "0", "1000", "16")
    assert o["user"] == "u" and o["fetchsize"] == "10000"


def test_query_and_table_are_exclusive():
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", table="t", query="select 1")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x")


def test_partitioning_needs_all_parts():
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", table="t", partition_column="id", lower_bound=0)
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", query="select 1", partition_column="id", lower_bound=0, upper_bound=9,
                     num_partitions=2)


def test_write_batch_size():
    o = jdbc_options("jdbc:x", table="t", batch_size=5000, fetch_size=None)
    assert o["batchsize"] == "5000" and "fetchsize" not in o
