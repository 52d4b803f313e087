"""JDBC sources and sinks (S1, S2, K2, K3 over a database).

Reads are partitioned: given a numeric or date column and its bounds, Spark opens
``num_partitions`` connections, each reading one stride. Filters are written as DataFrame
predicates and Catalyst pushes them into the generated SQL (``PushedFilters``), so no SQL
text is assembled by hand; a sub-query can still be given for what predicates cannot say.
Connection settings and credentials always come from the caller.

No query in the catalogue reads a database: the test environment may not start one (not
even an embedded one), so these functions are covered by option-building unit tests only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .sinks import not_stored, one_per_key


def jdbc_options(
    url: str,
    table: str | None = None,
    query: str | None = None,
    properties: Mapping[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound: object = None,
    upper_bound: object = None,
    num_partitions: int | None = None,
    fetch_size: int | None = 10_000,
    batch_size: int | None = None,
) -> dict[str, str]:
    """Options for ``format("jdbc")``. Exactly one of ``table`` (a table name or a
    parenthesised sub-query with an alias) and ``query`` is required; partitioning needs the
    column, both bounds and the partition count together."""
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table= or query=")
    opts: dict[str, str] = {"url": url}
    if table is not None:
        opts["dbtable"] = table
    else:
        opts["query"] = query  # type: ignore[assignment]
    part = (partition_column, lower_bound, upper_bound, num_partitions)
    if any(p is not None for p in part):
        if any(p is None for p in part):
            raise ValueError("partitioned read needs partition_column, lower_bound, upper_bound, num_partitions")
        if query is not None:
            raise ValueError("partitioned reads need table=, not query=")
        opts.update(
            partitionColumn=str(partition_column),
            lowerBound=str(lower_bound),
            upperBound=str(upper_bound),
            numPartitions=str(num_partitions),
        )
    if fetch_size:
        opts["fetchsize"] = str(fetch_size)
    if batch_size:
        opts["batchsize"] = str(batch_size)
    for k, v in (properties or {}).items():
        opts[k] = str(v)
    return opts


def read_jdbc(spark: SparkSession, predicate: Column | None = None, columns: Sequence[str] | None = None,
              **options) -> DataFrame:
    """Scan a table (optionally partitioned), then filter and prune with DataFrame
    operations that the JDBC source pushes into the database query."""
    df = spark.read.format("jdbc").options(**jdbc_options(**options)).load()
    if predicate is not None:
        df = df.where(predicate)
    if columns is not None:
        df = df.select(*columns)
    return df


def read_jdbc_subquery(spark: SparkSession, url: str, sql: str, alias: str = "q", **options) -> DataFrame:
    """S2 (legacy form): a parenthesised sub-query as the table."""
    return read_jdbc(spark, url=url, table=f"({sql}) {alias}", **options)


def jdbc_bounds(spark: SparkSession, url: str, table: str, column: str,
                properties: Mapping[str, str] | None = None) -> tuple[object, object]:
    """Min and max of the partition column, read with one small aggregate query (one row)."""
    df = read_jdbc(spark, url=url, table=table, properties=properties)
    row = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).first()
    return row["lo"], row["hi"]


def append_jdbc_new(df: DataFrame, keys: Sequence[str], url: str, table: str,
                    properties: Mapping[str, str] | None = None, batch_size: int = 10_000) -> None:
    """K2: append only rows whose key is not yet in the target table, so a rerun after a
    failure adds nothing twice (a plain append would duplicate). Null key parts match null."""
    spark = df.sparkSession
    existing = read_jdbc(spark, url=url, table=table, properties=properties, columns=list(keys))
    batch = materialize(one_per_key(df, list(keys)), "append_batch")
    new = not_stored(batch, existing, list(keys))
    (new.write.format("jdbc").options(**jdbc_options(url, table=table, properties=properties,
                                                     batch_size=batch_size, fetch_size=None))
     .mode("append").save())


def replace_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None,
                 batch_size: int = 10_000) -> None:
    """K3: replace the table's content (truncate keeps the table definition and grants)."""
    (df.write.format("jdbc")
     .options(**jdbc_options(url, table=table, properties=properties, batch_size=batch_size, fetch_size=None))
     .option("truncate", "true").mode("overwrite").save())
