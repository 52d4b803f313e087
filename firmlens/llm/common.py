"""Small helpers shared by the operators of this subpackage."""

from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmlens.session import run_dir

__all__ = ["read", "stored", "binary_column", "arrow_map", "map_batches", "group_batches", "stream_groups", "vector_function", "annotate", "components"]


SLICE_ROWS = 512


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str, parts: int | None = None, path: str | None = None, **options: str) -> DataFrame:
    """Write ``df`` once to a fresh table in the shared working folder (or to ``path``) and read it back:
    cuts the lineage, survives lost executors. ``parts``: in so many files and tasks at most."""
    path = path or run_dir(df.sparkSession, name)
    df = df if parts is None else df.coalesce(parts)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def binary_column(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """A string column as UTF-8 bytes."""
    return batch.column(name).cast(pa.binary()).to_pylist()


def _share_package_path(spark: SparkSession) -> None:
    """Python workers look for this package where the driver found it (the same shared path on a
    cluster, unless it is installed there or sent with ``--py-files``)."""
    root, env = str(Path(__file__).parents[2]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(x for x in (env.get("PYTHONPATH"), root) if x)


def arrow_map(df: DataFrame, rows: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Apply a batch function in Arrow batches, keeping the partitioning; few rows at a time, so that a
    worker holds Python objects of no more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                yield rows(batch.slice(at, SLICE_ROWS))

    return map_batches(df, run, schema)


def map_batches(
    df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    _share_package_path(df.sparkSession)
    return df.mapInArrow(run, schema)


def group_batches(df: DataFrame, keys: list[str], group: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """Apply a function to the rows of each (bounded) group."""
    _share_package_path(df.sparkSession)
    return df.groupBy(*keys).applyInArrow(lambda t: group(t), schema)


def stream_groups(df: DataFrame, keys: list[str], group: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """Apply a function to the rows of each (bounded, mostly tiny) group: partitions are sorted by
    key and streamed, so that a group costs no more than a slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            t = pa.Table.from_batches([batch])
            if not len(t):
                continue
            values = np.stack([t.column(c).to_numpy() for c in keys])
            cuts = [0, *(np.nonzero((values[:, 1:] != values[:, :-1]).any(axis=0))[0] + 1), len(t)]
            for at, to in zip(cuts, cuts[1:]):
                part = t.slice(at, to - at)
                if held and any(held[0].column(c)[0] != part.column(c)[0] for c in keys):
                    yield from group(pa.concat_tables(held)).to_batches()
                    held = []
                held.append(part)
        if held:
            yield from group(pa.concat_tables(held)).to_batches()

    return map_batches(df.repartition(*keys).sortWithinPartitions(*keys), run, schema)


def vector_function(spark: SparkSession, f: Callable, kind: str):
    """A column function from a numpy array to another; only its argument goes to Python."""
    import pandas as pd  # here: the workers of the other operators do without its memory

    _share_package_path(spark)

    def run(v: pd.Series) -> pd.Series:
        return pd.Series(f(v.to_numpy()))

    return F.pandas_udf(run, kind)


def annotate(
    df: DataFrame, text: str, fields: str, compute: Callable[[list[bytes | None]], list[pa.Array]]
) -> DataFrame:
    """``df`` as ``doc`` (a struct of all its columns, so that no name can clash) and the columns
    ``fields`` (DDL) that ``compute`` makes from the texts of a batch (UTF-8 bytes)."""
    packed = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("doc"))
    place = df.columns.index(text)
    names = [f.split()[0] for f in fields.split(", ")]

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        doc = batch.column("doc")
        texts = doc.field(place).cast(pa.binary()).to_pylist()
        return pa.RecordBatch.from_arrays([doc, *compute(texts)], names=["doc", *names])

    return arrow_map(packed, rows, f"doc {packed.schema['doc'].dataType.simpleString()}, {fields}")


def components(edges: DataFrame, name: str = "components", rounds: int | None = None, parts: int | None = None) -> DataFrame:
    """Connected components of ``edges(a, b)``: ``(node, root)`` with the smallest node of the
    component as root, for every node that has an edge.

    Large-star / small-star rounds until the edge set no longer changes. A hub's minimum
    is a partially aggregated ``min``; the join that hands it to the hub's edges can be
    split by adaptive skew handling. Every round is a stored table; only two numbers (edge
    count and checksum) come to the driver. With ``rounds``, so many only: roots of parts of the
    components, cheaper. ``parts`` as in ``stored``, for the edges.
    """
    e = stored(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), name, parts
    )

    def signature(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())

    last, done = signature(e), 0
    while last[0] and done != rounds:
        # large-star: hand every larger neighbour the smallest one
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small-star: hand every smaller neighbour and the node itself the smallest one
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        found = small.unionByName(low.withColumnRenamed("m", "v")).where("u <> v").distinct()
        e, done = stored(found, name, 8 + last[0] // 200_000), done + 1  # tasks follow the edges
        now = signature(e)
        if now == last:
            break
        last = now
    roots = e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    return roots.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()) if rounds is None else roots
