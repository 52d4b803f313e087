"""Folders of table files on a shared file system: existence, reading by declared schema, listing, deletion.

Everything goes through the file system that Spark itself uses for the path.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def _folder(spark: SparkSession, path: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(conf), folder


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table folder exists; any failure other than its absence is raised."""
    try:
        spark.sparkContext  # noqa: B018
    except Exception:  # Spark Connect has no gateway: ask by resolving the folder
        return _resolves(spark, path)
    fs, folder = _folder(spark, path)
    return bool(fs.exists(folder))


def _resolves(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.schema("x int").parquet(path)
        return True
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return False


def read_table(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet") -> DataFrame:
    """A table by its declared schema. A folder that is missing, empty, or holds only the rest
    of a write that died is a table without rows."""
    if not table_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).format(fmt).load(path)


def sub_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly in a folder (none if it doesn't exist)."""
    fs, folder = _folder(spark, path)
    if not fs.exists(folder):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory())


def file_status(spark: SparkSession, uri: str) -> tuple[int, int]:
    """Size and time of change of a file, by its URI as Spark lists it."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))
    status = path.getFileSystem(conf).getFileStatus(path)
    return status.getLen(), status.getModificationTime()


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, folder = _folder(spark, path)
    fs.delete(folder, True)
