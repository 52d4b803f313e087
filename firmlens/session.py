"""Session helpers: shared working folders and the settings our plans rely on.

The library never creates its own session for production use; callers pass theirs.
``local_session`` exists for tests, the bench and the smoke entry point.
"""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide working folder named by ``spark.checkpoint.dir``.

    On a cluster this is a shared file system (HDFS, object store), so files written there
    survive the loss of any executor; without the setting a cluster session is an error.
    Only a single-machine session (``local[...]``) falls back to a temporary folder, which
    its Spark context keeps as checkpoint folder.
    """
    path = spark.conf.get(_CHECKPOINT_KEY, None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: only the setting can name the folder
        sc = None
    if not path and sc is not None:
        path = sc.getCheckpointDir()
    if not path:
        if sc is None or not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="firmlens-")
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path.rstrip("/")


_open_runs: list[list[str]] = []


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared working folder for one run of one job."""
    path = f"{shared_dir(spark)}/firmlens/{name}/{uuid.uuid4().hex}"
    for block in _open_runs:
        block.append(path)
    return path


@contextlib.contextmanager
def working_folders(spark: SparkSession):
    """Delete, at the end of the block, every folder that ``run_dir`` gave out within it.

    Frames returned by the plans read such folders lazily: write or collect them inside the
    block."""
    made: list[str] = []
    _open_runs.append(made)
    try:
        yield
    finally:
        _open_runs.remove(made)
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for path in made:
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(conf).delete(folder, True)


def materialize(df: DataFrame, name: str = "materialized") -> DataFrame:
    """Compute a (small, reused) intermediate result once and cut its lineage.

    The frame is written once as a Parquet table in a fresh folder of the shared working
    folder and read back: one job reads the input, later plans read the table (which
    survives executor loss and carries size statistics, so the planner can still choose
    broadcast joins on it). Used where one aggregate feeds several branches that the
    optimizer would otherwise recompute separately (filters pushed into each branch).
    """
    spark = df.sparkSession
    path = run_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


MAX_PARTITIONS = 20_000


def recommended_conf(input_bytes: int, executor_cores: int = 4, executor_memory_gb: int = 16) -> dict[str, str]:
    """Settings for a cluster run over ``input_bytes`` of Parquet input.

    Scan splits of 256 MB. Shuffles here carry rows that are pre-aggregated or projected, far
    fewer bytes than the input, so they start with one partition per GB of input, between
    200 and ``MAX_PARTITIONS`` (map tasks times partitions is state that the driver keeps);
    AQE coalesces them towards 256 MB or splits skewed ones, so a task's shuffle block
    stays below executor memory per core (``executor_memory_gb / executor_cores``).
    """
    mb = 1024 * 1024
    initial = min(MAX_PARTITIONS, max(200, input_bytes // (1024 * mb)))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * mb),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * mb),
        "spark.sql.files.maxPartitionBytes": str(256 * mb),
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * mb),
        "spark.executor.cores": str(executor_cores),
        "spark.executor.memory": f"{executor_memory_gb}g",
        "spark.sql.session.timeZone": "UTC",
    }


def tune(spark: SparkSession) -> SparkSession:
    """Settings the plans are designed around (all are Spark defaults in 4.x except the
    time zone); applied by tests and the bench, harmless on a cluster session."""
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("firmlens")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)
