"""Session settings and the shared folder that intermediate tables go to."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
MAX_BATCH_BYTES = 4 << 20

_local_dirs: dict[str, str] = {}
_shipped: set[str] = set()


def local_session(cores: int | str = "*", app: str = "newslens", **conf: str) -> SparkSession:
    """Session for tests and benchmarks; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_settings(shuffled_bytes: int, cores: int) -> dict[str, str]:
    """Settings for a job whose widest shuffle moves `shuffled_bytes` on `cores` cores.

    Shuffles start with partitions of about 128 MB, at least two per core, and adaptive
    execution merges those that turn out small. For link features the widest shuffle is one
    row of some 200 bytes per post, whatever the length of its text. Scans are cut at 64 MB:
    cleaning and splitting a text costs more than reading it.
    """
    partitions = max(2 * cores, -(-shuffled_bytes // (128 << 20)))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(64 << 20),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (`spark.checkpoint.dir`), or a temporary one in local mode."""
    context = spark.sparkContext
    named = context.getConf().get(CHECKPOINT_DIR) or spark.conf.get(CHECKPOINT_DIR, None)
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    app = context.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="newslens-")
    return _local_dirs[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has been written to."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/newslens-{app}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read back: a short lineage that outlives executors."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def enable_checkpoints(spark: SparkSession) -> None:
    """Let iterative fits cut their lineage in the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, whatever folder they run in.

    Batches to the workers are cut by bytes, as rows may hold whole texts, unless the session says how.
    """
    context = spark.sparkContext
    if BATCH_BYTES not in spark.conf.getAll:
        spark.conf.set(BATCH_BYTES, str(MAX_BATCH_BYTES))
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="newslens-"), "newslens_package.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
