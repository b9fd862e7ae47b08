"""Session settings, and the shared folder for data that must outlive an executor."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Timestamps are UTC and strict casts must raise, so both are pinned. Skewed sort-merge
# joins are split at run time even where that costs another shuffle further up: a key that
# holds a third of the rows would otherwise land in one task. A large ordered LIMIT is
# planned as a distributed sort instead of a per-task heap merged in one place.
# Broadcast joins are never forced: Spark picks them, by its own size check
# (spark.sql.autoBroadcastJoinThreshold) on file sizes and on shuffle statistics.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.topKSortFallbackThreshold": "10000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings the library relies on."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str, cpus: int | str = "*", partitions: int = 8, **extra: str) -> SparkSession:
    """A single-machine session, for tests and the benchmark.

    Its tables are single files of one row group, which one task reads; a low broadcast
    limit makes fact tables shuffle, so that the work after the scan is spread.
    """
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.autoBroadcastJoinThreshold", "1MB")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by spark.checkpoint.dir."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tradewind-")  # one machine only: gone when it ends
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_root(spark: SparkSession) -> str:
    """The folder of this application's intermediate data, below the shared folder."""
    return f"{shared_dir(spark)}/tradewind/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for intermediate data of this application."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of any file system; none if it does not exist."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in system.listStatus(where)] if system.exists(where) else []


def remove_folder(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def drop_scratch(spark: SparkSession) -> None:
    """Remove all intermediate data of this application.

    For the end of a run: frames that have not been written elsewhere can no longer be read.
    """
    remove_folder(spark, scratch_root(spark))


def keep(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage, keeps column pruning (unlike an RDD checkpoint), and gives the planner
    the real size of the result, so its broadcast decision rests on bytes that exist.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
