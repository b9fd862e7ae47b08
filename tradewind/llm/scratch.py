"""Large intermediate tables that are removed as soon as they have been used up."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tradewind.session import scratch_path


def stored(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``df`` written to the shared folder, tightly packed, and read again; and where it lies."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def removed(spark: SparkSession, path: str) -> None:
    """Remove a stored table that nothing reads any more."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """In this block the shuffle files of a query are removed when it ends, not when the driver
    happens to collect its garbage. For steps that are written and read again, each run once."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)
