"""Intermediate tables in the session's shared folder, so that lost executors cost no lineage."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commentloom.session import configure, scratch_path


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table and read it back: later steps start from files that all executors can read."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Delete a stored table that no later step reads."""
    spark: SparkSession = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def settle(spark: SparkSession) -> None:
    """Let go of what finished steps leave on the driver: plans, broadcasts and shuffles that nothing refers to.

    Spark's cleaner removes broadcasts and shuffle files once the driver's JVM has collected their handles, which a
    long run of many small plans may put off for very long. The settings that bound a task's batches are made, too.
    """
    configure(spark)
    gc.collect()
    spark._jvm.System.gc()


def numbered(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Rows with a number each. Only fixed once stored: store before using the number twice."""
    return df.withColumn(name, F.monotonically_increasing_id())
