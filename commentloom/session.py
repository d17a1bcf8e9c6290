"""Session helpers: a recommended builder and the shared scratch location."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Run-time settings that the operators count on; all can be set on a live session.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rows of long texts are many bytes: a batch that a Python task holds is bounded by both.
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
    # An overwrite of a declared table replaces the weeks or buckets that it writes, not the whole table.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can read.

    The session names it in ``spark.checkpoint.dir``. Without that setting a folder below the
    warehouse is taken: every session has one. On a cluster it has to be shared storage, so a warehouse on the driver's own
    disk is refused there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_commentloom"
        if folder.startswith(("file:", "/")) and not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can read")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
