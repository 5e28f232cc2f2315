"""Session settings and the shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, **extra: str) -> SparkSession:
    """A session with the engine's settings; master and sizing stay with the cluster unless given."""
    builder = SparkSession.builder.appName("isochron")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Put the runtime settings on a session somebody else built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def own_folder(master: str) -> str:
    """A new folder of this machine, which only a master that runs all tasks on it may use."""
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError(f"spark.checkpoint.dir must name a folder that the driver and all executors share (master {master})")
    return tempfile.mkdtemp(prefix="isochron-")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Without the setting, a local master gets a folder; a cluster is refused."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not context.getCheckpointDir():
        context.setCheckpointDir(named or own_folder(context.master))
    return named or context.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, never used before."""
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write a table to the shared folder, with options of the Parquet writer, and read it back.

    Used where a small result of a large scan feeds several branches: the scan runs once, the branches read
    columns of the result with its true size known, and a lost executor costs only its own tasks.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
