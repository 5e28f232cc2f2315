"""Stored tables: scans with a declared schema, optional tables, legacy calendars, incremental reads, and sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isochron.session import fresh_path


def scan(spark: SparkSession, path: str, schema: T.StructType | str | None = None, legacy_calendar: bool = False) -> DataFrame:
    """Parquet files or directories. A given schema saves the footer inference; legacy_calendar rebases old timestamps."""
    reader = spark.read
    if legacy_calendar:
        reader = reader.option("datetimeRebaseMode", "LEGACY").option("int96RebaseMode", "LEGACY")
    return (reader.schema(schema) if schema is not None else reader).parquet(path)


def scan_optional(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame | None:
    """The table, or None where there is none."""
    try:
        return scan(spark, path, schema)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def catalog_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def drain_new_files(
    spark: SparkSession, path: str, schema: T.StructType, target: str, checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df, pattern: str = "*.parquet", files_per_batch: int = 1000,
) -> DataFrame:
    """Append the files that arrived since the last call to the target and return the whole target.

    The checkpoint remembers which files are done, so a repeated call, also after a crash, adds nothing twice.
    """
    stream = (
        spark.readStream.schema(schema).option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch).parquet(path)
    )
    query = (
        transform(stream).writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(target)
    )
    query.awaitTermination()
    return spark.read.schema(transform(spark.createDataFrame([], schema)).schema).parquet(target)


def drain_once(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    """drain_new_files into fresh folders below the shared folder."""
    return drain_new_files(
        spark, path, schema, fresh_path(spark, "drained"), fresh_path(spark, "drain-checkpoint"), **options
    )


def write_table(df: DataFrame, path: str, name: str | None = None) -> None:
    """Overwrite a Parquet table; with a name it is also entered in the catalog."""
    writer = df.write.mode("overwrite").option("compression", "snappy")
    if name:
        writer.option("path", path).saveAsTable(name)
    else:
        writer.parquet(path)


def write_partitioned(df: DataFrame, path: str, by: str = "region_clean", salt: Column | None = None, files_per_value: int = 8) -> None:
    """Overwrite only the partitions present in the rows, so that a re-run replaces and never duplicates.

    Rows are spread by partition value and a salt: each value gets up to files_per_value writers, however many
    rows it holds, and tasks do not open a file for every value.
    """
    salt = salt if salt is not None else F.pmod(F.xxhash64(*[c for c in df.columns if c != by]), F.lit(files_per_value))
    spread = df.withColumn("_salt", salt).repartition(F.col(by), F.col("_salt")).drop("_salt")
    (
        spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy").partitionBy(by).parquet(path)
    )


def append_run(df: DataFrame, path: str, run_ts: str) -> None:
    """Append the rows of one run under a partition of its own; repeating the run replaces it."""
    stamped = df.withColumn("run_ts", F.lit(run_ts))
    stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_ts").parquet(path)


def write_sample(df: DataFrame, path: str, rows: int = 100) -> None:
    """A small CSV with header for inspection; the limit is the point of it."""
    df.limit(rows).coalesce(1).write.mode("overwrite").option("header", True).csv(path)
