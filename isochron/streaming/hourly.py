"""Hourly means as a stream, exact for any order of files, and upserts of hours into a stored fact.

A micro-batch is reduced to a sum and a count per key and hour and written to a folder named by its id. Sums and counts add up,
so the reader gets the same means whatever the order of files and the size of batches; there is no state and no
watermark, no row is too late, and a batch repeated after a failure replaces its own folder.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

PARTIAL = ("ts_utc timestamp", "value_sum double", "n bigint")


def file_stream(spark: SparkSession, path: str, schema: T.StructType, pattern: str = "*.parquet", files_per_batch: int = 1000) -> DataFrame:
    return (
        spark.readStream.schema(schema).option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch).parquet(path)
    )


def hourly_sums(rows: DataFrame, keys: Sequence[str], ts: str, measure: str) -> DataFrame:
    """Sum and count of a measure per key and hour; combined on the map side."""
    hour = F.date_trunc("hour", F.col(ts).cast("timestamp")).alias("ts_utc")
    return rows.groupBy(*keys, hour).agg(F.sum(measure).alias("value_sum"), F.count(measure).alias("n"))


def means_of(sums: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """Add up sums and counts, and divide; an hour without a value has a null mean."""
    total = sums.groupBy(*keys, "ts_utc").agg(F.sum("value_sum").alias("_s"), F.sum("n").alias("n"))
    return total.select(*keys, "ts_utc", F.try_divide("_s", F.col("n").cast("double")).alias(measure), "n")


def windowed_means(stream: DataFrame, keys: Sequence[str], ts: str, measure: str, lateness: str) -> DataFrame:
    """The same as stateful tumbling windows, for sinks that need final rows: rows later than the watermark are dropped."""
    timed = stream.withColumn("_at", F.col(ts).cast("timestamp")).withWatermark("_at", lateness)
    hours = timed.groupBy(*keys, F.window("_at", "1 hour").alias("_hour"))
    return hours.agg(F.avg(measure).alias(measure), F.count(measure).alias("n")).select(
        *keys, F.col("_hour.start").alias("ts_utc"), measure, "n"
    )


def _drain(stream: DataFrame, write, checkpoint: str) -> None:
    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def run_sums(stream: DataFrame, keys: Sequence[str], ts: str, measure: str, target: str, checkpoint: str) -> None:
    """Write the sums of each micro-batch to a folder named by its id."""
    def write(batch: DataFrame, batch_id: int) -> None:
        hourly_sums(batch, keys, ts, measure).write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    _drain(stream, write, checkpoint)


def _schema(keys: Sequence[str], stream: DataFrame, *more: str) -> str:
    own = [f"`{k}` {stream.schema[k].dataType.simpleString()}" for k in keys]
    return ", ".join([*own, *PARTIAL, *more])


def read_means(stream: DataFrame, target: str, keys: Sequence[str], measure: str) -> DataFrame:
    """The means over all batches written so far."""
    logged = stream.sparkSession.read.schema(_schema(keys, stream, "batch bigint")).parquet(target)
    return means_of(logged, keys, measure)


# -- Stateful windows ----------------------------------------------------------------------------------------------------


class _RowCounts(StreamingQueryListener):
    """Rows read and rows left out as too late, for each query and micro-batch."""

    def __init__(self):
        self.batches: dict[str, dict[int, tuple[int, int]]] = {}

    def onQueryProgress(self, event) -> None:
        progress = json.loads(event.progress.json)
        late = sum(state.get("numRowsDroppedByWatermark", 0) for state in progress["stateOperators"])
        read = sum(source["numInputRows"] for source in progress["sources"])
        before = self.batches.setdefault(progress["id"], {})
        before[progress["batchId"]] = (read, late)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass


def run_windows(
    stream: DataFrame, keys: Sequence[str], ts: str, measure: str, lateness: str, target: str, checkpoint: str,
) -> tuple[int, int]:
    """Tumbling hours held in the state store, in update mode: each micro-batch writes the hours it changed to a folder named by its id.

    Returns how many rows came in and how many came later than the watermark and were left out. Without such rows the newest version of each
    hour is the batch result; the watermark, not the length of the stream, bounds the state.
    """
    hours = windowed_means(stream, keys, ts, measure, lateness)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    spark, counts = stream.sparkSession, _RowCounts()
    spark.streams.addListener(counts)
    try:
        query = (
            hours.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()  # progress arrives behind the stream
    finally:
        spark.streams.removeListener(counts)
    batches = counts.batches.get(str(query.id), {}).values()
    return sum(rows for rows, _ in batches), sum(late for _, late in batches)


def read_windows(stream: DataFrame, target: str, keys: Sequence[str], measure: str) -> DataFrame:
    """Each hour as its last micro-batch left it."""
    own = ", ".join(f"`{k}` {stream.schema[k].dataType.simpleString()}" for k in keys)
    rows = stream.sparkSession.read.schema(f"{own}, ts_utc timestamp, `{measure}` double, n bigint, batch bigint").parquet(target)
    newest = rows.groupBy(*keys, "ts_utc").agg(F.max_by(F.struct(measure, "n"), "batch").alias("_last"))
    return newest.select(*keys, "ts_utc", f"_last.{measure}", "_last.n")


# -- Upserts -------------------------------------------------------------------------------------------------------------

MANIFEST = "day string, version bigint"


def manifests(spark: SparkSession, target: str) -> list[int]:
    """The ids of the batches whose manifest is complete, in order."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/manifests")
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return []
    found = [status.getPath() for status in system.listStatus(folder)]
    done = [p.getName() for p in found if system.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(int(name.removeprefix("batch=")) for name in done if name.startswith("batch="))


def write_manifest(named: DataFrame, target: str, batch_id: int) -> None:
    named.coalesce(1).write.mode("overwrite").parquet(f"{target}/manifests/batch={batch_id}")


def manifest(spark: SparkSession, target: str, before: int | None = None) -> DataFrame:
    """day and version: the folder that holds each day, by the newest manifest (below `before`)."""
    ids = [i for i in manifests(spark, target) if before is None or i < before]
    if not ids:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(f"{target}/manifests/batch={ids[-1]}")


def _named_rows(spark: SparkSession, target: str, schema: str, named: DataFrame) -> DataFrame:
    """The rows of the days and versions that a manifest names; version and day are folders, so others are not read."""
    rows = spark.read.schema(schema).parquet(f"{target}/days")
    return rows.join(named, ["day", "version"], "left_semi")


def remove_unnamed(spark: SparkSession, target: str) -> int:
    """Delete the versions of days that the newest manifest does not name, and older manifests and batch sums; gives the number of folders removed.

    Readers that began before the newest manifest may still hold the one before it, so what that one names stays too.
    """
    ids = manifests(spark, target)
    if not ids:
        return 0
    kept_ids = ids[-2:]
    named = {(r["version"], r["day"]) for i in kept_ids for r in spark.read.schema(MANIFEST).parquet(f"{target}/manifests/batch={i}").collect()}
    path, removed = spark._jvm.org.apache.hadoop.fs.Path, 0
    system = path(target).getFileSystem(spark._jsc.hadoopConfiguration())

    def children(folder: str, prefix: str) -> list[str]:
        at = path(f"{target}/{folder}")
        return [s.getPath().getName() for s in system.listStatus(at) if s.getPath().getName().startswith(prefix)] if system.exists(at) else []

    versions = [int(name.removeprefix("version=")) for name in children("days", "version=")]
    for version in [v for v in versions if v <= ids[-1]]:
        days = [name.removeprefix("day=") for name in children(f"days/version={version}", "day=")]
        gone = [day for day in days if (version, day) not in named]
        for day in gone:
            removed += system.delete(path(f"{target}/days/version={version}/day={day}"), True)
        if len(gone) == len(days):
            removed += system.delete(path(f"{target}/days/version={version}"), True)
    for folder in ("manifests", "sums"):
        for name in children(folder, "batch="):
            number = int(name.removeprefix("batch="))
            if number <= ids[-1] and number not in kept_ids:
                removed += system.delete(path(f"{target}/{folder}/{name}"), True)
    return removed


def run_upserts(stream: DataFrame, keys: Sequence[str], ts: str, measure: str, target: str, checkpoint: str) -> None:
    """Keep a fact of hours, partitioned by day: a day reached by a batch is written anew as that batch's version.

    The batch's manifest comes last and names the version of every day; readers follow the newest complete one, so a batch that broke off at any
    point is not seen, and repeated gives the same version again. Nothing that a manifest names is overwritten: a version is made
    from the manifest before it and the batch alone. Versions that are no longer named are removed after the next manifest.
    """
    spark = stream.sparkSession
    schema = _schema(keys, stream, "version bigint", "day string")

    def write(batch: DataFrame, batch_id: int) -> None:
        fresh_path = f"{target}/sums/batch={batch_id}"
        hourly_sums(batch, keys, ts, measure).write.mode("overwrite").parquet(fresh_path)
        fresh = spark.read.schema(_schema(keys, stream)).parquet(fresh_path).withColumn("day", F.date_format("ts_utc", "yyyy-MM-dd"))
        touched = fresh.select("day").distinct()
        before = manifest(spark, target, batch_id)
        rows = fresh
        if manifests(spark, target):
            older = _named_rows(spark, target, schema, before.join(touched, "day", "left_semi"))
            rows = fresh.unionByName(older.drop("version"))
        merged = rows.groupBy(*keys, "ts_utc", "day").agg(F.sum("value_sum").alias("value_sum"), F.sum("n").alias("n"))
        merged.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("day").parquet(f"{target}/days/version={batch_id}")
        named = before.join(touched, "day", "left_anti").unionByName(touched.withColumn("version", F.lit(batch_id).cast("bigint")))
        write_manifest(named, target, batch_id)
        remove_unnamed(spark, target)

    _drain(stream, write, checkpoint)


def read_upserted(stream: DataFrame, keys: Sequence[str], target: str, measure: str) -> DataFrame:
    """The fact as the newest manifest has it: one row per key and hour, with its day."""
    spark = stream.sparkSession
    rows = _named_rows(spark, target, _schema(keys, stream, "version bigint", "day string"), manifest(spark, target))
    mean = F.try_divide("value_sum", F.col("n").cast("double")).alias(measure)
    return rows.select(*keys, "ts_utc", mean, "n", "day")
