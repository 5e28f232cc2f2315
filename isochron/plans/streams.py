"""Registered queries: streams over the events file, drained once and compared with the batch result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isochron.operators import panel, probes
from isochron.plans import inputs
from isochron.plans.registry import query
from isochron.session import fresh_path
from isochron.streaming import hourly

KEYS = ["region_clean"]
SQL_HOURS = """
SELECT event_type AS region_clean, date_trunc('hour', ts) AS ts_utc, avg(value) AS value, count(value) AS n FROM events GROUP BY 1, 2"""


def _events(spark: SparkSession, sf: str) -> DataFrame:
    schema = T.StructType.fromDDL(inputs.SCHEMAS["events"])
    return hourly.file_stream(spark, sf, schema, pattern="events.parquet").withColumnRenamed("event_type", "region_clean")


@query(SQL_HOURS, rounded=["value"])
def stream_hourly_agg(spark: SparkSession, sf: str) -> DataFrame:
    """Sums and counts per micro-batch, added up when read."""
    stream, target = _events(spark, sf), fresh_path(spark, "hourly-sums")
    hourly.run_sums(stream, KEYS, "ts", "value", target, fresh_path(spark, "hourly-checkpoint"))
    return hourly.read_means(stream, target, KEYS, "value")


@query(f"SELECT *, ts_utc::DATE::VARCHAR AS day FROM ({SQL_HOURS})", rounded=["value"])
def stream_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """The same hours upserted into a fact partitioned by day."""
    stream, target = _events(spark, sf), fresh_path(spark, "hourly-fact")
    hourly.run_upserts(stream, KEYS, "ts", "value", target, fresh_path(spark, "upsert-checkpoint"))
    return hourly.read_upserted(stream, KEYS, target, "value")


@query(SQL_HOURS, rounded=["value"])
def stream_windowed_agg(spark: SparkSession, sf: str) -> DataFrame:
    """The same hours as windows in the state store, the lateness above the spread of the events."""
    stream, target = _events(spark, sf), fresh_path(spark, "hourly-windows")
    hourly.run_windows(stream, KEYS, "ts", "value", "365 days", target, fresh_path(spark, "window-checkpoint"))
    return hourly.read_windows(stream, target, KEYS, "value")


@query("""
WITH hours AS (SELECT event_type, date_trunc('hour', ts) AS h, avg(value) AS value FROM events WHERE event_type <> 'error' GROUP BY 1, 2)
SELECT 'raw' AS step, count(*) AS rows, count(*) FILTER (value IS NULL) AS null_values FROM events
UNION ALL SELECT 'kept', count(*), count(*) FILTER (value IS NULL) FROM events WHERE event_type <> 'error'
UNION ALL SELECT 'hourly', count(*), count(*) FILTER (value IS NULL) FROM hours
UNION ALL SELECT 'stream', count(*), count(*) FILTER (value IS NULL) FROM events""")
def probe_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Probes of three steps of one write, and of the micro-batches of a stream, read from their stored table."""
    log, target = probes.Probes(spark, "counts"), fresh_path(spark, "probed")
    rows = inputs.events(spark, sf).withColumnRenamed("event_type", "region_clean")
    kept = log.watch(log.watch(rows, "raw", "value").where("region_clean <> 'error'"), "kept", "value")
    log.write(panel.mean_by_step(kept, KEYS, "ts", ["value"]), f"{target}/hours", "hourly", "value")
    stream = log.watch(_events(spark, sf), "stream", "value")
    with log.listening():
        hourly.run_sums(stream, KEYS, "ts", "value", f"{target}/sums", fresh_path(spark, "probe-checkpoint"))
    log.store(f"{target}/probes")
    found = probes.read(spark, f"{target}/probes").groupBy("step").agg(
        F.sum("rows").alias("rows"), F.sum(F.element_at("nulls", F.lit("value"))).alias("null_values")
    )
    return found
