import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from isochron.streaming import hourly

SCHEMA = "region_clean string, ts timestamp, value double"
KEYS = ["region_clean"]
T0 = dt.datetime(2024, 1, 1)


def add_file(spark, path, rows):
    data = [(k, T0 + dt.timedelta(minutes=m), None if v is None else float(v)) for k, m, v in rows]
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def hours(df):
    return {(r["region_clean"], int((r["ts_utc"] - T0).total_seconds() // 3600)): (r["value"], r["n"]) for r in df.collect()}


def test_sums_take_rows_of_any_age(spark, tmp_path):
    source, log, checkpoint = (str(tmp_path / d) for d in ("in", "log", "checkpoint"))

    def run():
        stream = hourly.file_stream(spark, source, SCHEMA)
        hourly.run_sums(stream, KEYS, "ts", "value", log, checkpoint)
        return hours(hourly.read_means(stream, log, KEYS, "value"))

    add_file(spark, source, [("a", 10, 1), ("a", 20, 3), ("b", 70, 5), ("b", 130, None)])
    assert run() == {("a", 0): (2.0, 2), ("b", 1): (5.0, 1), ("b", 2): (None, 0)}
    add_file(spark, source, [("a", 500_000, 7)])
    assert run()["a", 0] == (2.0, 2)
    add_file(spark, source, [("a", 30, 8)])  # a year behind the newest row
    assert run()["a", 0] == (4.0, 3)


def write_newest_first(spark, small_dir, source):
    """The events as one file per range of time, the newest file written first."""
    events = spark.read.parquet(f"{small_dir}/events.parquet").select(
        F.col("event_type").alias("region_clean"), F.col("ts").cast("timestamp").alias("ts"), "value")
    bounds = events.select(F.percentile_approx(F.unix_seconds("ts"), [0.2, 0.4, 0.6, 0.8])).first()[0]
    low = [None, *bounds]
    high = [*bounds, None]
    for age, (a, b) in enumerate(reversed(list(zip(low, high)))):
        at = F.unix_seconds("ts")
        part = events.where((at >= a) if a is not None else F.lit(True)).where((at < b) if b is not None else F.lit(True))
        part.coalesce(1).write.mode("append").parquet(source)
        for name in os.listdir(source):
            if name.endswith(".parquet"):
                path = os.path.join(source, name)
                if os.path.getmtime(path) > 10**9 + 10:
                    os.utime(path, (10**9 - 1000 + age, 10**9 - 1000 + age))
    return events


def batch_result(events):
    return events.groupBy("region_clean", F.date_trunc("hour", "ts").alias("ts_utc")).agg(
        F.round(F.avg("value"), 6).alias("value"), F.count("value").alias("n"))


def test_newest_first_files_equal_batch(spark, tmp_path, small_dir):
    source, log, checkpoint = (str(tmp_path / d) for d in ("in", "log", "checkpoint"))
    events = write_newest_first(spark, small_dir, source)
    stream = hourly.file_stream(spark, source, SCHEMA, files_per_batch=1)
    hourly.run_sums(stream, KEYS, "ts", "value", log, checkpoint)
    assert len([d for d in os.listdir(log) if d.startswith("batch=")]) == 5
    streamed = hourly.read_means(stream, log, KEYS, "value").withColumn("value", F.round("value", 6))
    batch = batch_result(events)
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_newest_first_upserts_equal_batch(spark, tmp_path, small_dir):
    source, fact, checkpoint = (str(tmp_path / d) for d in ("in", "fact", "checkpoint"))
    events = write_newest_first(spark, small_dir, source)
    stream = hourly.file_stream(spark, source, SCHEMA, files_per_batch=2)
    hourly.run_upserts(stream, KEYS, "ts", "value", fact, checkpoint)
    found = hourly.read_upserted(stream, KEYS, fact, "value").drop("day").withColumn("value", F.round("value", 6))
    batch = batch_result(events)
    assert found.exceptAll(batch).count() == 0 and batch.exceptAll(found).count() == 0


def test_upserts_rewrite_only_touched_days(spark, tmp_path):
    source, fact, checkpoint = (str(tmp_path / d) for d in ("in", "fact", "checkpoint"))

    def run():
        stream = hourly.file_stream(spark, source, SCHEMA)
        hourly.run_upserts(stream, KEYS, "ts", "value", fact, checkpoint)
        return {(r["day"], r["ts_utc"].hour): r["value"] for r in hourly.read_upserted(stream, KEYS, fact, "value").collect()}

    add_file(spark, source, [("a", 10, 1), ("a", 70, 2), ("a", 1450, 3)])
    assert run() == {("2024-01-01", 0): 1.0, ("2024-01-01", 1): 2.0, ("2024-01-02", 0): 3.0}
    add_file(spark, source, [("a", 20, 5)])
    assert run() == {("2024-01-01", 0): 3.0, ("2024-01-01", 1): 2.0, ("2024-01-02", 0): 3.0}
    assert [d for d in os.listdir(f"{fact}/days/version=1") if d.startswith("day=")] == ["day=2024-01-01"]


def test_repeated_batch_replaces_itself(spark, tmp_path):
    source, fact = str(tmp_path / "in"), str(tmp_path / "fact")
    add_file(spark, source, [("a", 10, 1)])
    stream = hourly.file_stream(spark, source, SCHEMA)
    for checkpoint in ("one", "two"):  # the second run has lost the first one's checkpoint: batch 0 comes again
        hourly.run_upserts(stream, KEYS, "ts", "value", fact, str(tmp_path / checkpoint))
    assert hours(hourly.read_upserted(stream, KEYS, fact, "value")) == {("a", 0): (1.0, 1)}


def test_windowed_means_drop_late_rows(spark, tmp_path):
    source, checkpoint, out = (str(tmp_path / d) for d in ("in", "checkpoint", "out"))
    add_file(spark, source, [("a", 10, 1), ("a", 20, 3)])
    stream = hourly.windowed_means(hourly.file_stream(spark, source, SCHEMA), KEYS, "ts", "value", "2 hours")
    query = stream.writeStream.outputMode("update").foreachBatch(lambda b, _: b.write.mode("append").parquet(out)).option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    assert hours(spark.read.parquet(out)) == {("a", 0): (2.0, 2)}


def folders(path, prefix):
    return sorted(d for d in os.listdir(path) if d.startswith(prefix))


def test_versions_that_no_manifest_names_are_removed(spark, tmp_path):
    source, fact, checkpoint = (str(tmp_path / d) for d in ("in", "fact", "checkpoint"))
    expected = {}
    for i in range(10):  # every batch reaches day 0 and a day of its own
        add_file(spark, source, [("a", 10, i), ("a", 1440 * (i + 1) + 5, i)])
        stream = hourly.file_stream(spark, source, SCHEMA)
        hourly.run_upserts(stream, KEYS, "ts", "value", fact, checkpoint)
        expected[("a", 24 * (i + 1))] = (float(i), 1)
    expected[("a", 0)] = (4.5, 10)
    assert hours(hourly.read_upserted(stream, KEYS, fact, "value")) == expected
    kept = [f"{v}/{d}" for v in folders(f"{fact}/days", "version=") for d in folders(f"{fact}/days/{v}", "day=")]
    assert len(kept) == 10 + 2  # a version for each day, and the one before for day 0
    assert folders(f"{fact}/manifests", "batch=") == folders(f"{fact}/sums", "batch=") == ["batch=8", "batch=9"]


def test_a_batch_that_broke_off_before_its_manifest_is_not_seen(spark, tmp_path, monkeypatch):
    source, fact, checkpoint = (str(tmp_path / d) for d in ("in", "fact", "checkpoint"))

    def run():
        stream = hourly.file_stream(spark, source, SCHEMA)
        hourly.run_upserts(stream, KEYS, "ts", "value", fact, checkpoint)
        return stream

    add_file(spark, source, [("a", 10, 1), ("a", 1450, 2)])
    stream = run()
    add_file(spark, source, [("a", 20, 3)])

    def boom(*_):
        raise RuntimeError("broke off")

    with monkeypatch.context() as patch:
        patch.setattr(hourly, "write_manifest", boom)
        with pytest.raises(Exception, match="broke off"):
            run()
    assert "version=1" in folders(f"{fact}/days", "version=")
    before = {("a", 0): (1.0, 1), ("a", 24): (2.0, 1)}
    assert hours(hourly.read_upserted(stream, KEYS, fact, "value")) == before
    run()
    assert hours(hourly.read_upserted(stream, KEYS, fact, "value")) == before | {("a", 0): (2.0, 2)}


def test_windows_count_late_rows(spark, tmp_path, small_dir):
    source = str(tmp_path / "in")
    events = write_newest_first(spark, small_dir, source)
    total = events.count()

    def run(lateness, name):
        stream = hourly.file_stream(spark, source, SCHEMA, files_per_batch=1)
        counts = hourly.run_windows(stream, KEYS, "ts", "value", lateness, str(tmp_path / name), str(tmp_path / f"{name}-checkpoint"))
        return counts, hourly.read_windows(stream, str(tmp_path / name), KEYS, "value").withColumn("value", F.round("value", 6))

    (read, late), found = run("400 days", "patient")
    batch = batch_result(events)
    assert (read, late) == (total, 0) and found.exceptAll(batch).count() == 0 and batch.exceptAll(found).count() == 0
    (read, late), found = run("1 hour", "strict")
    assert read == total and late > 0 and found.agg(F.sum("n")).first()[0] < batch.agg(F.sum("n")).first()[0]


def test_probes_of_batches_and_micro_batches(spark, tmp_path):
    from isochron.operators import probes

    source, base = str(tmp_path / "in"), str(tmp_path / "probes")
    log = probes.Probes(spark, "first")
    add_file(spark, source, [("a", 10, 1), ("b", 20, None)])
    add_file(spark, source, [("a", 30, None), ("a", 40, None), ("c", 50, 2)])
    stream = log.watch(hourly.file_stream(spark, source, SCHEMA, files_per_batch=1), "arrived", "value")
    with log.listening():
        hourly.run_sums(stream, KEYS, "ts", "value", str(tmp_path / "log"), str(tmp_path / "checkpoint"))
    rows = spark.read.schema(SCHEMA).parquet(source)
    stored = log.write(log.watch(rows, "read", "value", "ts").where("value IS NOT NULL"), str(tmp_path / "out"), "kept", "value")
    assert stored.count() == 2
    log.store(base)
    log.store(base)  # repeated: replaced
    other = probes.Probes(spark, "second")
    other.write(rows.where("value > 99"), str(tmp_path / "none"), "none", "value")
    other.store(base)
    found = {(r["run"], r["step"], r["batch"]): (r["rows"], r["nulls"]) for r in probes.read(spark, base).collect()}
    batches = {k[2]: v for k, v in found.items() if k[1] == "arrived"}
    assert sorted(v[0] for v in batches.values()) == [2, 3] and sorted(v[1]["value"] for v in batches.values()) == [1, 2]
    assert found["first", "read", None] == (5, {"value": 3, "ts": 0}) and found["first", "kept", None] == (2, {"value": 0})
    assert found["second", "none", None] == (0, {"value": 0}) and len(found) == 5
