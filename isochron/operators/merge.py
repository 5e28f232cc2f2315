"""Joins that do not multiply rows, de-duplication, and recovery of a missing timestamp."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isochron.fixed_values import DATE_LIKE, TIMESTAMP_CANDIDATES
from isochron.functions.clock import local_to_utc, utc_to_local
from isochron.operators.shape import quoted
from isochron.session import shared_folder


def keep_best(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row per key, the first in the given order, which must be total.

    rank = 1 is cut before the shuffle (WindowGroupLimit), so a hot key sends one row per map task.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")


def merge_unique(left: DataFrame, right: DataFrame, keys: list[str], *order: Column, suffix: str = "_right") -> DataFrame:
    """Left join on keys after reducing the right side to its best row per key; clashing names get the suffix."""
    best = keep_best(right, keys, *order)
    clashes = {c: c + suffix for c in best.columns if c in left.columns and c not in keys}
    return left.join(best.withColumnsRenamed(clashes), keys, "left")


def merge_metrics(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """One row: duplicate keys on either side, rows of a plain left join, and whether these exceed 1.5 times the left rows.

    Works on key counts only; the join of the full rows is never built.
    """
    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.count("*").alias(name))

    both = counted(left, "l").join(counted(right, "r"), keys, "full")
    rows = F.sum(F.col("l") * F.coalesce("r", F.lit(1)))
    return both.agg(
        F.coalesce(F.sum("l"), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum(F.col("l") - 1), F.lit(0)).alias("left_duplicates"),
        F.coalesce(F.sum(F.col("r") - 1), F.lit(0)).alias("right_duplicates"),
        F.coalesce(rows, F.lit(0)).alias("joined_rows"),
    ).withColumn("multiplies", F.col("joined_rows") > F.col("left_rows") * 1.5)


def merge_first_match(
    left: DataFrame, right: DataFrame, key_sets: list[list[str]], values: list[str], *order: Column,
) -> DataFrame:
    """merge_unique on the first key set that both sides have; the left side unchanged if there is none."""
    for keys in key_sets:
        if set(keys) <= set(left.columns) and set(keys) <= set(right.columns):
            ranked = order or tuple(F.col(c).asc_nulls_last() for c in values)
            return merge_unique(left, right.select(*keys, *values), keys, *ranked)
    return left


def ensure_timestamp(df: DataFrame, dim_time: DataFrame | None = None, base: str = "2020-01-01", order: list[str] = ()) -> DataFrame:
    """A table with ts_utc: as it is, by time_id, from another column, from parts, or else hours counted from a base.

    The choice is made on the schema alone. The last way numbers the rows: position within the partition plus
    the rows of earlier partitions of a range sort, so no task sees all rows.
    """
    if "ts_utc" in df.columns:
        return df
    if "time_id" in df.columns and dim_time is not None and "ts_utc" in dim_time.columns:
        return merge_unique(df, dim_time.select("time_id", "ts_utc"), ["time_id"], F.col("ts_utc"))
    for name in TIMESTAMP_CANDIDATES:
        if name in df.columns:
            return df.withColumnRenamed(name, "ts_utc")
    if {"year", "month", "day", "hour"} <= set(df.columns):
        zero = F.lit(0)
        return df.withColumn("ts_utc", F.make_timestamp("year", "month", "day", "hour", zero, zero))
    numbered = number_rows(df, order or df.columns, "_row")
    micros = F.unix_micros(F.to_timestamp(F.lit(base))) + F.col("_row") * F.lit(3_600_000_000)
    return numbered.withColumn("ts_utc", F.timestamp_micros(micros)).drop("_row")


def _instant(df: DataFrame, name: str) -> Column | None:
    """A date-like column as an instant: dates and timestamps as they are, texts read as such, whole numbers as epochs of the unit their size
    tells; None for other types."""
    kind, value = df.schema[name].dataType.typeName(), F.col(quoted(name))
    if kind in ("timestamp", "timestamp_ntz", "date"):
        return value.cast("timestamp")
    if kind == "string":
        return F.try_to_timestamp(value)
    if kind in ("long", "integer"):
        size = F.abs(value)
        micros = F.when(size >= 10**17, F.call_function("div", value, F.lit(1000))).when(size >= 10**14, value).when(
            size >= 10**11, value * 1000).otherwise(value.cast("long") * 1_000_000)
        return F.timestamp_micros(micros)
    return None


def recover_timestamps(df: DataFrame, overlap: str = "earliest", stamp: Column | None = None) -> DataFrame:
    """ts_utc and ts_paris of every row, from the first source of a chain that has a value in that row.

    The chain: ts_hour_utc, ts_utc, the local time ts_paris (clock changes by `overlap`), columns whose name holds date, time or ts in the order of
    the table, and last `stamp` (null unless given, as a job's own clock says nothing about a row). Which sources there are is read from the schema, which
    of them holds is decided row by row. A ts_paris that is there stays; a missing one follows from ts_utc.
    """
    chain = [F.col(name).cast("timestamp") for name in ("ts_hour_utc", "ts_utc") if name in df.columns]
    local = F.col("ts_paris").cast("timestamp") if "ts_paris" in df.columns else None
    if local is not None:
        chain.append(local_to_utc(local, overlap=overlap))
    used = {"ts_hour_utc", "ts_utc", "ts_paris"}
    like = [c for c in df.columns if c not in used and any(part in c for part in DATE_LIKE)]
    chain += [found for found in (_instant(df, name) for name in like) if found is not None]
    chain.append(stamp if stamp is not None else F.lit(None).cast("timestamp"))
    timed = df.withColumn("ts_utc", F.coalesce(*chain))
    derived = utc_to_local(F.col("ts_utc"))
    return timed.withColumn("ts_paris", derived if local is None else F.coalesce(local, derived))


def number_rows(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Rows numbered from 0 in the given order without gathering them in one partition.

    A range sort spreads the rows; each row's number is its place in its partition plus the size of the
    partitions before. The sorted rows are checkpointed, so that both readers see the same partitions also after
    a retry. Only one count per partition passes through a single task.
    """
    shared_folder(df.sparkSession)
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = ranged.withColumn("_id", F.monotonically_increasing_id())
    placed = placed.withColumns({"_part": F.shiftright("_id", 33), "_place": F.col("_id").bitwiseAND((1 << 33) - 1)}).checkpoint()
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0))).drop("_size")
    return placed.join(offsets, "_part").withColumn(name, F.col("_before") + F.col("_place")).drop(
        "_id", "_part", "_place", "_before"
    )
