"""Holiday calendars: a row per day, holiday features, one holiday per date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isochron.functions import buckets
from isochron.functions.clock import calendar_parts, easter, utc_to_local
from isochron.operators.merge import keep_best

HOLIDAY_COLUMNS = [
    "date_paris", "ts_utc", "ts_paris", "holiday_name", "holiday_type", "holiday_category", "location",
    "is_national_holiday", "is_regional_holiday", "is_observance", "is_bridge_day", "is_weekend_adjacent",
    "is_easter_related", "holiday_season", "year", "month", "day", "dow", "doy", "week", "quarter",
]


def calendar_spine(events: DataFrame, country: str, first: Column | None = None, last: Column | None = None) -> DataFrame:
    """One row per day and event, or one placeholder row for a day without events.

    `events` has date, holiday_name, holiday_type, location. The days run over whole years, from the first to the
    last event's, unless given as aggregate expressions over the events.
    """
    first = first if first is not None else F.trunc(F.min("date"), "year")
    last = last if last is not None else F.date_sub(F.add_months(F.trunc(F.max("date"), "year"), 12), 1)
    days = events.agg(F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("date"))
    marked = events.withColumn("_found", F.lit(True))
    return days.join(marked, "date", "left").select(
        "date",
        F.lit(country).alias("country"),
        F.col("_found").isNotNull().alias("is_holiday"),
        F.coalesce("holiday_name", F.lit("")).alias("holiday_name"),
        F.coalesce("holiday_type", F.lit("")).alias("holiday_type"),
        F.coalesce("location", F.lit("National")).alias("location"),
        F.year("date").alias("year"), F.month("date").alias("month"), F.dayofmonth("date").alias("day"),
    )


def bridge_days(days: DataFrame, parity: bool = False) -> DataFrame:
    """Add is_bridge_day to rows with date_paris.

    A Thursday holiday followed by a Friday holiday, or a Tuesday holiday preceded by a Monday holiday, bridges the
    weekend. With parity the weekdays are Wednesday and Monday, and several holidays on a date count as neighbours
    of distance zero. The neighbour test is an equi-join of distinct dates, not an unpartitioned window.
    """
    day = F.col("date_paris")
    row = F.struct("holiday_name", "holiday_type", "location")
    dates = days.groupBy("date_paris").agg(F.min(row).alias("_min"), F.max(row).alias("_max"))
    early, late = (4, 2) if parity else (5, 3)
    after = dates.select(F.date_sub(day, 1).alias("date_paris"), F.lit(True).alias("_next"))
    before = dates.select(F.date_add(day, 1).alias("date_paris"), F.lit(True).alias("_previous"))
    joined = days.join(after, "date_paris", "left").join(before, "date_paris", "left")
    is_last = is_first = F.lit(True)
    if parity:
        # The neighbour in date order is the next row, so only a date's last (first) row has the next (previous) day.
        joined = joined.join(dates, "date_paris", "left")
        is_last, is_first = row.eqNullSafe(F.col("_max")), row.eqNullSafe(F.col("_min"))
    dow = F.dayofweek(day)
    bridge = ((dow == early) & F.col("_next").isNotNull() & is_last) | (
        (dow == late) & F.col("_previous").isNotNull() & is_first
    )
    return joined.withColumn("is_bridge_day", bridge.cast("int")).drop("_next", "_previous", "_min", "_max")


def holiday_features(raw: DataFrame, country: str = "France", parity: bool = False) -> DataFrame:
    """Distinct holidays of a country with category, flags, season, bridge, weekend and Easter marks."""
    day = F.try_to_date(F.col("date"), "yyyy-MM-dd")
    kept = raw.where((F.col("country") == country) & F.col("is_holiday")).select(
        day.alias("date_paris"), "holiday_name", "holiday_type", "location"
    ).distinct()
    kept = bridge_days(kept, parity)
    day = F.col("date_paris")
    category = F.col("holiday_category")
    kept = kept.withColumns({
        "ts_utc": day.cast("timestamp"),
        "ts_paris": utc_to_local(day.cast("timestamp")),
        "holiday_category": buckets.holiday_category(F.col("holiday_type")),
        "holiday_season": buckets.holiday_season(day),
        **{k: v for k, v in calendar_parts(day).items() if k not in ("hour", "is_weekend")},
    })
    named = F.col("holiday_name").contains("Easter") | F.col("holiday_name").contains("Pâques")
    near = F.datediff(day, easter(F.col("year"))).between(-7, 7)
    return kept.withColumns({
        "is_national_holiday": (category == "national").cast("int"),
        "is_regional_holiday": (category == "regional").cast("int"),
        "is_observance": (category == "observance").cast("int"),
        "is_weekend_adjacent": (F.col("dow").isin(1, 7) | (F.col("is_bridge_day") == 1)).cast("int"),
        "is_easter_related": F.when(named | near, 1).otherwise(0),
    }).select(*HOLIDAY_COLUMNS)


def one_per_date(holidays: DataFrame) -> DataFrame:
    """The holiday a date stands for in facts and views: a national one first, then by name and type."""
    return keep_best(
        holidays, ["date_paris"], F.desc("is_national_holiday"), F.col("holiday_name"), F.col("holiday_type"),
        *([F.col("location")] if "location" in holidays.columns else []),
    )


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first (ties by value)."""
    return df.groupBy(column).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), column)
