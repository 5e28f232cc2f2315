"""Star schema: silver hourly tables, four dimensions and two hourly facts.

Joins carry no hints: dimension sizes are known to Spark from stored tables or at run time, so a dimension is
broadcast below the size threshold and shuffled above it. Only tables of fixed length are broadcast by hand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isochron.fixed_values import (
    DEMAND_MEASURES, PRECIPITATION_LABELS, RENEWABLE_MEASURES, TEMPERATURE_LABELS, WEATHER_MEASURES, WIND_LABELS,
)
from isochron.functions import buckets
from isochron.functions.numeric import number_or_null, renewable_ratio
from isochron.functions.text import surrogate_key
from isochron.operators.holidays import one_per_date
from isochron.operators.merge import merge_first_match
from isochron.operators.panel import add_calendar, add_cyclic, mean_by_step
from isochron.operators.regions import add_capitals

MEASURED_DAYS = [f"temperature_2m_previous_day{k}" for k in range(1, 6)]
WEATHER_INPUTS = ["temp_c", *MEASURED_DAYS, "precip_mm", "wind_kph", "humidity", "cloud", "pressure_mb"]


def weather_hourly(readings: DataFrame, local: str = "ts_paris") -> DataFrame:
    """Mean temperatures per region and hour with calendar, season, daylight and severity.

    Labels follow from the regional mean and the hour, so they do not depend on which city comes first.
    """
    readings = readings.withColumnRenamed("temperature_2m", "temp_c")
    present = [c for c in WEATHER_INPUTS if c in readings.columns]
    typed = readings.withColumns({c: number_or_null(F.col(c)) for c in present})
    hourly = mean_by_step(typed, ["region_clean"], "ts_utc", present)
    timed = add_calendar(hourly, local=local, only=["hour", "dow", "month", "is_weekend"])
    timed = timed.withColumns({
        "season": buckets.season(F.col("month")),
        "is_daylight": buckets.is_daylight(F.col("hour")),
        "weather_severity": buckets.weather_severity(F.col("temp_c")),
    })
    return add_cyclic(timed, hour=24, month=12).where((F.col("temp_c") > -50) & (F.col("temp_c") < 60))


def dim_time(hours: DataFrame) -> DataFrame:
    """One row per distinct hour with keys, calendar parts and names of the local day."""
    distinct = hours.select("ts_utc").where(F.col("ts_utc").isNotNull()).distinct()
    timed = add_calendar(distinct)
    local = F.col("ts_paris")
    return timed.select(
        surrogate_key(F.col("ts_utc")).alias("time_id"),
        F.date_format("ts_utc", "yyyyMMddHH").alias("time_hour_key"),
        "ts_utc", "ts_paris", "hour", "dow",
        F.date_format(local, "EEEE").alias("day_name"),
        "month", F.date_format(local, "MMMM").alias("month_name"),
        "quarter", "year", "doy", "week", "is_weekend",
        (1 - F.col("is_weekend")).alias("is_workday"),
        buckets.season(F.col("month")).alias("season"),
    )


def dim_region(rows: DataFrame, country: str = "France") -> DataFrame:
    """One row per region label with its capital's coordinates, joined by label."""
    regions = rows.select("region_clean").where(F.col("region_clean").isNotNull()).distinct()
    placed = add_capitals(regions.withColumn("label", F.col("region_clean")), "label")
    return placed.select(
        surrogate_key(F.col("region_clean")).alias("region_id"), "region_clean",
        F.col("region_clean").alias("region_canon"), F.lit(country).alias("country"), "cap_lat", "cap_lon",
    )


def _labels(spark: SparkSession, name: str, labels: list[str]) -> DataFrame:
    return spark.createDataFrame([(label,) for label in labels], f"{name} string")


def weather_labels(df: DataFrame) -> DataFrame:
    """Add the three weather categories; a missing measure gives a null category."""
    def measure(name: str) -> Column:
        return F.col(name) if name in df.columns else F.lit(None).cast("double")

    return df.withColumns({
        "temperature_category": buckets.temperature_category(measure("temp_c")),
        "precipitation_category": buckets.precipitation_category(measure("precip_mm")),
        "wind_category": buckets.wind_category(measure("wind_kph")),
    })


WEATHER_CATEGORIES = ["temperature_category", "precipitation_category", "wind_category"]


def dim_weather_type(weather: DataFrame) -> DataFrame:
    """All combinations of the categories that occur, or of all labels where a measure does not exist.

    The product is taken of labels (at most 5 x 4 x 3), never of measured values.
    """
    labelled = weather_labels(weather)
    sets = zip(WEATHER_CATEGORIES, ["temp_c", "precip_mm", "wind_kph"],
               [TEMPERATURE_LABELS, PRECIPITATION_LABELS, WIND_LABELS])
    chosen = labelled.agg(*[
        (F.collect_set(category) if measure in weather.columns else F.array(*map(F.lit, labels))).alias(category)
        for category, measure, labels in sets
    ])
    for category in WEATHER_CATEGORIES:
        chosen = chosen.withColumn(category, F.explode(category))
    return chosen.select(surrogate_key(*map(F.col, WEATHER_CATEGORIES)).alias("weather_type_id"), *WEATHER_CATEGORIES)


def with_weather_type(weather: DataFrame, dim: DataFrame, cumulative: bool = False) -> DataFrame:
    """Left-join the weather type: compute the buckets, then an equi-join on labels.

    cumulative also matches all warmer categories, as a chain of 'below' tests does: the row is repeated for each
    type it stays below (at most five copies), of those the dimension has; without any it stays once, with a null type.
    Still an equi-join. The dimension has at most 60 rows.
    """
    labelled = weather_labels(weather)
    if not cumulative:
        return labelled.join(F.broadcast(dim), WEATHER_CATEGORIES, "left").drop(*WEATHER_CATEGORIES)
    temperature, *others = WEATHER_CATEGORIES
    own = [c for c in dim.columns if c not in WEATHER_CATEGORIES]
    types = dim.groupBy(*others).agg(F.collect_list(F.struct(F.col(temperature).alias("_label"), *own)).alias("_types"))
    labels = F.array(*map(F.lit, TEMPERATURE_LABELS))
    start = F.array_position(labels, F.col(temperature)).cast("int")
    warmer = F.when(start > 0, F.slice(labels, start, F.lit(5))).otherwise(F.array(F.lit("hot")))
    joined = labelled.withColumn("_warmer", warmer).join(F.broadcast(types), others, "left")
    fitting = F.filter("_types", lambda t: F.array_contains("_warmer", t["_label"]))
    matched = joined.withColumn("_type", F.explode_outer(fitting))
    return matched.withColumns({c: F.col("_type")[c] for c in own}).drop(*WEATHER_CATEGORIES, "_warmer", "_types", "_type")


def dim_holiday(holidays: DataFrame) -> DataFrame:
    return holidays.where(F.col("date_paris").isNotNull()).select(
        surrogate_key(F.col("date_paris"), F.col("holiday_name")).alias("holiday_id"),
        "date_paris", "holiday_name", "holiday_type", "holiday_category", "is_national_holiday", "is_regional_holiday",
        "is_observance", "is_bridge_day", "is_weekend_adjacent", "is_easter_related", "holiday_season",
    ).distinct()


def _renamed_measures(columns: list[str], mapping: dict[str, str], absent: Column) -> list[Column]:
    """Fact columns in mapping order; stored ones with the default for nulls, absent ones as the default throughout."""
    return [
        (F.coalesce(F.col(source), absent) if source in columns else absent).cast("double").alias(target)
        for source, target in mapping.items()
    ]


def fact_demand_hourly(
    demand: DataFrame, holiday: DataFrame, time: DataFrame | None = None, region: DataFrame | None = None,
) -> DataFrame:
    """Hourly demand with keys of time, region and (one) holiday, defaults, renewable share; positive demand only.

    The keys of time and region are hashes of the natural keys. Dimensions that were built from this very table hold all
    of its hours and regions, so they need not be joined; hand in others to keep only the rows they know.
    """
    # The filter stands before the joins: it is on a stored column and reaches the scan.
    kept = demand.where(
        (F.col("consommation_mw") > 0) & F.col("ts_utc").isNotNull() & F.col("region_clean").isNotNull()
    )
    if "ts_paris" not in kept.columns:
        kept = add_calendar(kept, only=[])
    keyed = kept.select(
        "ts_utc", "region_clean", F.to_date("ts_paris").alias("date_paris"),
        *_renamed_measures(kept.columns, DEMAND_MEASURES, F.lit(0.0)),
    )
    if time is not None:
        keyed = keyed.join(time.select("ts_utc"), "ts_utc", "left_semi")
    if region is not None:
        keyed = keyed.join(region.select("region_clean"), "region_clean", "left_semi")
    keyed = keyed.join(one_per_date(holiday).select("date_paris", "holiday_id"), "date_paris", "left")
    instant, name = F.col("ts_utc"), F.col("region_clean")
    return keyed.select(
        surrogate_key(instant, name).alias("electricity_record_id"),
        surrogate_key(instant).alias("time_id"), surrogate_key(name).alias("region_id"), "holiday_id",
        *DEMAND_MEASURES.values(), "ts_utc", "region_clean",
        renewable_ratio(F.col("consumption_mw"), *map(F.col, RENEWABLE_MEASURES)).alias("renewable_ratio"),
    )


def fact_weather_hourly(
    weather: DataFrame, time: DataFrame, region: DataFrame, types: DataFrame | None = None,
    absent: float | None = None, cumulative: bool = False,
) -> DataFrame:
    """Hourly weather with keys of time, region and weather type; temperatures from -50 to 50 only.

    `absent` is the value of measures that are null or do not exist (null by default). The weather type needs all
    three measures; without them it is 'default'.
    """
    kept = weather.where(F.coalesce("temp_c", F.lit(absent).cast("double")).between(-50, 50))
    complete = {"temp_c", "precip_mm", "wind_kph"} <= set(weather.columns)
    if complete and types is not None:
        kept = with_weather_type(kept, types, cumulative)
    else:
        kept = kept.withColumn("weather_type_id", F.lit("default"))
    known = kept.join(time.select("ts_utc"), "ts_utc", "left_semi").join(region.select("region_clean"), "region_clean", "left_semi")
    instant, name = F.col("ts_utc"), F.col("region_clean")
    return known.select(
        surrogate_key(instant, name).alias("weather_record_id"),
        surrogate_key(instant).alias("time_id"), surrogate_key(name).alias("region_id"), "weather_type_id",
        *_renamed_measures(weather.columns, WEATHER_MEASURES, F.lit(absent)),
        "ts_utc", "region_clean",
    )


def analytics_panel(demand: DataFrame, weather: DataFrame | None) -> DataFrame:
    """Positive hourly demand with the temperature of the same hour and region, by the first key set both sides have."""
    if weather is not None:
        keys = [["time_id", "region_id"], ["ts_utc", "region_clean"], ["ts_utc", "region_id"]]
        demand = merge_first_match(demand, weather, keys, ["temperature_c"])
    optional = [c for c in ("temperature_c", "solar_production_mw", "wind_production_mw") if c in demand.columns]
    return demand.select("region_clean", "ts_utc", "consumption_mw", *optional).where(F.col("consumption_mw") > 0)
