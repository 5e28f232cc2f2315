"""The serving views as DataFrame functions, and their registration as temporary views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from isochron.functions.buckets import performance_rating
from isochron.functions.clock import dow_iso, epoch_ns_to_timestamp, plus_hours
from isochron.operators.backtest import KEY
from isochron.operators.holidays import one_per_date
from isochron.operators.panel import feature_names

NO_HOLIDAY = "No Holiday"


def _or(column: str, default) -> Column:
    return F.coalesce(F.col(column), F.lit(default)).alias(column)


def daily_demand_weather(
    demand: DataFrame, weather: DataFrame, time: DataFrame, region: DataFrame, holiday: DataFrame, per_hour: bool = False,
) -> DataFrame:
    """Demand, renewable share and weather per region and local day (or per local hour), with the day's holiday.

    Both facts are reduced to (region, hour) before they meet, and calendar and holiday columns, which follow from
    the day, are joined after the rollup.
    """
    local = F.col("ts_paris") if per_hour else F.to_date("ts_paris")
    clock = time.select("time_id", "ts_paris", "day_name", "month_name", "season", "is_weekend", "is_workday")
    readings = weather.select(
        "time_id", "region_id", "temperature_c", "humidity_percent", "precipitation_mm", "wind_speed_kph"
    )
    day_columns = ["day_name", "month_name", "season", "is_weekend", "is_workday"]
    daily = (
        demand.select("time_id", "region_id", "consumption_mw", "renewable_ratio")
        .join(readings, ["time_id", "region_id"], "left")
        .join(clock, "time_id")
        .groupBy("region_id", local.alias("date_paris"))
        .agg(
            F.avg("consumption_mw").alias("avg_daily_consumption"),
            F.sum("consumption_mw").alias("total_daily_consumption"),
            F.avg("renewable_ratio").alias("avg_renewable_ratio"),
            F.avg("temperature_c").alias("avg_daily_temperature"),
            F.avg("humidity_percent").alias("avg_humidity"),
            F.max("precipitation_mm").alias("max_daily_precipitation"),
            F.avg("wind_speed_kph").alias("avg_wind_speed"),
            *[F.max(c).alias(c) for c in day_columns],
        )
    )
    marks = one_per_date(holiday).select(
        F.col("date_paris").alias("_day"), "holiday_name", "holiday_type", "is_national_holiday", "is_weekend_adjacent"
    )
    placed = daily.join(region.select("region_id", KEY, "region_canon", "cap_lat", "cap_lon"), "region_id")
    return placed.join(marks, F.to_date("date_paris") == F.col("_day"), "left").select(
        "date_paris", KEY, "region_canon", "cap_lat", "cap_lon",
        "avg_daily_consumption", "total_daily_consumption", "avg_renewable_ratio", "avg_daily_temperature",
        "avg_humidity", "max_daily_precipitation", "avg_wind_speed",
        _or("holiday_name", NO_HOLIDAY), _or("holiday_type", NO_HOLIDAY),
        _or("is_national_holiday", 0), _or("is_weekend_adjacent", 0), *day_columns,
    )


def last_actual(complete: DataFrame) -> DataFrame:
    """Time of the last actual row per region; ts_utc is in epoch nanoseconds."""
    return complete.where("data_type = 'actual'").groupBy(KEY).agg(
        epoch_ns_to_timestamp(F.max("ts_utc")).alias("last_actual_ts")
    )


def _place_forecasts(best: DataFrame, complete: DataFrame, region: DataFrame, holiday: DataFrame) -> DataFrame:
    """Add the forecast's time (last actual hour plus horizon), region columns and the holiday of that date."""
    forecast_time = plus_hours(F.col("last_actual_ts"), F.col("forecast_horizon"))
    marks = one_per_date(holiday).select(F.col("date_paris").alias("_day"), "holiday_name", "is_national_holiday", "holiday_season")
    return (
        best.join(last_actual(complete), KEY)
        .withColumn("forecast_timestamp", forecast_time)
        .join(region.select(KEY, "region_canon", "cap_lat", "cap_lon"), KEY)
        .join(marks, F.to_date("forecast_timestamp") == F.col("_day"), "left")
    )


def rank_models_by_error(long_fact: DataFrame) -> DataFrame:
    """The single best row per region and horizon: lowest rmse, then mae (to nine decimals), then model, time."""
    order = Window.partitionBy(KEY, "forecast_horizon").orderBy(
        F.round("rmse", 9), F.round("mae", 9), "model", "ts_utc", "forecast_mw"
    )
    ranked = long_fact.where(F.col("rmse").isNotNull()).withColumn("rank_num", F.row_number().over(order))
    return ranked.where("rank_num = 1").select(KEY, "forecast_horizon", "model", "forecast_mw", "mae", "rmse")


def rank_models_by_count(short_fact: DataFrame) -> DataFrame:
    """The model with most rows per region and horizon (ties by name) with its mean errors and forecast."""
    per_model = short_fact.groupBy(KEY, "forecast_horizon", "model").agg(
        F.count("*").alias("forecast_count"), F.avg("mae").alias("avg_mae"), F.avg("rmse").alias("avg_rmse"),
        F.avg("forecast_mw").alias("avg_forecast_mw"),
    )
    order = Window.partitionBy(KEY, "forecast_horizon").orderBy(F.desc("forecast_count"), "model")
    return per_model.withColumn("rank_num", F.row_number().over(order)).where("rank_num = 1").drop("rank_num")


def best_long_horizon(long_fact: DataFrame, complete: DataFrame, region: DataFrame, holiday: DataFrame) -> DataFrame:
    best = rank_models_by_error(long_fact).where(F.col("forecast_horizon") >= 24)
    placed = _place_forecasts(best, complete, region, holiday)
    at = F.col("forecast_timestamp")
    return placed.select(
        at, KEY, F.lit("forecast").alias("data_type"), "forecast_horizon", "model", "forecast_mw", "mae", "rmse",
        "region_canon", "cap_lat", "cap_lon", F.hour(at).alias("forecast_hour"), dow_iso(at).alias("forecast_dow"),
        _or("holiday_name", NO_HOLIDAY), _or("is_national_holiday", 0), _or("holiday_season", "regular"),
    )


def best_short_horizon(short_fact: DataFrame, complete: DataFrame, region: DataFrame, holiday: DataFrame) -> DataFrame:
    placed = _place_forecasts(rank_models_by_count(short_fact), complete, region, holiday)
    return placed.select(
        "forecast_timestamp", KEY, F.lit("forecast").alias("data_type"), "forecast_horizon", "model",
        "avg_mae", "avg_rmse", "avg_forecast_mw", "region_canon", "cap_lat", "cap_lon",
        _or("holiday_name", NO_HOLIDAY), _or("is_national_holiday", 0),
    )


def best_overview(short_view: DataFrame, long_view: DataFrame) -> DataFrame:
    """Both views under one schema, with calendar parts, holiday and a rating by rmse."""
    shared = ["forecast_timestamp", KEY, "forecast_horizon", "model", "region_canon", "holiday_name", "is_national_holiday"]
    short = short_view.select(*shared, "avg_forecast_mw", F.lit("intraday").alias("forecast_type"))
    long = long_view.select(
        *shared, F.col("forecast_mw").alias("avg_forecast_mw"), F.lit("dayahead").alias("forecast_type"), "mae", "rmse"
    )
    at = F.col("forecast_timestamp")
    return short.unionByName(long, allowMissingColumns=True).select(
        "forecast_type", at, KEY, "region_canon", "forecast_horizon", "model", "avg_forecast_mw", "mae", "rmse",
        "holiday_name", "is_national_holiday",
        F.hour(at).alias("forecast_hour"), dow_iso(at).alias("forecast_dow"), F.month(at).alias("forecast_month"),
        performance_rating(F.col("rmse")).alias("performance_rating"),
    )


def series_normalized(complete: DataFrame) -> DataFrame:
    """The complete series with a readable timestamp and the columns the dashboards use."""
    names = [
        "consumption_mw", KEY, "temperature_c", "solar_production_mw", "wind_production_mw", *feature_names(),
        "data_type", "forecast_horizon", "model", "forecast_mw",
    ]
    return complete.select(
        epoch_ns_to_timestamp(F.col("ts_utc")).alias("ts_utc_timestamp"), *[c for c in names if c in complete.columns]
    )


def register_views(spark: SparkSession, tables: dict[str, DataFrame]) -> list[str]:
    """Create the five views over stored tables; returns their names."""
    t = tables
    complete, holiday, region = t["complete_timeseries"], t["dim_holiday"], t["dim_region"]
    long = best_long_horizon(t["dayahead_fact"], complete, region, holiday)
    short = best_short_horizon(t["intraday_fact"], complete, region, holiday)
    views = {
        "v_electricity_weather_daily": daily_demand_weather(
            t["fact_electricity_hourly"], t["fact_weather_hourly"], t["dim_time"], region, holiday
        ),
        "v_best_dayahead_forecast": long,
        "v_best_intraday_forecast": short,
        "v_best_combined_forecast_overview": best_overview(short, long),
        "v_complete_timeseries_normalized": series_normalized(complete),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    return list(views)
