"""The whole flow as three jobs over stored tables: raw -> silver, silver -> gold, gold -> forecasts and reports.

Every stage writes its tables and the next one reads them, so a raw row is scanned once, and a failed stage is repeated
without the ones before it. Each job counts the rows and nulls of its tables while it writes them, and leaves the counts below
`{base}/probes`, one folder a job.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isochron.operators import backtest, holidays, merge, models, panel, probes, regions, reports, silver, star
from isochron.operators.backtest import Geometry
from isochron.plans.views import register_views
from isochron.session import stored
from isochron.sources.tables import scan, scan_optional, write_partitioned

GOLD = ["dim_time", "dim_region", "dim_weather_type", "dim_holiday", "fact_electricity_hourly", "fact_weather_hourly"]
ANALYTICS = ["forecast_results", "complete_timeseries", "dayahead_fact", "intraday_fact", "data_quality", "weather_correlations"]


def build_silver(base: str, demand: DataFrame, weather: DataFrame, cities: DataFrame, holiday_rows: DataFrame, **options) -> None:
    """silver_region_mapping, silver_holiday_data, silver_weather_data, silver_electricity_data from raw tables."""
    log = probes.Probes(demand.sparkSession, "silver")
    mapping = log.write(regions.region_mapping(cities), f"{base}/silver_region_mapping", "region_mapping", "region_clean")
    log.write(holidays.holiday_features(holiday_rows), f"{base}/silver_holiday_data", "holiday_data", "date_paris")
    log.write(silver.weather_by_region(weather, mapping), f"{base}/silver_weather_data", "weather_data", "ts_utc", "region_clean")
    raw = log.watch(demand, "raw_demand", "region", "date")
    hourly = stored(silver.demand_hourly(raw, **options), "silver-demand")
    log.write(silver.add_demand_features(hourly), f"{base}/silver_electricity_data", "electricity_data", "ts_utc", "consommation_mw")
    log.store(f"{base}/probes")


def build_gold(spark: SparkSession, base: str) -> None:
    """Four dimensions and two facts, the facts partitioned by region."""
    log = probes.Probes(spark, "gold")
    silver_demand, silver_weather = scan(spark, f"{base}/silver_electricity_data"), scan(spark, f"{base}/silver_weather_data")
    demand = stored(silver.harmonized_demand(log.watch(merge.recover_timestamps(silver_demand), "silver_demand", "ts_utc")), "gold-demand")
    weather = stored(silver.harmonized_weather(log.watch(merge.recover_timestamps(silver_weather), "silver_weather", "ts_utc")), "gold-weather")
    log.collect()
    dimensions = {
        "dim_time": star.dim_time(demand),
        "dim_region": star.dim_region(demand),
        "dim_weather_type": star.dim_weather_type(weather),
        "dim_holiday": star.dim_holiday(scan(spark, f"{base}/silver_holiday_data")),
    }
    for name, dimension in dimensions.items():
        log.write(dimension, f"{base}/{name}", name)
    time, region, types, holiday = [scan(spark, f"{base}/{name}") for name in dimensions]
    facts = {
        "fact_electricity_hourly": star.fact_demand_hourly(demand, holiday),
        "fact_weather_hourly": star.fact_weather_hourly(weather, time, region, types),
    }
    for name, fact in facts.items():
        log.write(fact, f"{base}/{name}", name, "time_id", "region_id", sink=write_partitioned)
    log.store(f"{base}/probes")


def build_analytics(
    spark: SparkSession, base: str, geometry: Geometry = Geometry(), names: Sequence[str] = tuple(models.REGISTRY),
    on_arima: bool = True,
) -> None:
    """Backtest results, complete series, forecasts by horizon and reports, from the facts."""
    log = probes.Probes(spark, "analytics")
    demand = scan(spark, f"{base}/fact_electricity_hourly")
    weather = scan_optional(spark, f"{base}/fact_weather_hourly")
    observed = stored(star.analytics_panel(demand, weather), "analytics-panel")
    extra = [c for c in observed.columns if c not in ("region_clean", "ts_utc", "consumption_mw")]
    dense = panel.densify(observed, ["region_clean"])
    features = stored(
        panel.model_features(dense, ["region_clean"], exclude_current=True, extra=extra), "analytics-features"
    )
    split = backtest.split_windows(features, geometry)
    columns = [*extra, *panel.feature_names()]
    orders = tuple(models.ARIMA_ORDERS) if on_arima else None
    forecasts = [models.baselines(split)] + ([models.run_models(split, columns, names, extra, orders)] if names else [])
    results = backtest.score(stored(reduce(DataFrame.unionByName, forecasts), "forecasts"), geometry)
    results = log.write(results, f"{base}/forecast_results", "forecast_results", "forecast_mw", "actual_mw")
    complete = backtest.complete_series(features.drop("idx", "n_rows", "observed"), results)
    published = complete.withColumn("ts_utc", F.unix_micros("ts_utc") * 1000)
    complete = log.write(published, f"{base}/complete_timeseries", "complete_timeseries", "ts_utc")
    long, short = backtest.split_horizons(complete)
    outputs = {
        "dayahead_fact": long, "intraday_fact": short,
        "data_quality": reports.data_quality(observed, complete).withColumn("analysis_timestamp", F.current_timestamp()),
        "weather_correlations": reports.weather_correlations(observed).withColumn("analysis_timestamp", F.current_timestamp()),
    }
    for name, table in outputs.items():
        log.write(table, f"{base}/{name}", name)
    log.store(f"{base}/probes")


def open_views(spark: SparkSession, base: str) -> list[str]:
    """Register the serving views over the stored gold and analytics tables."""
    names = [*GOLD, *ANALYTICS[1:4]]
    return register_views(spark, {name: scan(spark, f"{base}/{name}") for name in names})
