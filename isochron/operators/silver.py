"""Cleaning of raw rows into hourly tables per region."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isochron.fixed_values import DEMAND_MEASURES, NUMERIC_NAME_TOKENS
from isochron.functions.clock import epoch_ns_to_timestamp, local_to_utc, parse_local
from isochron.functions.numeric import decimal_comma
from isochron.operators import panel, regions, star


def demand_hourly(raw: DataFrame, null_as_zero: bool = False, overlap: str = "earliest") -> DataFrame:
    """Raw demand rows (region, date, heure, measures as text) as means per known region and UTC hour.

    Rows of negative demand are left out. null_as_zero counts missing measures as 0 in the means.
    """
    names = regions.by_name(raw, "region", lambda n: regions.only_regions(regions.add_regions(n)))
    known = raw.join(names, "region")
    measures = [c for c in raw.columns if c.endswith("_mw") and any(t in c for t in NUMERIC_NAME_TOKENS)]
    instant = local_to_utc(parse_local(F.col("date"), F.col("heure")), overlap=overlap)
    typed = known.select("region_clean", instant.alias("_ts"), *[decimal_comma(F.col(c)).alias(c) for c in measures])
    kept = panel.quality_filter(typed, "consommation_mw", low=0).where(F.col("_ts").isNotNull())
    return panel.mean_by_step(kept, ["region_clean"], "_ts", measures, null_as_zero=null_as_zero)


def add_demand_features(hourly: DataFrame) -> DataFrame:
    """The dense hourly table with calendar, cyclic hour, lags and the trailing week; hand in a stored table."""
    dense = panel.densify(hourly, ["region_clean"])
    history = panel.demand_history(dense, ["region_clean"]).drop("idx", "n_rows", "observed")
    timed = panel.add_calendar(history, only=["hour", "dow", "week", "month", "doy", "is_weekend"])
    return panel.add_cyclic(timed, hour=24)


def weather_by_region(readings: DataFrame, mapping: DataFrame) -> DataFrame:
    """City readings (city_name, date in epoch nanoseconds, measures) as the hourly weather table of known regions."""
    placed = regions.attach_regions(readings, mapping).where(F.col("region_clean").isNotNull())
    timed = placed.withColumn("ts_utc", epoch_ns_to_timestamp(F.col("date"))).drop("date")
    return star.weather_hourly(timed)


def _harmonized(silver: DataFrame, measures: list[str]) -> DataFrame:
    """Rows under standard region labels, averaged again where labels fall together."""
    names = regions.by_name(silver, "region_clean", lambda n: regions.harmonize(n.withColumn("_label", F.col("region_clean")), "_label"))
    named = silver.select("region_clean", "ts_utc", *measures).join(names, "region_clean")
    labelled = named.drop("region_clean").withColumnRenamed("_label", "region_clean")
    return panel.mean_by_step(labelled, ["region_clean"], "ts_utc", measures)


def harmonized_demand(silver: DataFrame) -> DataFrame:
    return _harmonized(silver, [c for c in DEMAND_MEASURES if c in silver.columns])


def harmonized_weather(silver: DataFrame) -> DataFrame:
    return _harmonized(silver, [c for c in star.WEATHER_INPUTS if c in silver.columns])
