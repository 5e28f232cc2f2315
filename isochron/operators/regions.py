"""Region names on tables: mapping, harmonising, city lookup, the region map and checks against the standard labels."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isochron.fixed_values import REGIONS
from isochron.functions import regions as names
from isochron.functions.binding import let
from isochron.functions.text import canonicalize, first_letter, normalize_city
from isochron.session import stored


def add_regions(df: DataFrame, raw: str = "region") -> DataFrame:
    """Add region_canon (canonical region) and region_clean (display label); null names stay null."""
    spelled = F.col(raw)
    both = let(canonicalize(spelled), lambda name: F.struct(
        names.map_region(name).alias("region_canon"), names.display_name(name, spelled).alias("region_clean")
    ))
    added = df.withColumn("_r", F.when(spelled.isNotNull(), both))
    return added.select(*df.columns, "_r.region_canon", "_r.region_clean")


def only_regions(df: DataFrame) -> DataFrame:
    return df.where(names.is_canonical(F.col("region_canon")))


def harmonize(df: DataFrame, region: str = "region_clean") -> DataFrame:
    """Bring a column of region names to the standard labels, in the two passes described in functions.regions."""
    raw = F.col(region)
    label = let(canonicalize(raw), lambda name: names.harmonize_region(name, raw))
    standard = let(label, lambda found: let(names.simplified(found), lambda loose: names.standard_label(found, loose)))
    return df.withColumn(region, F.when(raw.isNotNull(), standard))


def nonstandard_names(*tables: DataFrame, region: str = "region_clean") -> DataFrame:
    """Distinct names in any of the tables that are no standard label."""
    listed = [t.select(region).where(~names.is_standard(F.col(region))).distinct() for t in tables]
    return reduce(DataFrame.union, listed).distinct()


def capitals(spark: SparkSession) -> DataFrame:
    """(region_canon, label, cap_lat, cap_lon): thirteen fixed rows."""
    return spark.createDataFrame(REGIONS, "region_canon string, label string, cap_lat double, cap_lon double")


def add_capitals(df: DataFrame, on: str = "region_canon") -> DataFrame:
    """Left-join the capital's coordinates by canonical name or by 'label'. Broadcast: the table has thirteen rows."""
    dim = capitals(df.sparkSession)
    keep = dim.select(dim[on if on == "region_canon" else "label"].alias(on), "cap_lat", "cap_lon")
    return df.join(F.broadcast(keep), on, "left")


def region_mapping(cities: DataFrame) -> DataFrame:
    """Distinct (region, city) rows of known regions with normalised city names and the capital's coordinates."""
    pairs = cities.select(F.col("region").alias("region_raw"), F.col("city").alias("city_raw")).distinct()
    mapped = only_regions(add_regions(pairs, "region_raw")).withColumn("city_norm", normalize_city(F.col("city_raw")))
    return add_capitals(mapped).select("city_norm", "city_raw", "region_clean", "region_canon", "cap_lat", "cap_lon")


def region_summary(mapping: DataFrame) -> DataFrame:
    """Cities per region and the coordinates, which are constant within a region."""
    return mapping.groupBy("region_clean", "region_canon").agg(
        F.count("city_raw").alias("city_count"),
        F.max("cap_lat").alias("cap_lat"),
        F.max("cap_lon").alias("cap_lon"),
    )


def one_region_per_city(mapping: DataFrame) -> DataFrame:
    """The lookup side of the city join: one row per normalised name, the alphabetically first region."""
    return mapping.groupBy("city_norm").agg(
        F.min(F.struct("region_clean", "region_canon")).alias("r")
    ).select("city_norm", "r.region_clean", "r.region_canon")


def attach_regions(readings: DataFrame, mapping: DataFrame, city: str = "city_name") -> DataFrame:
    """Left-join readings to regions by normalised city name; unmatched rows keep null regions.

    Names are normalised once each, and the resolved names stored, so that Spark knows their size: it broadcasts them
    below its threshold, and above it joins by shuffle and splits hot cities at run time.
    """
    cities = readings.select(city).where(F.col(city).isNotNull()).distinct().withColumn("city_norm", normalize_city(F.col(city)))
    lookup = stored(cities.join(one_region_per_city(mapping), "city_norm", "left"), "city-regions")
    return readings.join(lookup, city, "left")


def by_name(df: DataFrame, raw: str, resolve: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Stored table of the distinct names in a column with what `resolve` adds to them; for joins as in attach_regions.

    Reads one column of the table and leaves one row per name; null names are left out.
    """
    return stored(resolve(df.select(raw).where(F.col(raw).isNotNull()).distinct()), "names")


def unmapped(readings: DataFrame, mapping: DataFrame, city: str = "city_name") -> DataFrame:
    """Distinct cities without a region, with the number of their readings."""
    counted = readings.groupBy(city).agg(F.count("*").alias("readings"))
    counted = counted.withColumn("city_norm", normalize_city(F.col(city)))
    return counted.join(mapping.select("city_norm"), "city_norm", "left_anti")


def attach_group_size(df: DataFrame, key: str, name: str) -> DataFrame:
    """Add the number of rows of each key: count with map-side combine, then join back (a hot key stays splittable)."""
    return df.join(df.groupBy(key).agg(F.count("*").alias(name)), key, "left")


def enrich_cities(cities: DataFrame) -> DataFrame:
    """Trimmed region, cities per region and the city's first letter."""
    counted = attach_group_size(cities, "region", "city_count")
    return counted.withColumns({
        "region_clean": F.trim("region"),
        "city_first_letter": first_letter(F.col("city")),
    })


def top_groups(df: DataFrame, key: str, value: Column, name: str, n: int = 5) -> DataFrame:
    """The n groups with the highest value (ties by key)."""
    return df.groupBy(key).agg(value.alias(name)).orderBy(F.desc(name), key).limit(n)
