"""Semi-structured records: JSON payloads, value arrays on a time grid, links in HTML, city records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isochron.functions.numeric import coordinates
from isochron.operators.merge import keep_best

# Markup of region sections, their headings and their city links.
SECTION = r'(?i)<section[^>]*data-level="1"[^>]*>'
HEADING = r'(?is)<h2[^>]*class="[^"]*\bh1\b[^"]*"[^>]*>\s*<a[^>]*>(.*?)</a>'
LIST_ITEM = r"(?is)<li[^>]*>\s*(?:<div[^>]*>\s*)?<a[^>]*>(.*?)</a>"
MARKED_LIST = r'(?is)<ul[^>]*class="[^"]*list-disc[^"]*"[^>]*>.*?</ul>'
TAG = r"(?s)<[^>]*>"


def flatten_records(df: DataFrame, payload: str, record: str) -> DataFrame:
    """One row per record of {"results": [...]}, {"records": [...]}, either with fields nested under "fields".

    `record` is the record's schema as DDL. The payload column is replaced by the record's columns.
    """
    nested = f"array<struct<fields: struct<{record}>>>"
    shape = f"results array<struct<{record}>>, records array<struct<{record}>>"
    plain = F.from_json(payload, shape)
    deep = F.from_json(payload, f"results {nested}, records {nested}")
    inner = F.coalesce(F.nullif(deep["results"], F.array().cast(nested)), deep["records"])
    fields = F.filter(F.transform(inner, lambda r: r["fields"]), lambda f: f.isNotNull())
    outer = F.coalesce(F.nullif(plain["results"], F.array().cast(f"array<struct<{record}>>")), plain["records"])
    rows = F.when(F.size(fields) > 0, fields).otherwise(outer)
    kept = [c for c in df.columns if c != payload]
    return df.select(*kept, F.explode(rows).alias("_r")).select(*kept, "_r.*")


def expand_series(df: DataFrame, start: str, end: str, step_seconds: str, arrays: list[str], out: str = "ts_utc") -> DataFrame:
    """Value arrays on a grid of (start, end, step) as one row per step; the end is exclusive, other columns ride along."""
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col(step_seconds).cast("decimal(18,6)"))
    last = F.col(end) - step
    grid = F.when(F.col(start) <= last, F.sequence(F.col(start), last, step))
    kept = [c for c in df.columns if c not in (start, end, step_seconds, *arrays)]
    zipped = F.arrays_zip(grid.alias(out), *[F.col(a) for a in arrays])
    return df.select(*kept, F.explode(zipped).alias("_r")).select(*kept, "_r.*").where(F.col(out).isNotNull())


def section_links(df: DataFrame, html: str, fallback_heading: Column) -> DataFrame:
    """Distinct (region, city) pairs: the heading of each region section with the links of its lists.

    Lists marked as city lists win over other lists of a section. A page without region sections counts as one
    section under the fallback heading.
    """
    parts = F.split(F.col(html), SECTION)
    sections = F.when(F.size(parts) > 1, F.slice(parts, 2, F.size(parts) - 1)).otherwise(parts)
    one = df.select(F.explode(sections).alias("_s"), (F.size(parts) > 1).alias("_marked"), fallback_heading.alias("_host"))
    marked = F.array_join(F.regexp_extract_all("_s", F.lit(MARKED_LIST), F.lit(0)), " ")
    preferred = F.regexp_extract_all(marked, F.lit(LIST_ITEM), F.lit(1))
    links = F.when(F.size(preferred) > 0, preferred).otherwise(F.regexp_extract_all("_s", F.lit(LIST_ITEM), F.lit(1)))
    heading = F.when(F.col("_marked"), _text_of(F.regexp_extract("_s", HEADING, 1))).otherwise(F.col("_host"))
    found = one.select(heading.alias("region"), F.explode(links).alias("_l"))
    pairs = found.select("region", _text_of(F.col("_l")).alias("city"))
    return pairs.where((F.col("region") != "") & (F.col("city") != "")).distinct()


def _text_of(markup: Column) -> Column:
    return F.trim(F.regexp_replace(markup, TAG, ""))


def city_records(df: DataFrame, country: str = "FR") -> DataFrame:
    """Cities of a country that have coordinates, one row per geoname_id: the most populous, then by name."""
    if "coordinates" in df.columns and not {"lat", "lon"} <= set(df.columns):
        lat, lon = coordinates(F.col("coordinates"))
        df = df.withColumns({"lat": lat, "lon": lon})
    typed = df.withColumns({c: F.col(c).try_cast("double") for c in ("lat", "lon")})
    typed = typed.withColumn("population", F.col("population").try_cast("double"))
    placed = typed.where(
        F.col("lat").isNotNull() & F.col("lon").isNotNull() & (F.upper("country_code") == country)
    )
    best = keep_best(placed, ["geoname_id"], F.desc_nulls_last("population"), F.col("name"), F.col("lat"), F.col("lon"))
    return best.select("geoname_id", "name", "country_code", "timezone", "population", "lat", "lon")


def largest_cities(cities: DataFrame, n: int = 200) -> DataFrame:
    """The n most populous cities."""
    return cities.orderBy(F.desc_nulls_last("population"), "geoname_id").limit(n)
