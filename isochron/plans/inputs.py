"""The given tables as inputs of the operators, and the same inputs in SQL.

Events stand for hourly measurements: a series is an event type or a region (user_id modulo 13), y is the value.
Orders stand for daily totals and for holidays. The SQL fragments are lists of common table expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isochron.fixed_values import REGIONS
from isochron.functions.binding import literal
from isochron.functions.regions import LABELS
from isochron.operators.panel import densify, mean_by_step
from isochron.session import stored
from isochron.sources.tables import scan

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
}

# Spellings of region names in raw data: standard, former, foreign, overseas, unknown, missing.
SPELLINGS = [
    "Île-de-France", "ile de france", "PACA", "Provence-Alpes-Côte d'Azur", "Provence Alpes", "Alsace", "AQUITAINE",
    "Champagne-Ardenne", "Rhône-Alpes", "Rhone-Alpe", "Guadeloupe", "Réunion", "Pays de Loire", "Pays-de-la-Loire",
    "Nord-Pas-de-Calais", "Picardie", "Corsica", "Bretagne", "Unknownland", "Centre-Val de Loire", "Centre",
    "Hauts-de-France", "Normandie (Haute)", "Grand Est", "nan", "Bourgogne–Franche-Comté", "Occitanie / Midi", "",
    "Auvergne", "Midi_Pyrénées", "GrandEst",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return scan(spark, f"{sf_dir}/{name}.parquet", SCHEMAS[name])


def pick(values: list[str], number: Column) -> Column:
    """The value at a number modulo the length of the list."""
    return F.get(literal(values, "array<string>"), (number % len(values)).cast("int"))


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sql_pick(values: list[str], number: str) -> str:
    return "[" + ", ".join(map(sql_text, values)) + f"][{number} % {len(values)} + 1]"


def sql_rows(rows: list[tuple]) -> str:
    """Rows of a VALUES list."""
    def cell(value) -> str:
        if isinstance(value, str):
            return sql_text(value)
        return "NULL" if value is None else f"{value}::DOUBLE" if isinstance(value, float) else str(value)

    return ", ".join("(" + ", ".join(map(cell, row)) + ")" for row in rows)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def type_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly mean value per event type, stored: one scan of the events, whatever is built on it."""
    named = events(spark, sf_dir).select(F.col("event_type").alias("region_clean"), "ts", F.col("value").alias("consumption_mw"))
    return stored(mean_by_step(named, ["region_clean"], "ts", ["consumption_mw"]), "type-panel")


def dense_type_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return densify(type_panel(spark, sf_dir), ["region_clean"])


def sql_dense(panel: str, measures: str = "p.consumption_mw") -> str:
    """CTEs panel and dense (with idx, n_rows, observed) of a query for (region_clean, ts_utc, measures)."""
    return f"""
panel AS ({panel}),
spine AS (
  SELECT region_clean, unnest(generate_series(min(ts_utc), max(ts_utc), INTERVAL 1 HOUR)) AS ts_utc
  FROM panel GROUP BY 1),
dense AS (
  SELECT s.region_clean, s.ts_utc, {measures}, p.ts_utc IS NOT NULL AS observed,
         row_number() OVER (PARTITION BY s.region_clean ORDER BY s.ts_utc) - 1 AS idx,
         count(*) OVER (PARTITION BY s.region_clean) AS n_rows
  FROM spine s LEFT JOIN panel p ON s.region_clean = p.region_clean AND s.ts_utc = p.ts_utc)"""


SQL_TYPE_PANEL = sql_dense("""
  SELECT event_type AS region_clean, date_trunc('hour', ts) AS ts_utc, avg(value) AS consumption_mw
  FROM events GROUP BY 1, 2""")

# Event type -> stored measure of wide demand rows.
WIDE = {"view": "solaire_mw", "click": "eolien_mw", "signup": "hydraulique_mw", "error": "thermique_mw",
        "purchase": "nucleaire_mw"}


def region_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly demand per region label: the sum of all values, and the sum per event type as sources."""
    hours = events(spark, sf_dir).groupBy(
        pick(LABELS, F.col("user_id")).alias("region_clean"), F.date_trunc("hour", "ts").alias("ts_utc")
    )
    of_type = [F.sum(F.when(F.col("event_type") == t, F.col("value"))).alias(m) for t, m in WIDE.items()]
    return hours.agg(F.sum("value").alias("consommation_mw"), *of_type)


SQL_REGION_DEMAND = f"""
demand AS (
  SELECT {sql_pick(LABELS, "user_id")} AS region_clean, date_trunc('hour', ts) AS ts_utc,
         sum(value) AS consommation_mw,
         {", ".join(f"sum(value) FILTER (event_type = '{t}') AS {m}" for t, m in WIDE.items())}
  FROM events GROUP BY 1, 2)"""


def city_of(user: Column) -> Column:
    """A city name without digits: the digits of the user as letters, every other one a saint."""
    letters = F.translate(user.cast("string"), "0123456789", "abcdefghij")
    return F.concat(F.when(user % 2 == 0, "St ").otherwise("Côte-"), letters)


def city_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw (region, city) pairs, one city per user, the region in some spelling."""
    users = events(spark, sf_dir).select("user_id").distinct()
    return users.select(pick(SPELLINGS, F.col("user_id")).alias("region"), city_of(F.col("user_id")).alias("city"))


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw weather readings per city: views carry temperatures, clicks rain, errors wind; the clock is in nanoseconds."""
    value = F.col("value")
    return events(spark, sf_dir).select(
        city_of(F.col("user_id")).alias("city_name"), "user_id", "event_id",
        (F.unix_micros("ts") * 1000).alias("date"),
        F.when(F.col("event_type") == "view", value / 10 - 2).alias("temperature_2m"),
        F.when(F.col("event_type") == "click", value / 50).alias("precip_mm"),
        F.when(F.col("event_type") == "error", value / 3).alias("wind_kph"),
    )


def region_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings by region label of the user, clock as timestamp."""
    rows = readings(spark, sf_dir)
    return rows.select(
        pick(LABELS, F.col("user_id")).alias("region_clean"),
        F.timestamp_micros(F.call_function("div", F.col("date"), F.lit(1000))).alias("ts_utc"),
        "temperature_2m", "precip_mm", "wind_kph",
    )


SQL_CITY = "CASE WHEN user_id % 2 = 0 THEN 'St ' ELSE 'Côte-' END || translate(user_id::VARCHAR, '0123456789', 'abcdefghij')"
SQL_READINGS = f"""
readings AS (
  SELECT {SQL_CITY} AS city_name, user_id, ts, {sql_pick(LABELS, "user_id")} AS region_clean,
         CASE WHEN event_type = 'view' THEN value / 10 - 2 END AS temperature_2m,
         CASE WHEN event_type = 'click' THEN value / 50 END AS precip_mm,
         CASE WHEN event_type = 'error' THEN value / 3 END AS wind_kph
  FROM events)"""


def holiday_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw calendar rows: distinct (date, priority, holiday or not) of all orders, typed by priority; holidays are those of
    finished orders. Stored, as calendars read them often."""
    orders = table(spark, sf_dir, "orders")
    types = ["National", "Regional", "Observance", "Season", "Other"]
    rank = F.substring("o_orderpriority", 1, 1).cast("int")
    rows = orders.select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.lit("France").alias("country"),
        (F.col("o_orderstatus") == "F").alias("is_holiday"), F.concat(F.lit("Holiday "), F.col("o_orderpriority")).alias("holiday_name"),
        pick(types, rank - 1).alias("holiday_type"),
        F.when(rank == 2, "Regional").otherwise("National").alias("location"),
    )
    return stored(rows.distinct(), "holiday-rows")


def january_holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Holidays in the month of the events: all calendar rows moved to January 2024 by their day of month."""
    rows = holiday_rows(spark, sf_dir)
    return rows.withColumn(
        "date", F.concat(F.lit("2024-01-"), F.substring("date", 9, 2))
    ).distinct()


SQL_HOLIDAY_ROWS = """
holiday_rows AS (
  SELECT DISTINCT o_orderdate::DATE AS date_paris, 'Holiday ' || o_orderpriority AS holiday_name,
         ['National', 'Regional', 'Observance', 'Season', 'Other'][substr(o_orderpriority, 1, 1)::INT] AS holiday_type,
         CASE WHEN substr(o_orderpriority, 1, 1) = '2' THEN 'Regional' ELSE 'National' END AS location
  FROM orders WHERE o_orderstatus = 'F')"""
SQL_JANUARY_HOLIDAYS = SQL_HOLIDAY_ROWS.replace("holiday_rows AS", "all_holiday_rows AS") + """,
holiday_rows AS (
  SELECT DISTINCT make_date(2024, 1, day(date_paris)) AS date_paris, holiday_name, holiday_type, location
  FROM all_holiday_rows)"""

# Easter by another rule than the engine's (epact and weekday of the full moon).
SQL_EASTER = """
golden AS (SELECT y, y % 19 AS g, y // 100 AS c FROM years),
moon AS (SELECT y, c, g, (c - c // 4 - (8 * c + 13) // 25 + 19 * g + 15) % 30 AS h FROM golden),
full_moon AS (SELECT y, c, h - (h // 28) * (1 - (29 // (h + 1)) * ((21 - g) // 11)) AS i FROM moon),
sunday AS (SELECT y, i - (y + y // 4 + i + 2 - c + c // 4) % 7 AS l FROM full_moon),
easter AS (SELECT y, make_date(y, 3 + (l + 40) // 44, l + 28 - 31 * ((3 + (l + 40) // 44) // 4)) AS easter_date FROM sunday)"""

SQL_HOLIDAYS = """
years AS (SELECT DISTINCT year(date_paris)::BIGINT AS y FROM holiday_rows),""" + SQL_EASTER + """,
dates AS (SELECT DISTINCT date_paris FROM holiday_rows),
marked AS (
  SELECT h.*, dayofweek(h.date_paris) + 1 AS dow, n.date_paris IS NOT NULL AS next_day, p.date_paris IS NOT NULL AS previous_day
  FROM holiday_rows h LEFT JOIN dates n ON n.date_paris = h.date_paris + INTERVAL 1 DAY
  LEFT JOIN dates p ON p.date_paris = h.date_paris - INTERVAL 1 DAY),
holidays AS (
  SELECT date_paris, date_paris::TIMESTAMP AS ts_utc,
         (date_paris::TIMESTAMP AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Paris' AS ts_paris,
         holiday_name, holiday_type, location,
         CASE WHEN holiday_type IN ('National', 'Federal', 'Public') THEN 'national'
              WHEN holiday_type IN ('Regional', 'Local') THEN 'regional'
              WHEN holiday_type IN ('Observance', 'Season') THEN 'observance' ELSE 'other' END AS holiday_category,
         (holiday_type IN ('National', 'Federal', 'Public'))::INT AS is_national_holiday,
         (holiday_type IN ('Regional', 'Local'))::INT AS is_regional_holiday,
         (holiday_type IN ('Observance', 'Season'))::INT AS is_observance,
         ((dow = 5 AND next_day) OR (dow = 3 AND previous_day))::INT AS is_bridge_day,
         (dow IN (1, 7) OR (dow = 5 AND next_day) OR (dow = 3 AND previous_day))::INT AS is_weekend_adjacent,
         (holiday_name LIKE '%Easter%' OR holiday_name LIKE '%Pâques%'
          OR abs(date_diff('day', e.easter_date, date_paris)) <= 7)::INT AS is_easter_related,
         CASE WHEN month(date_paris) = 12 AND day(date_paris) >= 24 THEN 'christmas_week'
              WHEN month(date_paris) = 1 AND day(date_paris) = 1 THEN 'new_year'
              WHEN month(date_paris) = 12 AND day(date_paris) BETWEEN 15 AND 23 THEN 'pre_christmas'
              WHEN month(date_paris) IN (7, 8) THEN 'summer_holidays'
              WHEN month(date_paris) = 4 AND day(date_paris) <= 15 THEN 'spring_holidays'
              ELSE 'regular_holiday' END AS holiday_season,
         year(date_paris)::INT AS year, month(date_paris)::INT AS month, day(date_paris)::INT AS day, dow::INT AS dow,
         dayofyear(date_paris)::INT AS doy, weekofyear(date_paris)::INT AS week, quarter(date_paris)::INT AS quarter
  FROM marked JOIN easter e ON e.y = year(date_paris)),
one_holiday AS (
  SELECT * FROM holidays
  QUALIFY row_number() OVER (PARTITION BY date_paris ORDER BY is_national_holiday DESC, holiday_name, holiday_type, location) = 1)"""

SQL_REGIONS = f"regions(canon, label, cap_lat, cap_lon) AS (VALUES {sql_rows(REGIONS)})"
