"""Registered queries: hourly panels, lags, gaps, holidays, star schema, reports on panels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isochron.fixed_values import FEATURE_LAGS, FEATURE_SPANS
from isochron.operators import holidays as holiday_ops
from isochron.operators import panel, regions, reports, silver, star
from isochron.plans import inputs, places, views
from isochron.plans.basics import SQL_RAIN, SQL_SEASON, SQL_TEMPERATURE, SQL_WIND
from isochron.plans.registry import query
from isochron.session import stored

KEY = ["region_clean"]


@query(f"""WITH {inputs.SQL_TYPE_PANEL} SELECT * FROM panel""", rounded=["consumption_mw"])
def hourly_agg(spark: SparkSession, sf: str) -> DataFrame:
    named = inputs.events(spark, sf).withColumnsRenamed({"event_type": "region_clean", "value": "consumption_mw"})
    return panel.mean_by_step(named, KEY, "ts", ["consumption_mw"])


@query(f"""WITH {inputs.SQL_TYPE_PANEL}
SELECT region_clean, ts_utc, consumption_mw, idx::BIGINT AS idx, n_rows::BIGINT AS n_rows, observed FROM dense""",
       rounded=["consumption_mw"])
def densify(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.dense_type_panel(spark, sf)


_LAGGED = [f"consumption_lag_{k}" for k in [*FEATURE_LAGS, 168]]


@query(f"""WITH {inputs.SQL_TYPE_PANEL}
SELECT region_clean, ts_utc, {", ".join(f"lag(consumption_mw, {k}) OVER w AS consumption_lag_{k}" for k in [*FEATURE_LAGS, 168])}
FROM dense WINDOW w AS (PARTITION BY region_clean ORDER BY ts_utc)""", rounded=_LAGGED)
def lag_features(spark: SparkSession, sf: str) -> DataFrame:
    columns = panel.lag_columns("consumption_mw", [*FEATURE_LAGS, 168], "consumption_lag_")
    lagged = panel.with_history(inputs.dense_type_panel(spark, sf), KEY, 168, columns)
    return lagged.select(*KEY, "ts_utc", *columns)


_ROLLED = [f"rolling_mean_{n}" for n in [*FEATURE_SPANS, 168]] + [f"rolling_before_{n}" for n in FEATURE_SPANS]


@query(f"""WITH {inputs.SQL_TYPE_PANEL}
SELECT region_clean, ts_utc,
  {", ".join(f"avg(consumption_mw) OVER (w ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS rolling_mean_{n}" for n in [*FEATURE_SPANS, 168])},
  {", ".join(f"avg(consumption_mw) OVER (w ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) AS rolling_before_{n}" for n in FEATURE_SPANS)}
FROM dense WINDOW w AS (PARTITION BY region_clean ORDER BY ts_utc)""", rounded=_ROLLED)
def rolling_features(spark: SparkSession, sf: str) -> DataFrame:
    columns = panel.rolling_columns("consumption_mw", [*FEATURE_SPANS, 168], "rolling_mean_") | panel.rolling_columns(
        "consumption_mw", FEATURE_SPANS, "rolling_before_", exclude_current=True
    )
    rolled = panel.with_history(inputs.dense_type_panel(spark, sf), KEY, 168, columns)
    return rolled.select(*KEY, "ts_utc", *columns)


SQL_FILLED = """
filled AS (
  SELECT region_clean, ts_utc, idx, n_rows, observed,
         coalesce(last_value(consumption_mw IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                  first_value(consumption_mw IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS consumption_mw
  FROM dense WINDOW w AS (PARTITION BY region_clean ORDER BY ts_utc))"""


@query(f"WITH {inputs.SQL_TYPE_PANEL}, {SQL_FILLED} SELECT region_clean, ts_utc, consumption_mw FROM filled",
       rounded=["consumption_mw"])
def fill_gaps(spark: SparkSession, sf: str) -> DataFrame:
    dense = inputs.dense_type_panel(spark, sf)
    return panel.fill_gaps(dense, KEY, ["consumption_mw"]).select(*KEY, "ts_utc", "consumption_mw")


_SILVER = ["consommation_mw", *inputs.WIDE.values()]
_HISTORY = [*_SILVER, "consommation_lag24", "consommation_lag168", "consommation_roll168", "hour_sin", "hour_cos"]
SQL_DENSE_DEMAND = """
demand_spine AS (
  SELECT region_clean, unnest(generate_series(min(ts_utc), max(ts_utc), INTERVAL 1 HOUR)) AS ts_utc FROM demand GROUP BY 1),
dense_demand AS (SELECT s.region_clean, s.ts_utc, d.* EXCLUDE (region_clean, ts_utc) FROM demand_spine s
                 LEFT JOIN demand d ON d.region_clean = s.region_clean AND d.ts_utc = s.ts_utc)"""


@query(f"""
WITH demand AS (
  SELECT {inputs.sql_pick(inputs.LABELS, "user_id")} AS region_clean, date_trunc('hour', ts) AS ts_utc, avg(value) AS consommation_mw,
         {", ".join(f"avg(value) FILTER (event_type = '{t}') AS {m}" for t, m in inputs.WIDE.items())}
  FROM events GROUP BY 1, 2), {SQL_DENSE_DEMAND},
timed AS (SELECT *, (ts_utc AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Paris' AS ts_paris,
                 lag(consommation_mw, 24) OVER w AS consommation_lag24, lag(consommation_mw, 168) OVER w AS consommation_lag168,
                 avg(consommation_mw) OVER (w ROWS BETWEEN 167 PRECEDING AND CURRENT ROW) AS consommation_roll168
          FROM dense_demand WINDOW w AS (PARTITION BY region_clean ORDER BY ts_utc))
SELECT region_clean, ts_utc, ts_paris, {", ".join(_SILVER)}, hour(ts_paris)::INT AS hour, (dayofweek(ts_paris) + 1)::INT AS dow,
       weekofyear(ts_paris)::INT AS week, month(ts_paris)::INT AS month, dayofyear(ts_paris)::INT AS doy,
       (dayofweek(ts_paris) IN (0, 6))::INT AS is_weekend, sin(2 * pi() * hour(ts_paris) / 24) AS hour_sin,
       cos(2 * pi() * hour(ts_paris) / 24) AS hour_cos, consommation_lag24, consommation_lag168, consommation_roll168
FROM timed""", rounded=_HISTORY)
def demand_silver(spark: SparkSession, sf: str) -> DataFrame:
    """The hourly demand table: means of all measures per region and hour, calendar, cyclic hour, lags and the week's trailing mean."""
    of_type = {m: F.when(F.col("event_type") == t, F.col("value")) for t, m in inputs.WIDE.items()}
    rows = inputs.events(spark, sf).select(
        inputs.pick(inputs.LABELS, F.col("user_id")).alias("region_clean"), "ts", F.col("value").alias("consommation_mw"),
        *[value.alias(name) for name, value in of_type.items()],
    )
    return silver.add_demand_features(stored(panel.mean_by_step(rows, KEY, "ts", _SILVER), "demand"))


SQL_WEATHER = f"""
hourly_weather AS (
  SELECT region_clean, date_trunc('hour', ts) AS ts_utc, avg(temperature_2m) AS temp_c, avg(precip_mm) AS precip_mm, avg(wind_kph) AS wind_kph
  FROM readings GROUP BY 1, 2),
weather AS (
  SELECT *, (ts_utc AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Paris' AS ts_paris,
         {SQL_TEMPERATURE.format("temp_c")} AS temperature_category, {SQL_RAIN.format("precip_mm")} AS precipitation_category,
         {SQL_WIND.format("wind_kph")} AS wind_category
  FROM hourly_weather WHERE temp_c > -50 AND temp_c < 60)"""


@query(f"""
WITH {inputs.SQL_READINGS}, {SQL_WEATHER}
SELECT region_clean, ts_utc, ts_paris, temp_c, precip_mm, wind_kph, hour(ts_paris)::INT AS hour,
       (dayofweek(ts_paris) + 1)::INT AS dow, month(ts_paris)::INT AS month, (dayofweek(ts_paris) IN (0, 6))::INT AS is_weekend,
       {SQL_SEASON.format("month(ts_paris)")} AS season, (hour(ts_paris) BETWEEN 6 AND 20)::INT AS is_daylight,
       CASE WHEN temp_c < 0 THEN 'cold' WHEN temp_c > 30 THEN 'hot' ELSE 'moderate' END AS weather_severity,
       sin(2 * pi() * hour(ts_paris) / 24) AS hour_sin, cos(2 * pi() * hour(ts_paris) / 24) AS hour_cos,
       sin(2 * pi() * month(ts_paris) / 12) AS month_sin, cos(2 * pi() * month(ts_paris) / 12) AS month_cos
FROM weather""", rounded=["temp_c", "precip_mm", "wind_kph", "hour_sin", "hour_cos", "month_sin", "month_cos"])
def weather_hourly(spark: SparkSession, sf: str) -> DataFrame:
    return star.weather_hourly(inputs.region_weather(spark, sf))


@query(f"""
WITH {inputs.SQL_HOLIDAY_ROWS}, {inputs.SQL_HOLIDAYS}
SELECT * REPLACE (date_paris::VARCHAR AS date_paris) FROM holidays""")
def holiday_features(spark: SparkSession, sf: str) -> DataFrame:
    return holiday_ops.holiday_features(inputs.holiday_rows(spark, sf))


@query(f"""
WITH {inputs.SQL_HOLIDAY_ROWS}, {inputs.SQL_HOLIDAYS}
SELECT 'category' AS what, holiday_category AS value, count(*) AS rows FROM holidays GROUP BY 2
UNION ALL SELECT 'season', holiday_season, count(*) FROM holidays GROUP BY 2""")
def holiday_distribution(spark: SparkSession, sf: str) -> DataFrame:
    features = holiday_ops.holiday_features(inputs.holiday_rows(spark, sf))
    parts = [("category", "holiday_category"), ("season", "holiday_season")]
    counted = [holiday_ops.distribution(features, c).select(F.lit(w).alias("what"), F.col(c).alias("value"), "rows") for w, c in parts]
    return counted[0].unionByName(counted[1])


# Star schema over the events: demand, weather, holidays of January.

def _demand_star(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The demand table and the holidays, stored once, and the dimensions of the demand fact."""
    demand = stored(panel.add_calendar(inputs.region_demand(spark, sf), only=[]), "demand")
    holidays = star.dim_holiday(holiday_ops.holiday_features(inputs.january_holidays(spark, sf)))
    return {
        "demand": demand, "dim_time": star.dim_time(demand), "dim_region": star.dim_region(demand),
        "dim_holiday": stored(holidays, "dim-holiday"),
    }


def _star(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The same with the weather table and its dimension."""
    weather = stored(star.weather_hourly(inputs.region_weather(spark, sf)), "weather")
    return _demand_star(spark, sf) | {"weather": weather, "dim_weather_type": star.dim_weather_type(weather)}


def _demand_fact(t: dict[str, DataFrame]) -> DataFrame:
    return star.fact_demand_hourly(t["demand"], t["dim_holiday"])


def _weather_fact(t: dict[str, DataFrame]) -> DataFrame:
    return star.fact_weather_hourly(t["weather"], t["dim_time"], t["dim_region"], t["dim_weather_type"])


SQL_DIM_TIME = f"""
dim_time AS (
  SELECT sha256(ts_utc::VARCHAR) AS time_id, strftime(ts_utc, '%Y%m%d%H') AS time_hour_key, ts_utc, ts_paris,
         hour(ts_paris)::INT AS hour, (dayofweek(ts_paris) + 1)::INT AS dow, strftime(ts_paris, '%A') AS day_name,
         month(ts_paris)::INT AS month, strftime(ts_paris, '%B') AS month_name, quarter(ts_paris)::INT AS quarter,
         year(ts_paris)::INT AS year, dayofyear(ts_paris)::INT AS doy, weekofyear(ts_paris)::INT AS week,
         (dayofweek(ts_paris) IN (0, 6))::INT AS is_weekend, (dayofweek(ts_paris) NOT IN (0, 6))::INT AS is_workday,
         {SQL_SEASON.format("month(ts_paris)")} AS season
  FROM (SELECT DISTINCT ts_utc, (ts_utc AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Paris' AS ts_paris FROM demand))"""
SQL_DIM_REGION = f"""
{inputs.SQL_REGIONS},
dim_region AS (
  SELECT sha256(region_clean) AS region_id, region_clean, region_clean AS region_canon, 'France' AS country, cap_lat, cap_lon
  FROM (SELECT DISTINCT region_clean FROM demand) LEFT JOIN regions ON label = region_clean)"""
SQL_DIM_WEATHER_TYPE = """
dim_weather_type AS (
  SELECT sha256(concat_ws('_', t, p, w)) AS weather_type_id, t AS temperature_category, p AS precipitation_category, w AS wind_category
  FROM (SELECT DISTINCT temperature_category AS t FROM weather WHERE temperature_category IS NOT NULL),
       (SELECT DISTINCT precipitation_category AS p FROM weather WHERE precipitation_category IS NOT NULL),
       (SELECT DISTINCT wind_category AS w FROM weather WHERE wind_category IS NOT NULL))"""
SQL_FACT_DEMAND = """
fact_demand AS (
  SELECT sha256(concat_ws('_', d.ts_utc::VARCHAR, d.region_clean)) AS electricity_record_id, sha256(d.ts_utc::VARCHAR) AS time_id,
         sha256(d.region_clean) AS region_id, sha256(concat_ws('_', h.date_paris::VARCHAR, h.holiday_name)) AS holiday_id_found,
         h.date_paris IS NOT NULL AS has_holiday, coalesce(consommation_mw, 0) AS consumption_mw,
         coalesce(solaire_mw, 0) AS solar_production_mw, coalesce(eolien_mw, 0) AS wind_production_mw,
         coalesce(hydraulique_mw, 0) AS hydro_production_mw, coalesce(nucleaire_mw, 0) AS nuclear_production_mw,
         coalesce(thermique_mw, 0) AS thermal_production_mw, 0.0::DOUBLE AS bioenergy_production_mw, d.ts_utc, d.region_clean,
         (coalesce(solaire_mw, 0) + coalesce(eolien_mw, 0) + coalesce(hydraulique_mw, 0)) / greatest(consommation_mw, 1) AS renewable_ratio
  FROM demand d LEFT JOIN one_holiday h
    ON h.date_paris = ((d.ts_utc AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Paris')::DATE
  WHERE consommation_mw > 0),
fact_electricity AS (
  SELECT electricity_record_id, time_id, region_id, CASE WHEN has_holiday THEN holiday_id_found END AS holiday_id,
         * EXCLUDE (electricity_record_id, time_id, region_id, holiday_id_found, has_holiday) FROM fact_demand)"""
SQL_FACT_WEATHER = """
fact_weather AS (
  SELECT sha256(concat_ws('_', w.ts_utc::VARCHAR, w.region_clean)) AS weather_record_id, dt.time_id, dr.region_id, wt.weather_type_id,
         temp_c AS temperature_c, NULL::DOUBLE AS humidity_percent, wind_kph AS wind_speed_kph, NULL::DOUBLE AS cloud_cover_percent,
         NULL::DOUBLE AS pressure_mb, precip_mm AS precipitation_mm, w.ts_utc, w.region_clean
  FROM weather w JOIN dim_time dt ON dt.ts_utc = w.ts_utc JOIN dim_region dr ON dr.region_clean = w.region_clean
  LEFT JOIN dim_weather_type wt USING (temperature_category, precipitation_category, wind_category)
  WHERE temp_c BETWEEN -50 AND 50)"""
SQL_STAR = ", ".join([
    inputs.SQL_JANUARY_HOLIDAYS, inputs.SQL_HOLIDAYS, inputs.SQL_REGION_DEMAND, inputs.SQL_READINGS, SQL_WEATHER, SQL_DIM_TIME,
    SQL_DIM_REGION, SQL_DIM_WEATHER_TYPE, SQL_FACT_DEMAND, SQL_FACT_WEATHER,
])


@query(f"WITH {inputs.SQL_REGION_DEMAND}, {SQL_DIM_TIME} SELECT * FROM dim_time")
def dim_time(spark: SparkSession, sf: str) -> DataFrame:
    return star.dim_time(inputs.region_demand(spark, sf))


@query(f"WITH {inputs.SQL_REGION_DEMAND}, {SQL_DIM_REGION} SELECT * FROM dim_region")
def dim_region(spark: SparkSession, sf: str) -> DataFrame:
    return star.dim_region(inputs.region_demand(spark, sf))


@query(f"WITH {inputs.SQL_READINGS}, {SQL_WEATHER}, {SQL_DIM_WEATHER_TYPE} SELECT * FROM dim_weather_type")
def dim_weather_type(spark: SparkSession, sf: str) -> DataFrame:
    return star.dim_weather_type(star.weather_hourly(inputs.region_weather(spark, sf)))


@query(f"""
WITH {inputs.SQL_HOLIDAY_ROWS}, {inputs.SQL_HOLIDAYS}
SELECT DISTINCT sha256(concat_ws('_', date_paris::VARCHAR, holiday_name)) AS holiday_id, date_paris::VARCHAR AS date_paris,
       holiday_name, holiday_type, holiday_category, is_national_holiday, is_regional_holiday, is_observance, is_bridge_day,
       is_weekend_adjacent, is_easter_related, holiday_season FROM holidays""")
def dim_holiday(spark: SparkSession, sf: str) -> DataFrame:
    return star.dim_holiday(holiday_ops.holiday_features(inputs.holiday_rows(spark, sf)))


_MEASURES = ["consumption_mw", "solar_production_mw", "wind_production_mw", "hydro_production_mw", "nuclear_production_mw",
             "thermal_production_mw", "renewable_ratio"]


@query(f"WITH {SQL_STAR} SELECT * FROM fact_electricity", rounded=_MEASURES)
def fact_demand_hourly(spark: SparkSession, sf: str) -> DataFrame:
    return _demand_fact(_demand_star(spark, sf))


@query(f"WITH {SQL_STAR} SELECT * FROM fact_weather", rounded=["temperature_c", "wind_speed_kph", "precipitation_mm"])
def fact_weather_hourly(spark: SparkSession, sf: str) -> DataFrame:
    return _weather_fact(_star(spark, sf))


@query(f"""
WITH {inputs.SQL_READINGS}, {SQL_WEATHER}, {SQL_DIM_WEATHER_TYPE}
SELECT region_clean, ts_utc, 'cumulative' AS mode, weather_type_id FROM weather w LEFT JOIN dim_weather_type t
  ON ((temp_c < 0 AND t.temperature_category = 'very_cold') OR (temp_c < 10 AND t.temperature_category = 'cold')
      OR (temp_c < 20 AND t.temperature_category = 'cool') OR (temp_c < 30 AND t.temperature_category = 'warm')
      OR t.temperature_category = 'hot')
  AND t.precipitation_category = w.precipitation_category AND t.wind_category = w.wind_category
WHERE w.precipitation_category IS NOT NULL AND w.wind_category IS NOT NULL
UNION ALL
SELECT region_clean, ts_utc, 'disjoint', weather_type_id FROM weather
LEFT JOIN dim_weather_type USING (temperature_category, precipitation_category, wind_category)""")
def weather_type_range_join(spark: SparkSession, sf: str) -> DataFrame:
    """Hours with all three measures under the cumulative rule, all hours under the disjoint one."""
    weather = stored(star.weather_hourly(inputs.region_weather(spark, sf)), "weather")
    types = star.dim_weather_type(weather)
    complete = weather.where("precip_mm IS NOT NULL AND wind_kph IS NOT NULL")
    both = [(complete, "cumulative", True), (weather, "disjoint", False)]
    joined = [
        star.with_weather_type(rows, types, cumulative).select(*KEY, "ts_utc", F.lit(mode).alias("mode"), "weather_type_id")
        for rows, mode, cumulative in both
    ]
    return joined[0].unionByName(joined[1])


_DAILY = ["avg_daily_consumption", "total_daily_consumption", "avg_renewable_ratio", "avg_daily_temperature",
          "max_daily_precipitation", "avg_wind_speed"]


def _sql_daily(day: str) -> str:
    return f"""
SELECT {day} AS date_paris, dr.region_clean, dr.region_canon, dr.cap_lat, dr.cap_lon,
       avg(fe.consumption_mw) AS avg_daily_consumption, sum(fe.consumption_mw) AS total_daily_consumption,
       avg(fe.renewable_ratio) AS avg_renewable_ratio, avg(fw.temperature_c) AS avg_daily_temperature,
       avg(fw.humidity_percent) AS avg_humidity, max(fw.precipitation_mm) AS max_daily_precipitation,
       avg(fw.wind_speed_kph) AS avg_wind_speed,
       coalesce(dh.holiday_name, 'No Holiday') AS holiday_name, coalesce(dh.holiday_type, 'No Holiday') AS holiday_type,
       coalesce(dh.is_national_holiday, 0) AS is_national_holiday, coalesce(dh.is_weekend_adjacent, 0) AS is_weekend_adjacent,
       dt.day_name, dt.month_name, dt.season, dt.is_weekend, dt.is_workday
FROM fact_electricity fe JOIN dim_time dt ON fe.time_id = dt.time_id JOIN dim_region dr ON fe.region_id = dr.region_id
LEFT JOIN one_holiday dh ON dt.ts_paris::DATE = dh.date_paris
LEFT JOIN fact_weather fw ON fe.time_id = fw.time_id AND fe.region_id = fw.region_id
GROUP BY ALL"""


@query(f"WITH {SQL_STAR} {_sql_daily('dt.ts_paris::DATE::VARCHAR')}", rounded=_DAILY)
def view_daily(spark: SparkSession, sf: str) -> DataFrame:
    t = _star(spark, sf)
    return views.daily_demand_weather(_demand_fact(t), _weather_fact(t), t["dim_time"], t["dim_region"], t["dim_holiday"])


@query(f"WITH {SQL_STAR} {_sql_daily('dt.ts_paris')}", rounded=_DAILY)
def view_daily_per_hour(spark: SparkSession, sf: str) -> DataFrame:
    """The same view grouped by the hourly local timestamp."""
    t = _star(spark, sf)
    return views.daily_demand_weather(_demand_fact(t), _weather_fact(t), t["dim_time"], t["dim_region"], t["dim_holiday"], per_hour=True)


@query(f"""WITH {inputs.SQL_TYPE_PANEL}
SELECT count(DISTINCT region_clean) AS series, count(*) AS rows, avg(consumption_mw) AS mean, min(consumption_mw) AS min,
       max(consumption_mw) AS max, min(ts_utc) AS first_ts, max(ts_utc) AS last_ts FROM panel""", rounded=["mean", "min", "max"])
def panel_summary(spark: SparkSession, sf: str) -> DataFrame:
    return reports.panel_summary(hourly_agg(spark, sf), "region_clean", "consumption_mw")


SQL_ANALYTICS = """
analytics AS (
  SELECT fe.region_clean, fe.ts_utc, consumption_mw, temperature_c, solar_production_mw, wind_production_mw
  FROM fact_electricity fe LEFT JOIN fact_weather fw ON fe.time_id = fw.time_id AND fe.region_id = fw.region_id)"""


def _analytics(spark: SparkSession, sf: str) -> DataFrame:
    t = _star(spark, sf)
    return star.analytics_panel(_demand_fact(t), _weather_fact(t))


@query(f"WITH {SQL_STAR}, {SQL_ANALYTICS} SELECT * FROM analytics",
       rounded=["consumption_mw", "temperature_c", "solar_production_mw", "wind_production_mw"])
def analytics_panel(spark: SparkSession, sf: str) -> DataFrame:
    return _analytics(spark, sf)


_CORRELATED = {"consumption_temperature_correlation": "temperature_c",
               "consumption_solar_production_mw_correlation": "solar_production_mw",
               "consumption_wind_production_mw_correlation": "wind_production_mw"}


@query(f"""WITH {SQL_STAR}, {SQL_ANALYTICS}
SELECT region_clean, {", ".join(f"CASE WHEN isnan(corr(consumption_mw, {c})) THEN NULL ELSE corr(consumption_mw, {c}) END AS {n}" for n, c in _CORRELATED.items())},
       count(*) AS sample_size FROM analytics GROUP BY 1 HAVING count(*) >= 10""", rounded=list(_CORRELATED), digits=6)
def weather_correlation(spark: SparkSession, sf: str) -> DataFrame:
    return reports.weather_correlations(_analytics(spark, sf))


@query(f"""WITH {inputs.SQL_REGION_DEMAND}, {SQL_DENSE_DEMAND},
lagged AS (SELECT region_clean, consommation_mw AS y, unnest([0, 1, 2, 3, 6]) AS lag, unnest([solaire_mw, lag(solaire_mw, 1) OVER w,
           lag(solaire_mw, 2) OVER w, lag(solaire_mw, 3) OVER w, lag(solaire_mw, 6) OVER w]) AS x
           FROM dense_demand WINDOW w AS (PARTITION BY region_clean ORDER BY ts_utc))
SELECT region_clean, lag, corr(y, x) AS correlation FROM lagged GROUP BY 1, 2""", rounded=["correlation"], digits=6)
def lagged_correlation(spark: SparkSession, sf: str) -> DataFrame:
    demand = stored(inputs.region_demand(spark, sf).select(*KEY, "ts_utc", "consommation_mw", "solaire_mw"), "demand")
    return reports.lagged_correlations(panel.densify(demand, KEY), "solaire_mw", "consommation_mw")


# Raw rows to hourly tables.

def _raw_demand(spark: SparkSession, sf: str) -> DataFrame:
    """Raw demand rows: region spellings, local clock as text, measures with decimal comma, some without a number."""
    local = F.from_utc_timestamp("ts", "Europe/Paris")
    comma = F.translate(F.col("value").cast("string"), ".", ",")
    return inputs.events(spark, sf).select(
        inputs.pick(inputs.SPELLINGS, F.col("user_id")).alias("region"),
        F.date_format(local, "yyyy-MM-dd").alias("date"), F.date_format(local, "HH:mm").alias("heure"),
        F.when(F.col("event_type") == "error", "ND").otherwise(comma).alias("consommation_mw"),
        F.when(F.col("event_type") == "view", comma).alias("solaire_mw"),
    )


SQL_RAW_DEMAND = f"""
raw_names AS (SELECT {inputs.sql_pick(inputs.SPELLINGS, "user_id")} AS region, ts, event_type, value FROM events), {{0}}"""


@query(f"""
WITH {SQL_RAW_DEMAND.format(places.SQL_MAP)}
SELECT region_clean, date_trunc('hour', ts) AS ts_utc, avg(CASE WHEN event_type <> 'error' THEN value END) AS consommation_mw,
       avg(CASE WHEN event_type = 'view' THEN value END) AS solaire_mw
FROM mapped WHERE region_canon IN (SELECT canon FROM regions) GROUP BY 1, 2""", rounded=["consommation_mw", "solaire_mw"])
def demand_from_raw(spark: SparkSession, sf: str) -> DataFrame:
    return silver.demand_hourly(_raw_demand(spark, sf))


@query(f"""
WITH {places.SQL_CITY_MAP}, {inputs.SQL_READINGS}
SELECT r.c AS region_clean, date_trunc('hour', ts) AS ts_utc, avg(temperature_2m) AS temp_c
FROM readings JOIN lookup ON city_norm = {places.SQL_CITY_NORM.format("city_name")} GROUP BY 1, 2
HAVING avg(temperature_2m) > -50 AND avg(temperature_2m) < 60""", rounded=["temp_c"])
def weather_from_cities(spark: SparkSession, sf: str) -> DataFrame:
    mapping = regions.region_mapping(inputs.city_rows(spark, sf))
    readings = inputs.readings(spark, sf).select("city_name", "date", "temperature_2m")
    return silver.weather_by_region(readings, mapping).select(*KEY, "ts_utc", "temp_c")
