"""Registered queries: scans, records, texts, numbers, clocks, row operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isochron.functions import buckets, clock, numeric, text
from isochron.operators import panel, regions, shape
from isochron.plans import inputs
from isochron.plans.registry import query
from isochron.sources import records
from isochron.sources.tables import drain_once

Rows = DataFrame
Session = SparkSession


@query("SELECT event_id, event_type, value FROM events")
def scan_table(spark: Session, sf: str) -> Rows:
    return inputs.table(spark, sf, "events").select("event_id", "event_type", "value")


@query("SELECT event_id, event_type, value FROM events WHERE value > 100")
def scan_filtered(spark: Session, sf: str) -> Rows:
    """The filter and the three columns reach the scan."""
    return inputs.table(spark, sf, "events").where("value > 100").select("event_id", "event_type", "value")


@query("SELECT event_id, event_type, value FROM events")
def incremental_scan(spark: Session, sf: str) -> Rows:
    schema = T.StructType.fromDDL(inputs.SCHEMAS["events"])
    return drain_once(
        spark, sf, schema, pattern="events.parquet", transform=lambda df: df.select("event_id", "event_type", "value")
    )


@query("""
SELECT event_id, (props->>'k')::BIGINT AS k FROM events
UNION ALL SELECT event_id, (props->>'k')::BIGINT FROM events WHERE event_type NOT IN ('error', 'view')""")
def json_flatten(spark: Session, sf: str) -> Rows:
    kind, props = F.col("event_type"), F.col("props")
    payload = (
        F.when(kind == "error", F.concat(F.lit('{"records":[{"fields":'), props, F.lit("}]}")))
        .when(kind == "view", F.concat(F.lit('{"results":[{"fields":'), props, F.lit("}]}")))
        .otherwise(F.concat(F.lit('{"results":['), props, F.lit(","), props, F.lit("]}")))
    )
    rows = inputs.table(spark, sf, "events").select("event_id", payload.alias("payload"))
    return records.flatten_records(rows, "payload", "k bigint")


@query(f"""
WITH {inputs.SQL_TYPE_PANEL}
SELECT region_clean, ts_utc, consumption_mw, count(*) OVER (PARTITION BY region_clean, ts_utc::DATE) AS steps FROM dense
""", rounded=["consumption_mw"])
def hourly_expand(spark: Session, sf: str) -> Rows:
    """Days as (start, end, step, values), at most 24 values each, expanded to hours again."""
    dense = inputs.dense_type_panel(spark, sf)
    cells = F.array_sort(F.collect_list(F.struct("ts_utc", "consumption_mw")))
    days = dense.groupBy("region_clean", F.to_date("ts_utc").alias("day")).agg(
        F.min("ts_utc").alias("t0"), (F.max("ts_utc") + F.expr("interval 1 hour")).alias("t1"),
        F.count("*").alias("steps"), cells.alias("cells"),
    )
    arrays = days.select("region_clean", "t0", "t1", F.lit(3600).alias("step_s"), "steps",
                         F.col("cells.consumption_mw").alias("consumption_mw"))
    return records.expand_series(arrays, "t0", "t1", "step_s", ["consumption_mw"])


@query("""
WITH found AS (
  SELECT DISTINCT o_orderdate::DATE AS date, 'Large ' || o_orderpriority AS holiday_name FROM orders),
days AS (
  SELECT unnest(generate_series(date_trunc('year', min(date)), date_trunc('year', max(date)) + INTERVAL 1 YEAR - INTERVAL 1 DAY,
                INTERVAL 1 DAY))::DATE AS date FROM found)
SELECT d.date::VARCHAR AS date, 'France' AS country, f.date IS NOT NULL AS is_holiday, coalesce(holiday_name, '') AS holiday_name,
       CASE WHEN f.date IS NULL THEN '' ELSE 'National' END AS holiday_type, 'National' AS location,
       year(d.date)::INT AS year, month(d.date)::INT AS month, day(d.date)::INT AS day
FROM days d LEFT JOIN found f ON d.date = f.date""")
def calendar_spine(spark: Session, sf: str) -> Rows:
    from isochron.operators.holidays import calendar_spine as spine

    found = inputs.table(spark, sf, "orders").select(
        F.to_date("o_orderdate").alias("date"), F.concat(F.lit("Large "), "o_orderpriority").alias("holiday_name"),
        F.lit("National").alias("holiday_type"), F.lit(None).cast("string").alias("location"),
    ).distinct()
    return spine(found, "France")


SQL_LINKS = r"""
raw_links AS (
  SELECT DISTINCT regexp_extract(url, '^https?://([^/]+)', 1) AS region,
         trim(regexp_replace(link, '(?s)<[^>]*>', '', 'g')) AS city
  FROM (SELECT url, unnest(regexp_extract_all(html, '(?is)<li[^>]*>\s*(?:<div[^>]*>\s*)?<a[^>]*>(.*?)</a>', 1)) AS link FROM pages)),
links AS (SELECT * FROM raw_links WHERE region <> '' AND city <> '')"""


def _links(spark: Session, sf: str) -> Rows:
    host = F.regexp_extract("url", "^https?://([^/]+)", 1)
    return records.section_links(inputs.table(spark, sf, "pages"), "html", host)


@query(f"WITH {SQL_LINKS} SELECT * FROM links")
def html_links(spark: Session, sf: str) -> Rows:
    return _links(spark, sf)


@query(f"""
WITH {SQL_LINKS}
SELECT region, city, count(*) OVER (PARTITION BY region) AS city_count, trim(region) AS region_clean,
       replace(upper(substr(city, 1, 1)), 'ẞ', 'SS') AS city_first_letter FROM links""")
def entity_enrich(spark: Session, sf: str) -> Rows:
    return regions.enrich_cities(_links(spark, sf))


@query(f"WITH {SQL_LINKS} SELECT region, count(*) AS cities FROM links GROUP BY 1 ORDER BY cities DESC, region LIMIT 5")
def top_groups(spark: Session, sf: str) -> Rows:
    return regions.top_groups(_links(spark, sf), "region", F.count("*"), "cities")


def _digests(spark: Session, sf: str, function) -> Rows:
    """A function of every whole document text, as length and digest."""
    done = inputs.table(spark, sf, "documents").select("doc_id", function(F.col("text")).alias("t"))
    return done.select("doc_id", F.length("t").alias("n_chars"), F.sha2("t", 256).alias("digest"))


def _sql_digests(expression: str) -> str:
    return f"SELECT doc_id, length(t)::INT AS n_chars, sha256(t) AS digest FROM (SELECT doc_id, {expression} AS t FROM documents)"


SQL_SQUEEZE = r"trim(regexp_replace({0}, '\s+', ' ', 'g'))"
SQL_CANON = SQL_SQUEEZE.format(r"""regexp_replace(strip_accents(lower(trim({0}))), '[''’\-_.,()/\\]', ' ', 'g')""")
SQL_CITY_NORM = (
    "regexp_replace(regexp_replace(replace(replace("
    + SQL_SQUEEZE.format(r"regexp_replace(strip_accents(lower({0})), '[^a-z\s\-]', ' ', 'g')")
    + ", ' ste ', ' sainte '), ' st ', ' saint '), '^ste ', 'sainte '), '^st ', 'saint ')"
)


@query(_sql_digests("strip_accents(text)"))
def strip_accents(spark: Session, sf: str) -> Rows:
    return _digests(spark, sf, text.strip_accents)


@query(_sql_digests(SQL_CANON.format("text")))
def canonicalize_text(spark: Session, sf: str) -> Rows:
    return _digests(spark, sf, text.canonicalize)


@query(_sql_digests(SQL_CITY_NORM.format("text")))
def normalize_city(spark: Session, sf: str) -> Rows:
    return _digests(spark, sf, text.normalize_city)


@query(_sql_digests(r"regexp_replace(strip_accents(trim(text)), '[^\p{L}\p{N}_\-.]+', '_', 'g')"))
def sanitize_name(spark: Session, sf: str) -> Rows:
    return _digests(spark, sf, text.sanitize)


@query("""
SELECT p_partkey, unnest(range(len(words)))::INT AS pos, unnest(words) AS item
FROM (SELECT p_partkey, list_concat(string_split(p_name, ' '), [p_brand]) AS words FROM part)""")
def parse_list(spark: Session, sf: str) -> Rows:
    part = inputs.table(spark, sf, "part")
    words = F.concat(F.split("p_name", " "), F.array("p_brand"))
    literal = F.concat(F.lit("['"), F.array_join(words, "', '"), F.lit("']"))
    listed = F.when(F.col("p_size") % 2 == 0, literal).otherwise(F.concat(F.array_join(words, ", "), F.lit(",")))
    return part.select("p_partkey", F.posexplode(text.parse_list(listed)).alias("pos", "item"))


@query("SELECT o_orderkey, sha256(concat_ws('_', o_orderdate::VARCHAR, nullif(o_orderstatus, 'P'), o_orderkey::VARCHAR)) AS id FROM orders")
def surrogate_key(spark: Session, sf: str) -> Rows:
    status = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    return inputs.table(spark, sf, "orders").select(
        "o_orderkey", text.surrogate_key(F.col("o_orderdate"), status, F.col("o_orderkey")).alias("id")
    )


def _number_texts(spark: Session, sf: str) -> Rows:
    """Values as text with decimal comma, blanks and no-number marks."""
    comma = F.translate(F.col("value").cast("string"), ".", ",")
    marks = (
        F.when(F.col("event_type") == "error", "ND").when(F.col("event_type") == "click", F.concat(F.lit(" 1 "), comma))
        .when(F.col("event_type") == "signup", F.concat(comma, F.lit(" "))).otherwise(comma)
    )
    return inputs.table(spark, sf, "events").select("event_id", marks.alias("solaire_mw"), "props",
                                                    F.col("value").cast("string").alias("text"), "event_type")


@query("""SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'click' THEN ('1' || value::VARCHAR)::DOUBLE
          ELSE value END AS solaire_mw, props FROM events""")
def coerce_numeric(spark: Session, sf: str) -> Rows:
    return numeric.coerce_numeric(_number_texts(spark, sf).select("event_id", "solaire_mw", "props"))


@query("SELECT event_id, CASE WHEN event_type = 'error' THEN 0.0::DOUBLE ELSE value END AS value FROM events")
def cast_or_zero(spark: Session, sf: str) -> Rows:
    rows = _number_texts(spark, sf)
    raw = F.when(F.col("event_type") == "error", F.lit("-")).otherwise(F.col("text"))
    return rows.select("event_id", numeric.number_or_zero(raw).alias("value"))


@query("""
SELECT event_id, sin(2 * pi() * hour(ts) / 24) AS hour_sin, cos(2 * pi() * hour(ts) / 24) AS hour_cos,
       sin(2 * pi() * month(ts) / 12) AS month_sin, cos(2 * pi() * month(ts) / 12) AS month_cos,
       sin(2 * pi() * dayofweek(ts) / 7) AS dow_sin, cos(2 * pi() * dayofweek(ts) / 7) AS dow_cos FROM events
""", rounded=["hour_sin", "hour_cos", "month_sin", "month_cos", "dow_sin", "dow_cos"], digits=6)
def cyclic_features(spark: Session, sf: str) -> Rows:
    rows = inputs.table(spark, sf, "events").select(
        "event_id", F.hour("ts").alias("hour"), F.month("ts").alias("month"), (F.dayofweek("ts") - 1).alias("dow")
    )
    return panel.add_cyclic(rows, hour=24, month=12, dow=7).drop("hour", "month", "dow")


SQL_TEMPERATURE = "CASE WHEN {0} < 0 THEN 'very_cold' WHEN {0} < 10 THEN 'cold' WHEN {0} < 20 THEN 'cool' WHEN {0} < 30 THEN 'warm' WHEN {0} IS NOT NULL THEN 'hot' END"
SQL_RAIN = "CASE WHEN {0} > 5 THEN 'heavy_rain' WHEN {0} > 1 THEN 'light_rain' WHEN {0} > 0 THEN 'drizzle' WHEN {0} IS NOT NULL THEN 'dry' END"
SQL_WIND = "CASE WHEN {0} > 30 THEN 'strong_wind' WHEN {0} > 15 THEN 'moderate_wind' WHEN {0} IS NOT NULL THEN 'light_wind' END"
SQL_SEASON = "CASE WHEN {0} IN (3, 4, 5) THEN 'spring' WHEN {0} IN (6, 7, 8) THEN 'summer' WHEN {0} IN (9, 10, 11) THEN 'autumn' ELSE 'winter' END"
SQL_RATING = "CASE WHEN {0} IS NULL THEN 'Unrated' WHEN {0} < 100 THEN 'Excellent' WHEN {0} < 500 THEN 'Good' WHEN {0} < 1000 THEN 'Fair' ELSE 'Poor' END"


@query(f"""
SELECT o_orderkey, {SQL_TEMPERATURE.format("v")} AS temperature, {SQL_RAIN.format("v")} AS rain, {SQL_WIND.format("v")} AS wind,
       CASE WHEN v < 0 THEN 'cold' WHEN v > 30 THEN 'hot' WHEN v IS NOT NULL THEN 'moderate' END AS severity,
       {SQL_SEASON.format("month(o_orderdate)")} AS season, (v BETWEEN 6 AND 20)::INT AS is_daylight,
       {SQL_RATING.format("v * 30")} AS rating
FROM (SELECT o_orderkey, o_orderdate, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey % 45 - 5 END AS v FROM orders)
WHERE v IS NOT NULL OR true""".replace("(v BETWEEN 6 AND 20)::INT", "coalesce((v BETWEEN 6 AND 20)::INT, 0)"))
def bucket_labels(spark: Session, sf: str) -> Rows:
    v = F.when(F.col("o_orderstatus") != "P", F.col("o_custkey") % 45 - 5)
    rows = inputs.table(spark, sf, "orders").select("o_orderkey", "o_orderdate", v.alias("v"))
    v = F.col("v")
    return rows.select(
        "o_orderkey", buckets.temperature_category(v).alias("temperature"), buckets.precipitation_category(v).alias("rain"),
        buckets.wind_category(v).alias("wind"), buckets.weather_severity(v).alias("severity"),
        buckets.season(F.month("o_orderdate")).alias("season"), buckets.is_daylight(v).alias("is_daylight"),
        buckets.performance_rating(v * 30).alias("rating"),
    )


@query(f"""
WITH {inputs.SQL_REGION_DEMAND}
SELECT region_clean, ts_utc, (coalesce(solaire_mw, 0) + coalesce(eolien_mw, 0) + coalesce(hydraulique_mw, 0))
       / greatest(consommation_mw, 1) AS renewable_ratio FROM demand""", rounded=["renewable_ratio"])
def renewable_ratio(spark: Session, sf: str) -> Rows:
    sources = [F.col(c) for c in ("solaire_mw", "eolien_mw", "hydraulique_mw")]
    return inputs.region_demand(spark, sf).select(
        "region_clean", "ts_utc", numeric.renewable_ratio(F.col("consommation_mw"), *sources).alias("renewable_ratio")
    )


@query("""SELECT c_custkey, CASE WHEN c_custkey % 6 <> 5 THEN c_nationkey + 0.5::DOUBLE END AS lat,
          CASE WHEN c_custkey % 6 <> 5 THEN -c_nationkey - 0.25::DOUBLE END AS lon FROM customer""")
def parse_coordinates(spark: Session, sf: str) -> Rows:
    lat, lon = F.format_string("%d.5", "c_nationkey"), F.format_string("-%d.25", "c_nationkey")
    forms = [("%s", '{"lat":', ',"lon":', "}", True), ("%s", '{"latitude":', ',"longitude":', "}", True),
             ("%s", "[", ", ", "]", False), ("%s", "POINT (", " ", ")", False), ("%s", "point(", " ", ")", False)]
    written = F.lit("unknown")
    for i, (_, before, between, after, lat_first) in enumerate(forms):
        first, second = (lat, lon) if lat_first else (lon, lat)
        form = F.concat(F.lit(before), first, F.lit(between), second, F.lit(after))
        written = F.when(F.col("c_custkey") % 6 == i, form).otherwise(written)
    rows = inputs.table(spark, sf, "customer").select("c_custkey", written.alias("coordinates"))
    y, x = numeric.coordinates(F.col("coordinates"))
    return rows.select("c_custkey", y.alias("lat"), x.alias("lon"))


@query("""
WITH walls AS (
  SELECT o_orderkey, o_orderdate + INTERVAL 1 HOUR * (o_orderkey % 24) + INTERVAL 1 MINUTE * (o_custkey % 60) AS wall FROM orders),
instants AS (SELECT *, (wall AT TIME ZONE 'Europe/Paris') AT TIME ZONE 'UTC' AS utc FROM walls),
backs AS (SELECT *, (utc AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Paris' AS back,
                 ((utc + INTERVAL 1 HOUR) AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Paris' AS later,
                 ((utc - INTERVAL 1 HOUR) AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Paris' AS earlier FROM instants),
converted AS (SELECT o_orderkey, CASE WHEN back <> wall THEN date_trunc('hour', utc)
                                      WHEN later = wall OR earlier = wall THEN NULL ELSE utc END AS ts_utc FROM backs)
SELECT o_orderkey, ts_utc, (ts_utc AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Paris' AS ts_local FROM converted""")
def local_to_utc(spark: Session, sf: str) -> Rows:
    rows = inputs.table(spark, sf, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        F.format_string("%02d:%02d", F.col("o_orderkey") % 24, F.col("o_custkey") % 60).alias("heure"),
    )
    utc = clock.local_to_utc(clock.parse_local(F.col("date"), F.col("heure")), overlap="null")
    return rows.select("o_orderkey", utc.alias("ts_utc")).withColumn("ts_local", clock.utc_to_local(F.col("ts_utc")))


@query("SELECT event_id, ts, date_trunc('hour', ts) AS ts_hour FROM events")
def epoch_ns_to_ts(spark: Session, sf: str) -> Rows:
    ns = F.unix_micros("ts") * 1000 + F.col("event_id") % 1000
    rows = inputs.events(spark, sf).select("event_id", clock.epoch_ns_to_timestamp(ns).alias("ts"))
    return rows.withColumn("ts_hour", clock.hour_of(F.col("ts")))


@query("""
SELECT o_orderkey, year(o_orderdate)::INT AS year, month(o_orderdate)::INT AS month, day(o_orderdate)::INT AS day, 0 AS hour,
       (dayofweek(o_orderdate) + 1)::INT AS dow, dayofyear(o_orderdate)::INT AS doy, weekofyear(o_orderdate)::INT AS week,
       quarter(o_orderdate)::INT AS quarter, (dayofweek(o_orderdate) IN (0, 6))::INT AS is_weekend,
       ((dayofweek(o_orderdate) + 6) % 7)::INT AS dow_monday0, isodow(o_orderdate)::INT AS dow_iso,
       strftime(o_orderdate, '%B') AS month_name, strftime(o_orderdate, '%A') AS day_name,
       strftime(o_orderdate, '%Y%m%d%H') AS hour_key FROM orders""")
def calendar_features(spark: Session, sf: str) -> Rows:
    ts = F.col("o_orderdate")
    return inputs.table(spark, sf, "orders").select(
        "o_orderkey", *[c.alias(name) for name, c in clock.calendar_parts(ts).items()],
        clock.dow_from_monday(ts).alias("dow_monday0"), clock.dow_iso(ts).alias("dow_iso"),
        F.date_format(ts, "MMMM").alias("month_name"), F.date_format(ts, "EEEE").alias("day_name"),
        F.date_format(ts, "yyyyMMddHH").alias("hour_key"),
    )


@query(f"""
WITH years AS (SELECT DISTINCT 1600 + c_custkey % 1000 AS y FROM customer), {inputs.SQL_EASTER}
SELECT c_custkey, easter_date::VARCHAR AS easter_date FROM customer JOIN easter ON y = 1600 + c_custkey % 1000""")
def easter_date(spark: Session, sf: str) -> Rows:
    year = (F.lit(1600) + F.col("c_custkey") % 1000).cast("int")
    rows = inputs.table(spark, sf, "customer").select("c_custkey", year.alias("year"))
    return rows.select("c_custkey", clock.easter(F.col("year")).alias("easter_date"))


@query("""
SELECT event_id, v FROM (SELECT event_id, CASE WHEN event_type <> 'error' THEN value / 5 - 10 END AS v FROM events)
WHERE (v IS NULL OR v >= 0) AND (v IS NULL OR v < 60)""", rounded=["v"])
def quality_filter(spark: Session, sf: str) -> Rows:
    v = F.when(F.col("event_type") != "error", F.col("value") / 5 - 10)
    rows = inputs.table(spark, sf, "events").select("event_id", v.alias("v"))
    return panel.quality_filter(panel.quality_filter(rows, "v", low=0), "v", high=60, closed=False)


@query("SELECT c_custkey::VARCHAR AS key, c_mktsegment AS segment, c_nationkey::VARCHAR AS nation, c_acctbal FROM customer")
def split_packed(spark: Session, sf: str) -> Rows:
    packed = F.concat_ws("\t", "c_custkey", "c_mktsegment", "c_nationkey")
    rows = inputs.table(spark, sf, "customer").select(packed.alias("key\tsegment\t nation"), "c_acctbal")
    return shape.split_all_packed(rows)


@query("""SELECT c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment, NULL::VARCHAR AS supplier FROM customer
          UNION ALL SELECT s_nationkey, s_acctbal, NULL, s_name FROM supplier""")
def union_by_name(spark: Session, sf: str) -> Rows:
    customers = inputs.table(spark, sf, "customer").select(
        F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    suppliers = inputs.table(spark, sf, "supplier").select(
        F.col("s_name").alias("supplier"), F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance"))
    return shape.concat_tables(customers, suppliers)


@query("SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def distinct_rows(spark: Session, sf: str) -> Rows:
    return inputs.table(spark, sf, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus").distinct()


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def sorted_topk(spark: Session, sf: str) -> Rows:
    rows = inputs.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return rows.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)
