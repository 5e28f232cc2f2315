"""Registered queries: region names, cities, the region map, de-duplication and merges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isochron.fixed_values import EXTRA_SPELLINGS, FORCED_LABEL, OVERSEAS, REGION_ALIASES, REGIONS
from isochron.functions.regions import LABEL_OF, LABELS
from isochron.operators import merge, regions
from isochron.plans import inputs
from isochron.plans.basics import SQL_CANON, SQL_CITY_NORM, SQL_SQUEEZE
from isochron.plans.registry import query
from isochron.sources import records

SQL_MAP = f"""
{inputs.SQL_REGIONS},
aliases(alias, target) AS (VALUES {inputs.sql_rows(REGION_ALIASES)}),
named AS (SELECT *, CASE WHEN lower(region) = 'nan' THEN '' ELSE {SQL_CANON.format("region")} END AS name FROM raw_names),
mapped AS (
  SELECT n.*, CASE WHEN name IN ({", ".join(map(inputs.sql_text, OVERSEAS))}) THEN NULL
                   WHEN a.target IS NOT NULL THEN a.target
                   WHEN name LIKE '%rhone alpe%' THEN 'auvergne rhone alpes' ELSE name END AS region_canon,
         CASE WHEN name IN ('paca', 'provence alpes cote d azur') THEN {inputs.sql_text(FORCED_LABEL)} ELSE region END AS region_clean
  FROM named n LEFT JOIN aliases a ON a.alias = n.name)"""


def _customer_names(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.table(spark, sf, "customer").select(
        "c_custkey", inputs.pick(inputs.SPELLINGS, F.col("c_custkey")).alias("region")
    )


SQL_CUSTOMER_NAMES = f"raw_names AS (SELECT c_custkey, {inputs.sql_pick(inputs.SPELLINGS, 'c_custkey')} AS region FROM customer)"


@query(f"""
WITH {SQL_CUSTOMER_NAMES}, {SQL_MAP}
SELECT c_custkey, region, region_canon, region_clean FROM mapped WHERE region_canon IN (SELECT canon FROM regions)""")
def map_region(spark: SparkSession, sf: str) -> DataFrame:
    rows = _customer_names(spark, sf)
    names = regions.by_name(rows, "region", lambda n: regions.only_regions(regions.add_regions(n)))
    return rows.join(names, "region").select("c_custkey", "region", "region_canon", "region_clean")


_SPELLED = REGION_ALIASES + EXTRA_SPELLINGS
_KNOWN = {name for name, _ in _SPELLED}
_STANDARD = [(name, LABEL_OF[canon]) for name, canon in _SPELLED] + [
    (canon, label) for canon, label, *_ in REGIONS if canon not in _KNOWN
]
SQL_LOOSE = SQL_SQUEEZE.format("replace(replace(replace(replace(lower({0}), '-', ' '), '''', ' '), 'é', 'e'), 'ô', 'o')")
SQL_HARMONIZED = f"""
spellings(priority, spelling, label) AS (VALUES {inputs.sql_rows([(i, *row) for i, row in enumerate(_STANDARD)])}),
labels(place, label) AS (VALUES {inputs.sql_rows(list(enumerate(LABELS)))}),
names AS (SELECT DISTINCT region FROM raw_names),
canonical AS (SELECT region, CASE WHEN lower(region) = 'nan' THEN '' ELSE {SQL_CANON.format("region")} END AS name FROM names),
exact AS (SELECT region, min_by(label, priority) AS label FROM canonical JOIN spellings ON spelling = name GROUP BY 1),
partly AS (SELECT region, min_by(label, priority) AS label FROM canonical
           JOIN spellings ON name <> '' AND (contains(name, spelling) OR contains(spelling, name)) GROUP BY 1),
first_pass AS (SELECT c.region, coalesce(e.label, p.label, nullif(c.region, '')) AS label
               FROM canonical c LEFT JOIN exact e USING (region) LEFT JOIN partly p USING (region)),
loose AS (SELECT region, label, {SQL_LOOSE.format("label")} AS l FROM first_pass),
targets AS (SELECT place, label AS target, {SQL_LOOSE.format("label")} AS t FROM labels),
second AS (SELECT region, min_by(target, place) AS target FROM loose
           JOIN targets ON l <> '' AND (contains(l, t) OR contains(t, l) OR replace(l, ' ', '') = replace(t, ' ', '')) GROUP BY 1),
harmonized AS (SELECT l.region, CASE WHEN l.label IN (SELECT label FROM labels) THEN l.label ELSE coalesce(s.target, nullif(l.label, '')) END AS region_clean
               FROM loose l LEFT JOIN second s USING (region))"""


@query(f"""
WITH {SQL_CUSTOMER_NAMES}, {SQL_HARMONIZED}
SELECT c_custkey, region, region_clean FROM raw_names JOIN harmonized USING (region)""")
def harmonize_region(spark: SparkSession, sf: str) -> DataFrame:
    rows = _customer_names(spark, sf)
    names = regions.by_name(rows, "region", lambda n: regions.harmonize(n.withColumn("region_clean", F.col("region"))))
    return rows.join(names, "region").select("c_custkey", "region", "region_clean")


@query(f"""
WITH raw_names AS (
  SELECT {inputs.sql_pick(inputs.SPELLINGS, 'c_custkey')} AS region FROM customer
  UNION ALL SELECT {inputs.sql_pick(inputs.SPELLINGS, '(s_suppkey * 2 + 1)')} FROM supplier
  UNION ALL SELECT n_name FROM nation), {SQL_HARMONIZED}
SELECT DISTINCT region_clean FROM raw_names JOIN harmonized USING (region)
WHERE region_clean NOT IN (SELECT label FROM labels)""")
def nonstandard_names(spark: SparkSession, sf: str) -> DataFrame:
    customers = _customer_names(spark, sf).withColumnRenamed("region", "region_clean")
    suppliers = inputs.table(spark, sf, "supplier").select(
        inputs.pick(inputs.SPELLINGS, F.col("s_suppkey") * 2 + 1).alias("region_clean")
    )
    nations = inputs.table(spark, sf, "nation").select(F.col("n_name").alias("region_clean"))
    return regions.nonstandard_names(*[regions.by_name(t, "region_clean", regions.harmonize) for t in (customers, suppliers, nations)])


SQL_CITY_MAP = f"""
raw_names AS (
  SELECT DISTINCT {inputs.sql_pick(inputs.SPELLINGS, "user_id")} AS region, {inputs.SQL_CITY} AS city_raw FROM events), {SQL_MAP},
mapping AS (
  SELECT {SQL_CITY_NORM.format("city_raw")} AS city_norm, city_raw, region_clean, region_canon, cap_lat, cap_lon
  FROM mapped JOIN regions ON canon = region_canon),
lookup AS (SELECT city_norm, min({{'c': region_clean, 'd': region_canon}}) AS r FROM mapping GROUP BY 1)"""


@query(f"WITH {SQL_CITY_MAP} SELECT * FROM mapping")
def region_mapping(spark: SparkSession, sf: str) -> DataFrame:
    return regions.region_mapping(inputs.city_rows(spark, sf))


@query(f"""WITH {SQL_CITY_MAP}
SELECT region_clean, region_canon, count(*) AS city_count, max(cap_lat) AS cap_lat, max(cap_lon) AS cap_lon
FROM mapping GROUP BY 1, 2""")
def region_summary(spark: SparkSession, sf: str) -> DataFrame:
    return regions.region_summary(regions.region_mapping(inputs.city_rows(spark, sf)))


@query(f"""
WITH {SQL_CITY_MAP}, {inputs.SQL_READINGS}
SELECT event_id, city_name, r.c AS region_clean, r.d AS region_canon
FROM (SELECT event_id, {inputs.SQL_CITY} AS city_name FROM events) e
JOIN lookup ON city_norm = {SQL_CITY_NORM.format("city_name")}""")
def city_region_join(spark: SparkSession, sf: str) -> DataFrame:
    mapping = regions.region_mapping(inputs.city_rows(spark, sf))
    rows = inputs.readings(spark, sf).select("event_id", "city_name")
    joined = regions.attach_regions(rows, mapping)
    return joined.where(F.col("region_clean").isNotNull()).drop("city_norm")


@query(f"""
WITH {SQL_CITY_MAP}, {inputs.SQL_READINGS}
SELECT city_name, {SQL_CITY_NORM.format("city_name")} AS city_norm, count(*) AS readings FROM readings
WHERE {SQL_CITY_NORM.format("city_name")} NOT IN (SELECT city_norm FROM mapping) GROUP BY 1, 2""")
def unmapped_entities(spark: SparkSession, sf: str) -> DataFrame:
    mapping = regions.region_mapping(inputs.city_rows(spark, sf))
    return regions.unmapped(inputs.readings(spark, sf), mapping)


@query("""
SELECT geoname_id, name, country_code, timezone, population, lat, lon FROM (
  SELECT c_nationkey::VARCHAR AS geoname_id, c_name AS name, 'fr' AS country_code, c_mktsegment AS timezone,
         floor(c_acctbal) AS population, c_custkey + 0.5::DOUBLE AS lat, -c_custkey - 0.5::DOUBLE AS lon,
         row_number() OVER (PARTITION BY c_nationkey ORDER BY floor(c_acctbal) DESC, c_name) AS place
  FROM customer WHERE c_custkey % 7 <> 0 AND c_mktsegment <> 'BUILDING') WHERE place = 1""")
def entity_dedup(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey")
    point = F.concat(F.lit("POINT (-"), key.cast("string"), F.lit(".5 "), key.cast("string"), F.lit(".5)"))
    cities = inputs.table(spark, sf, "customer").select(
        F.col("c_nationkey").cast("string").alias("geoname_id"), F.col("c_name").alias("name"),
        F.when(F.col("c_mktsegment") == "BUILDING", "de").otherwise("fr").alias("country_code"),
        F.col("c_mktsegment").alias("timezone"), F.floor("c_acctbal").alias("population"),
        F.when(key % 7 != 0, point).alias("coordinates"),
    )
    return records.city_records(cities)


@query("""
SELECT o.o_orderkey, o_orderstatus, l_partkey, l_suppkey, l_quantity FROM orders o LEFT JOIN (
  SELECT * FROM lineitem QUALIFY row_number() OVER (
    PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) = 1) ON l_orderkey = o.o_orderkey""")
def safe_merge(spark: SparkSession, sf: str) -> DataFrame:
    """By the first key set both sides have: (order, customer) is not in the lines, the order is."""
    orders = inputs.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    lines = inputs.table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    merged = merge.merge_first_match(
        orders, lines, [["o_orderkey", "o_custkey"], ["o_orderkey"]],
        ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity"],
    )
    return merged.drop("o_custkey", "l_linenumber")


@query("""
WITH l AS (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1), r AS (SELECT c_nationkey AS k, count(*) AS n FROM customer GROUP BY 1)
SELECT sum(l.n)::BIGINT AS left_rows, sum(l.n - 1)::BIGINT AS left_duplicates,
       (SELECT sum(n - 1) FROM r)::BIGINT AS right_duplicates, sum(l.n * coalesce(r.n, 1))::BIGINT AS joined_rows,
       sum(l.n * coalesce(r.n, 1)) > sum(l.n) * 1.5 AS multiplies
FROM l LEFT JOIN r USING (k)""")
def merge_check(spark: SparkSession, sf: str) -> DataFrame:
    orders = inputs.table(spark, sf, "orders").select(F.col("o_custkey").alias("k"))
    customers = inputs.table(spark, sf, "customer").select(F.col("c_nationkey").cast("bigint").alias("k"))
    return merge.merge_metrics(orders, customers, ["k"])


@query("""
SELECT 'time_id' AS way, o_orderkey AS key, o_orderdate AS ts_utc FROM orders
UNION ALL SELECT 'renamed', event_id, ts FROM events
UNION ALL SELECT 'parts', l_orderkey * 10 + l_linenumber, make_timestamp(year(l_shipdate), month(l_shipdate), day(l_shipdate), l_linenumber, 0, 0.0) FROM lineitem
UNION ALL SELECT 'counted', c_custkey, TIMESTAMP '2020-01-01' + INTERVAL 1 HOUR * (row_number() OVER (ORDER BY c_custkey) - 1) FROM customer""")
def ensure_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    orders = inputs.table(spark, sf, "orders")
    day = F.date_format("o_orderdate", "yyyyMMdd").alias("time_id")
    times = orders.select(day, F.col("o_orderdate").cast("timestamp").alias("ts_utc")).distinct()
    lines, ship = inputs.table(spark, sf, "lineitem"), F.col("l_shipdate")
    ways = {
        "time_id": orders.select(F.col("o_orderkey").alias("key"), day),
        "renamed": inputs.events(spark, sf).select(F.col("event_id").alias("key"), F.col("ts").alias("timestamp")),
        "parts": lines.select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("key"), F.year(ship).alias("year"),
            F.month(ship).alias("month"), F.dayofmonth(ship).alias("day"), F.col("l_linenumber").alias("hour"),
        ),
        "counted": inputs.table(spark, sf, "customer").select(F.col("c_custkey").alias("key")),
    }
    found = [
        merge.ensure_timestamp(df, times).select(F.lit(way).alias("way"), "key", "ts_utc") for way, df in ways.items()
    ]
    out = found[0]
    for other in found[1:]:
        out = out.unionByName(other)
    return out


SQL_LOCAL = "(o_orderdate + INTERVAL 1 HOUR * (CASE WHEN o_orderkey % 24 = 2 THEN 3 ELSE o_orderkey % 24 END))"


@query(f"""
WITH clocks AS (SELECT *, {SQL_LOCAL} AS wall, o_orderkey % 5 AS way FROM orders),
chosen AS (
  SELECT 'demand' AS side, o_orderkey, CASE way WHEN 0 THEN o_orderdate WHEN 1 THEN o_orderdate + INTERVAL 1 DAY
           WHEN 2 THEN (wall AT TIME ZONE 'Europe/Paris') AT TIME ZONE 'UTC' WHEN 3 THEN o_orderdate + INTERVAL 2 DAY ELSE NULL END AS ts_utc,
         CASE WHEN way = 2 THEN wall END AS given FROM clocks
  UNION ALL SELECT 'weather', o_orderkey, CASE WHEN way = 4 THEN TIMESTAMP '2000-01-01' ELSE o_orderdate END, NULL FROM clocks)
SELECT side, o_orderkey, ts_utc, coalesce(given, (ts_utc AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Paris') AS ts_paris FROM chosen""")
def ensure_timestamp_gold(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that know their time in different ways, mixed in one table: an hour in UTC, a time in UTC, a local time, a text, or none; and a
    table with a clock in nanoseconds only."""
    orders, way = inputs.table(spark, sf, "orders"), F.col("o_orderkey") % 5
    placed = F.col("o_orderdate").cast("timestamp")
    hour = F.when(F.col("o_orderkey") % 24 == 2, 3).otherwise(F.col("o_orderkey") % 24)
    later = lambda days: placed + F.expr(f"INTERVAL '{days}' DAY")
    demand = orders.select(
        F.lit("demand").alias("side"), "o_orderkey", F.when(way == 0, placed).alias("ts_hour_utc"),
        F.when(way <= 1, later(1)).alias("ts_utc"), F.when(way == 2, F.timestamp_add("HOUR", hour.cast("int"), placed)).alias("ts_paris"),
        F.when(way == 4, "no date").when(way == 3, F.date_format(later(2), "yyyy-MM-dd HH:mm:ss")).alias("update_date"),
    )
    weather = orders.select(F.lit("weather").alias("side"), "o_orderkey", F.when(way != 4, F.unix_micros(placed) * 1000).alias("date"))
    columns = ["side", "o_orderkey", "ts_utc", "ts_paris"]
    found = merge.recover_timestamps(weather, stamp=F.lit("2000-01-01").cast("timestamp")).select(*columns)
    return merge.recover_timestamps(demand).select(*columns).unionByName(found)
