"""Registered queries: whole tables written by each sink and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isochron.plans import inputs
from isochron.plans.registry import query
from isochron.session import fresh_path
from isochron.sources import delimited, tables


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def write_partitioned_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Orders partitioned by status, written twice: the second run replaces the first."""
    rows = inputs.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    target = fresh_path(spark, "orders-by-status")
    for _ in range(2):
        tables.write_partitioned(rows, target, by="o_orderstatus")
    return tables.scan(spark, target, rows.schema)


@query("""
SELECT c_custkey, c_name, c_acctbal, run_ts FROM customer, (VALUES ('run 1'), ('run 2')) r(run_ts)""")
def append_run_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Customers appended by two runs, the first of which is repeated."""
    rows = inputs.table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    target = fresh_path(spark, "customer-runs")
    for run in ("run 1", "run 2", "run 1"):
        tables.append_run(rows, target, run)
    return spark.read.schema("c_custkey bigint, c_name string, c_acctbal double, run_ts string").parquet(target)


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def catalog_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers entered in the catalog and read by name."""
    name = f"suppliers_{uuid.uuid4().hex}"
    tables.write_table(inputs.table(spark, sf, "supplier"), fresh_path(spark, "suppliers"), name)
    return tables.catalog_table(spark, name)


@query("SELECT o_orderkey, o_orderdate - INTERVAL 600 YEAR AS placed FROM orders")
def legacy_calendar_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Order times six hundred years back, written in the hybrid calendar of old writers and rebased by the scan."""
    earlier = (F.col("o_orderdate") + F.expr("INTERVAL '-600' YEAR")).cast("timestamp").alias("placed")
    target, key = fresh_path(spark, "old-orders"), "spark.sql.parquet.datetimeRebaseModeInWrite"
    before = spark.conf.get(key)
    spark.conf.set(key, "LEGACY")
    try:
        inputs.table(spark, sf, "orders").select("o_orderkey", earlier).write.parquet(target)
    finally:
        spark.conf.set(key, before)
    return tables.scan(spark, target, "o_orderkey bigint, placed timestamp", legacy_calendar=True)


@query("SELECT least(100, count(*))::BIGINT AS n_rows, 6::BIGINT AS n_columns FROM part")
def sample_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The sample sink: a hundred parts as CSV with a header; which rows is open, so their number and width are returned."""
    target = fresh_path(spark, "part-sample")
    tables.write_sample(inputs.table(spark, sf, "part"), target)
    sample = spark.read.option("header", True).csv(target)
    return sample.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(sample.columns)).cast("long"))


@query("""
SELECT ['Bretagne', 'Corse', 'Normandie'][c_nationkey % 3 + 1] AS region, c_custkey::VARCHAR AS number, c_name || ' é;"' AS perimetre,
       c_acctbal AS consommation_mw, CASE WHEN c_nationkey % 3 < 2 THEN c_mktsegment END AS segment,
       CASE WHEN c_nationkey % 3 = 2 THEN c_nationkey::DOUBLE END AS solaire_mw,
       ['Bretagne_encours_mensuel.zip', 'Corse_encours_mensuel.zip', 'Normandie.xls'][c_nationkey % 3 + 1] AS zip_name, true AS has_member
FROM customer""", rounded=["consommation_mw", "solaire_mw"])
def delimited_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Customers written in three dialects and read as one table: semicolons in UTF-8, tabs in Latin-1 under other spellings of the headers, and
    quoted lines whose whole header sits in one cell. Folders carry the archives' names; cells hold separators, quotes and decimal commas."""
    customers = inputs.table(spark, sf, "customer")
    number, name = F.col("c_custkey").cast("string"), F.concat("c_name", F.lit(' é;"'))
    balance, kind = F.translate(F.col("c_acctbal").cast("string"), ".", ","), F.col("c_nationkey") % 3
    target = fresh_path(spark, "customer-files")

    def write(rows: DataFrame, folder: str, **options) -> None:
        rows.write.options(header=True, escape='"', **options).csv(f"{target}/{folder}")

    write(
        customers.where(kind == 0).select(number.alias("Date"), name.alias("Périmètre"), balance.alias(" Consommation "), F.col("c_mktsegment").alias("Segment")),
        "Bretagne_encours_mensuel.zip", sep=";",
    )
    write(
        customers.where(kind == 1).select(F.col("c_mktsegment").alias("Segment"), balance.alias("Consommation"), name.alias("Périmètre géographique"), number.alias("Date")),
        "Corse_encours_mensuel.zip", sep="\t", encoding="ISO-8859-1",
    )
    packed = F.concat_ws("\t", number, name, balance, F.col("c_nationkey").cast("string"))
    write(customers.where(kind == 2).select(packed.alias("Date\tPérimetre\tConsommation\tSolaire")), "Normandie.xls", sep=";", quoteAll=True)
    found = delimited.demand_table(spark, f"{target}/*", archives=True)
    return found.select(
        "region", F.col("date").alias("number"), "perimetre", "consommation_mw", F.element_at("other", F.lit("Segment")).alias("segment"), "solaire_mw", "zip_name",
        F.startswith("zip_member", F.lit("part-")).alias("has_member"),
    )
