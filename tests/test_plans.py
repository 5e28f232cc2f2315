"""The shape of physical plans, and the jobs from raw rows to views."""

import pytest
from pyspark.sql import functions as F

from isochron.operators.backtest import Geometry
from isochron.plans import QUERIES, inputs, pipeline, series

PYTHON_ONLY_IN = {
    "fc_linear", "fc_knn", "fc_sar", "fc_sar_closed", "fc_hybrid_models", "fc_hybrid_closed", "fc_series_stumps", "fc_series_trees", "fc_forest", "fc_gbt",
}
# Products of category labels and of day ranges, bounded by the labels and the calendar.
SLOW = {"fc_forest", "fc_gbt", "stream_upsert", "stream_hourly_agg", "incremental_scan"}
# Queries that read back what they wrote.
SLOW |= {name for name in QUERIES if name.endswith("_roundtrip")}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_plan_has_no_product_and_no_row_udf(spark, small_dir, name):
    plan = plan_of(QUERIES[name](spark, small_dir))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan
    if name not in PYTHON_ONLY_IN:
        assert "FlatMapGroupsInPandas" not in plan and "ArrowEvalPython" not in plan


def test_filters_and_columns_reach_the_scan(spark, small_dir):
    plan = plan_of(QUERIES["scan_filtered"](spark, small_dir))
    assert "GreaterThan(value,100.0)" in plan and "ReadSchema: struct<event_id:bigint,event_type:string,value:double>" in plan
    spine = plan_of(QUERIES["calendar_spine"](spark, small_dir))
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz,o_orderpriority:string>" in spine


def test_smoothing_folds_where_values_are_gathered(spark, small_dir):
    plan = plan_of(QUERIES["fc_holt"](spark, small_dir))
    assert "Generate explode(array" not in plan and "Expand" not in plan


def test_hourly_mean_combines_before_the_shuffle(spark, small_dir):
    plan = plan_of(QUERIES["hourly_agg"](spark, small_dir))
    assert plan.count("Exchange") == 1 and "partial_avg" in plan


def test_ranking_is_cut_before_the_shuffle(spark, small_dir):
    assert "WindowGroupLimit" in plan_of(QUERIES["safe_merge"](spark, small_dir))


def test_pipeline_end_to_end(spark, small_dir, tmp_path):
    base = str(tmp_path)
    demand = series._raw_demand(spark, small_dir)
    readings = inputs.readings(spark, small_dir).drop("user_id", "event_id")
    pipeline.build_silver(base, demand, readings, inputs.city_rows(spark, small_dir), inputs.january_holidays(spark, small_dir))
    pipeline.build_gold(spark, base)
    # Demand is positive in all filled hours of a region, so regions of a full month have windows.
    geometry = Geometry(train=240, step=168, horizons=[1, 24])
    pipeline.build_analytics(spark, base, geometry, names=["linear"])
    views = pipeline.open_views(spark, base)
    assert len(views) == 5
    for view in views:
        assert spark.table(view).count() > 0
    fact = spark.read.parquet(f"{base}/fact_electricity_hourly")
    assert fact.where(F.col("consumption_mw") <= 0).count() == 0
    assert fact.groupBy("ts_utc", "region_clean").count().where("count > 1").count() == 0
    results = spark.read.parquet(f"{base}/forecast_results")
    models = {r[0] for r in results.select("model").distinct().collect()}
    assert {"baseline_naive", "baseline_exponential_smoothing"} < models and models & {"SARIMAX_linear", "linear"}
    before = fact.count()
    pipeline.build_gold(spark, base)
    assert spark.read.parquet(f"{base}/fact_electricity_hourly").count() == before
