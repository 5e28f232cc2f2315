import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from isochron.operators import backtest, models, panel
from isochron.operators.backtest import Geometry

START = dt.datetime(2024, 1, 1)
SMALL = Geometry(train=96, step=24, horizons=[1, 6, 24, 30], max_windows=2)


def split_of(spark, series, geometry=SMALL):
    rows = [(k, START + dt.timedelta(hours=h), float(v)) for k, y in series.items() for h, v in enumerate(y)]
    df = spark.createDataFrame(rows, "region_clean string, ts_utc timestamp, consumption_mw double")
    return backtest.split_windows(panel.densify(df, ["region_clean"]), geometry)


def daily(n, scale=10.0):
    return [100 + scale * np.sin(2 * np.pi * h / 24) for h in range(n)]


def frame(df):
    return df.toPandas().sort_values(["region_clean", "window", "lead"], ignore_index=True)


@pytest.mark.parametrize("n, windows", [(125, 0), (126, 1), (149, 1), (150, 2), (1000, 2)])
def test_number_of_windows(spark, n, windows):
    split = split_of(spark, {"a": daily(n)})
    counts = split.groupBy("window", "role").count().collect()
    assert {(r["window"], r["role"], r["count"]) for r in counts} == {
        (w, role, size) for w in range(windows) for role, size in (("train", 96), ("test", 30))}


def test_expanding_windows_start_at_the_first_row(spark):
    geometry = Geometry(train=96, step=24, horizons=[30], max_windows=2, expanding=True)
    counts = split_of(spark, {"a": daily(200)}, geometry).groupBy("window", "role").count().collect()
    assert {(r["window"], r["role"], r["count"]) for r in counts} == {
        (0, "train", 96), (0, "test", 30), (1, "train", 120), (1, "test", 30)}


def test_coverage_drops_windows(spark):
    rows = [("a", START + dt.timedelta(hours=h), 1.0) for h in [0, *range(60, 150)]]
    df = spark.createDataFrame(rows, "region_clean string, ts_utc timestamp, consumption_mw double")
    geometry = Geometry(train=96, step=24, horizons=[30], max_windows=2, min_coverage=0.6)
    split = backtest.split_windows(panel.densify(df, ["region_clean"]), geometry)
    assert {r[0] for r in split.select("window").distinct().collect()} == {1}


def test_short_series_have_no_windows(spark):
    assert split_of(spark, {"a": daily(47), "b": [1.0]}).count() == 0


def test_seasonal_models_are_exact_on_a_periodic_series(spark):
    split = split_of(spark, {"a": daily(150), "b": daily(150, 3)})
    for forecasts in (models.last_value_models(split).where("model = 'baseline_seasonal_naive'"),
                      models.seasonal_difference_model(split), models.seasonal_ar1(split)):
        found = frame(forecasts)
        assert len(found) == 2 * 2 * 30
        np.testing.assert_allclose(found["forecast_mw"], found["actual_mw"], atol=1e-8)


def test_seasonal_difference_equals_its_recursion(spark):
    rng = np.random.default_rng(1)
    y = list(rng.normal(50, 5, 126))
    found = frame(models.seasonal_difference_model(split_of(spark, {"a": y})))
    path = y[:96]
    for _ in range(30):
        path.append(path[-1] + path[-24] - path[-25])
    np.testing.assert_allclose(found["forecast_mw"], path[96:])


def test_closed_form_fits_equal_the_arima_order(spark):
    rng = np.random.default_rng(2)
    split = split_of(spark, {"a": rng.normal(50, 5, 150)})
    closed = frame(models.seasonal_difference_fits(split))
    fitted = frame(models.arima_fits(split, orders=[(0, 1, 0, 0, 1, 0)]))
    np.testing.assert_allclose(closed["fitted"], fitted["fitted"])


def test_arima_recovers_an_autoregression(spark):
    rng = np.random.default_rng(3)
    y = [0.0]
    for _ in range(629):
        y.append(0.8 * y[-1] + rng.normal())
    geometry = Geometry(train=600, step=24, horizons=[30], max_windows=1)
    found = frame(models.arima(split_of(spark, {"a": y}, geometry), orders=[(1, 0, 0, 0, 0, 0)]))
    assert found["fit_ok"].all()
    phi = found["forecast_mw"][1] / found["forecast_mw"][0]
    assert phi == pytest.approx(0.8, abs=0.08)
    np.testing.assert_allclose(found["forecast_mw"], y[599] * phi ** np.arange(1, 31))


def test_arima_falls_back_to_the_moving_average(spark):
    geometry = Geometry(train=40, step=24, horizons=[8], max_windows=1)
    found = frame(models.arima(split_of(spark, {"a": range(48)}, geometry)))
    assert not found["fit_ok"].any() and set(found["forecast_mw"]) == {np.mean(range(16, 40))}


def test_smoothing(spark):
    line = frame(models.smoothing(split_of(spark, {"a": range(150)})))
    np.testing.assert_allclose(line["forecast_mw"], line["actual_mw"], atol=1e-6)
    short = Geometry(train=9, step=24, horizons=[3], max_windows=1)
    few = frame(models.smoothing(split_of(spark, {"a": [1, 2, 3, 4, 5, 6, 7, 8, 9] * 6}, short)))
    assert set(few["forecast_mw"]) == {5.0}


def test_linear_and_knn_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = [("a", START + dt.timedelta(hours=h), float(v), float(a), float(b), 1.0)
            for h, (v, a, b) in enumerate(zip(rng.normal(size=126), rng.normal(size=126), rng.normal(size=126)))]
    df = spark.createDataFrame(rows, "region_clean string, ts_utc timestamp, consumption_mw double, p double, q double, one double")
    split = backtest.split_windows(panel.densify(df, ["region_clean"]), SMALL)
    values = np.array([r[2:] for r in rows])
    x, y = values[:, 1:], values[:, 0]
    weights = np.linalg.lstsq(np.c_[np.ones(96), x[:96, :2]], y[:96], rcond=None)[0]
    linear = frame(models.linear(split, ["p", "q", "one"]))
    np.testing.assert_allclose(linear["forecast_mw"], np.c_[np.ones(30), x[96:, :2]] @ weights)
    near = [y[:96][np.argsort(((x[:96] - row) ** 2).sum(axis=1))[:10]].mean() for row in x[96:]]
    np.testing.assert_allclose(frame(models.knn(split, ["p", "q", "one"]))["forecast_mw"], near)


@pytest.mark.parametrize("model, options", [(models.forest, {"trees": 5, "depth": 6}), (models.boosting, {"trees": 5, "depth": 4})])
def test_trees_learn_the_hour(spark, model, options):
    split = split_of(spark, {"a": daily(150), "b": daily(150, 5)}).withColumn("hour", F.hour("ts_utc"))
    split = panel.add_cyclic(split, hour=24)
    found = frame(model(split, ["hour", "hour_sin", "hour_cos"], **options))
    assert len(found) == 2 * 2 * 30
    assert (found["forecast_mw"] - found["actual_mw"]).abs().mean() < 2.5


def test_hybrid_names_and_falls_back(spark):
    split = split_of(spark, {"a": daily(126), "b": list(range(126))})
    fits = models.arima_fits(split, orders=[(0, 1, 0, 0, 1, 0)]).withColumn("fit_ok", F.col("region_clean") == "a")
    found = frame(models.hybrid(split, fits, lambda part: models.linear_one_feature(part, "idx")))
    assert set(found[found["region_clean"] == "a"]["model"]) == {"SARIMAX_linear"}
    direct = found[found["region_clean"] == "b"]
    assert set(direct["model"]) == {"linear"} and not direct["sarimax_baseline_used"].any()
    np.testing.assert_allclose(direct["forecast_mw"], direct["actual_mw"], atol=1e-6)


def test_scores_and_complete_series(spark):
    split = split_of(spark, {"a": daily(126)})
    results = backtest.score(models.last_value_models(split), SMALL).cache()
    assert results.count() == 3 * sum(SMALL.horizons)
    row = results.where("model = 'baseline_naive' AND horizon = 6 AND lead = 6").first()
    assert row["test_start"] == row["ts_utc"] - dt.timedelta(hours=5) and row["mae"] == row["rmse"] and row["is_baseline"]
    assert row["train_start"] == START and row["train_end"] == START + dt.timedelta(hours=95)
    wide = Geometry(train=96, step=24, horizons=[2], expanding=True)
    later = split_of(spark, {"a": daily(200)}, wide)
    scored = backtest.score(models.last_value_models(later), wide).where("window = 2").select("train_start", "train_end").distinct().collect()
    assert [tuple(r) for r in scored] == [(START, START + dt.timedelta(hours=96 + 48 - 1))]
    actual = split.where("role = 'train'").select("region_clean", "ts_utc", "consumption_mw")
    complete = backtest.complete_series(actual, results)
    long, short = backtest.split_horizons(complete)
    assert complete.where("data_type = 'actual'").count() == 96
    assert long.count() == 24 + 30 and short.count() == 1 + 6
    assert {r[0] for r in long.select("model").distinct().collect()} == {"baseline_seasonal_naive"}


def test_tree_forecasts_do_not_depend_on_shuffle_partitions(spark):
    from pyspark.sql import Row

    rows = [
        Row(region_clean=k, window=0, lead=h - 96, role="train" if h < 96 else "test", ts_utc=None, consumption_mw=float((h * 7 + len(k) * 3) % 24), hour=h % 24)
        for k in ("a", "bb", "ccc") for h in range(120)
    ]
    schema = "region_clean string, window int, lead int, role string, ts_utc timestamp, consumption_mw double, hour int"
    split = spark.createDataFrame(rows, schema)

    def forecasts(partitions):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
        try:
            found = models.forest(split.repartition(partitions), ["hour"], trees=5, depth=4).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
        return {(r["region_clean"], r["lead"]): r["forecast_mw"] for r in found}

    first = forecasts(4)
    assert len(first) == 72 and first == forecasts(4) == forecasts(9)


def test_tree_queries_run_the_whole_models(monkeypatch):
    from pyspark.ml.regression import GBTRegressor, RandomForestRegressor

    from isochron.plans import forecasts

    made = []
    monkeypatch.setattr(forecasts, "_shown", lambda found: found)
    monkeypatch.setattr(models, "shared_folder", lambda _: None)
    monkeypatch.setattr(models, "tree_model", lambda _split, _features, estimator, name: made.append(estimator))
    split = type("Split", (), {"sparkSession": None})()
    monkeypatch.setattr(forecasts, "_split", lambda *_: split)
    forecasts.fc_forest(None, ""), forecasts.fc_gbt(None, "")
    forest, boosting = made
    assert isinstance(forest, RandomForestRegressor) and (forest.getNumTrees(), forest.getMaxDepth()) == (100, 15)
    assert isinstance(boosting, GBTRegressor) and (boosting.getMaxIter(), boosting.getMaxDepth()) == (100, 10)


def test_one_pass_gives_the_rows_of_single_models(spark):
    rng = np.random.default_rng(6)
    split = split_of(spark, {"a": daily(150), "b": rng.normal(50, 5, 150)})
    split = panel.add_cyclic(split.withColumn("hour", F.hour("ts_utc")), hour=24)
    features, orders = ["hour", "hour_sin", "hour_cos"], [(0, 1, 0, 0, 1, 0)]
    direct = models.run_models(split, features, ["linear", "knn"], orders=None)
    chained = models.run_models(split, features, ["linear", "knn"], orders=orders)
    fits = models.arima_fits(split, orders=orders)
    singles = {"linear": models.linear, "knn": models.knn}
    for name, model in singles.items():
        np.testing.assert_allclose(frame(direct.where(F.col("model") == name))["forecast_mw"], frame(model(split, features))["forecast_mw"])
        expected = models.hybrid(split, fits, lambda part, model=model: model(part, features))
        found = frame(chained.where(F.col("model") == f"SARIMAX_{name}"))
        np.testing.assert_allclose(found["forecast_mw"], frame(expected)["forecast_mw"])
        assert found["sarimax_baseline_used"].all()
    chain = frame(chained.where("model = 'SARIMAX'"))
    np.testing.assert_allclose(chain["forecast_mw"], frame(models.arima(split, orders=orders))["forecast_mw"])
    assert chained._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(region_clean#") == direct._jdf.queryExecution(
        ).executedPlan().toString().count("Exchange hashpartitioning(region_clean#")


def test_one_pass_without_an_order_that_fits(spark):
    short = Geometry(train=40, step=24, horizons=[8], max_windows=1)
    found = frame(models.run_models(split_of(spark, {"a": range(48)}, short), ["idx"], ["linear"]))
    assert set(found["model"]) == {"SARIMAX", "linear"} and not found["sarimax_baseline_used"].any()
    np.testing.assert_allclose(found[found["model"] == "linear"]["forecast_mw"], range(40, 48))


def test_results_hold_every_model(spark, small_dir, monkeypatch):
    import inspect
    from functools import partial

    from isochron.plans import QUERIES, pipeline

    assert set(inspect.signature(pipeline.build_analytics).parameters["names"].default) == set(models.REGISTRY)
    for name in ("random_forest", "gradient_boosting"):
        monkeypatch.setitem(models.REGISTRY, name, partial(models.REGISTRY[name], trees=2, depth=2))
    found = QUERIES["forecast_results_all"](spark, small_dir).groupBy("model").count().collect()
    counts = {r["model"]: r["count"] for r in found}
    baselines = {"naive", "seasonal_naive", "moving_average", "exponential_smoothing"}
    assert {m.removeprefix("SARIMAX_") for m in counts} == {f"baseline_{b}" for b in baselines} | {"SARIMAX"} | set(models.REGISTRY)
    total = counts["baseline_naive"]
    assert all(counts[f"baseline_{b}"] == total for b in baselines) and counts["SARIMAX"] == total
    assert all(counts.get(m, 0) + counts.get(f"SARIMAX_{m}", 0) == total for m in models.REGISTRY)
