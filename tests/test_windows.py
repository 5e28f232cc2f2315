"""Window statistics from running sums, and least squares from moments, against numpy."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from isochron.operators import backtest, models, panel, windows
from isochron.operators.backtest import Geometry

START = dt.datetime(2024, 1, 1)


def panel_of(spark, lengths, columns=("p", "q"), seed=1):
    rng = np.random.default_rng(seed)
    rows = [(k, START + dt.timedelta(hours=h), *map(float, rng.normal(50, 5, 1 + len(columns)))) for k, n in lengths.items() for h in range(n)]
    schema = "region_clean string, ts_utc timestamp, consumption_mw double, " + ", ".join(f"{c} double" for c in columns)
    return panel.densify(spark.createDataFrame(rows, schema), ["region_clean"])


GEOMETRIES = [
    Geometry(train=96, step=24, horizons=[1, 30]), Geometry(train=96, step=96, horizons=[6]), Geometry(train=60, step=7, horizons=[80], max_windows=3),
    Geometry(train=96, step=24, horizons=[30], expanding=True),
]


@pytest.mark.parametrize("geometry", GEOMETRIES)
@pytest.mark.parametrize("slice_rows", [8192, 50])
def test_sums_and_tests_are_those_of_split_windows(spark, monkeypatch, geometry, slice_rows):
    monkeypatch.setattr(panel, "SLICE", slice_rows)
    monkeypatch.setattr(windows, "SLICE", slice_rows)
    dense = panel_of(spark, {"a": 400, "b": 126, "c": 20}).cache()
    split = backtest.split_windows(dense, geometry)
    values = {"one": F.lit(1), "y": F.col("consumption_mw"), "yp": F.col("consumption_mw") * F.col("p"), "none": F.lit(None).cast("double")}
    sums = windows.running_sums(dense, values).cache()

    def rows(df, *names):
        return {(r["region_clean"], r["window"]): [r[n] for n in names] for r in df.collect()}

    for span in (None, 24):
        if geometry.expanding and span:
            continue
        train = split.where("role = 'train'").where(F.col("lead") > -span if span else F.lit(True))
        expected = rows(train.groupBy("region_clean", "window").agg(
            F.count("*").alias("one"), F.sum("consumption_mw").alias("y"), F.sum(F.col("consumption_mw") * F.col("p")).alias("yp")), "one", "y", "yp")
        found = rows(windows.window_sums(sums, geometry, list(values), span), "one", "y", "yp", "none")
        assert found.keys() == expected.keys() and len(found) > 1
        assert all(found[k] == pytest.approx([*expected[k], 0.0]) for k in found)
    place = ["region_clean", "window", "lead", "ts_utc"]
    tests = split.where("role = 'test'").select(*place)
    found = windows.test_rows(dense, geometry).select(*place)
    assert found.exceptAll(tests).count() == 0 and tests.exceptAll(found).count() == 0


def test_window_sums_copy_no_row(spark, tmp_path):
    geometry = GEOMETRIES[0]
    windows.running_sums(panel_of(spark, {"a": 200}), {"y": F.col("consumption_mw")}).write.parquet(str(tmp_path / "sums"))
    plan = windows.window_sums(spark.read.parquet(str(tmp_path / "sums")), geometry, ["y"])._jdf.queryExecution().toString()
    assert "Generate" not in plan and "explode" not in plan


def frame(df):
    return df.toPandas().sort_values(["region_clean", "window", "lead"], ignore_index=True)["forecast_mw"].to_numpy()


@pytest.mark.parametrize("features", [[], ["p"], ["p", "q"], ["p", "q", "both", "one", "r"]])
def test_least_squares_equals_numpy(spark, features):
    geometry = GEOMETRIES[0]
    dense = panel_of(spark, {"a": 300, "b": 200}, ("p", "q", "r")).withColumns({"both": F.col("p") + 2 * F.col("q"), "one": F.lit(1.0)}).cache()
    split = backtest.split_windows(dense, geometry)
    expected = frame(models.linear(split, features)) if features else frame(split.where("role = 'test'").join(
        split.where("role = 'train'").groupBy("region_clean", "window").agg(F.avg("consumption_mw").alias("forecast_mw")), ["region_clean", "window"]))
    np.testing.assert_allclose(frame(windows.least_squares(split, features)), expected, rtol=1e-8)
    sums = windows.running_sums(dense, windows.moments(features)).cache()
    np.testing.assert_allclose(frame(windows.least_squares_by_sums(sums, dense, geometry, features)), expected, rtol=1e-7)


def test_no_python_in_least_squares(spark):
    plan = windows.least_squares(backtest.split_windows(panel_of(spark, {"a": 200}), GEOMETRIES[0]), ["p", "q"])._jdf.queryExecution().toString()
    assert "Pandas" not in plan and "Arrow" not in plan and "Python" not in plan


def test_refined_smoothing_is_no_worse_than_the_grid(spark):
    split = backtest.split_windows(panel_of(spark, {"a": 130}), GEOMETRIES[0])
    y = [r[0] for r in split.where("role = 'train' AND window = 0").orderBy("lead").select("consumption_mw").collect()]

    def error(alpha, beta):
        level, trend, total = y[0], y[1] - y[0], 0.0
        for value in y[1:]:
            miss = value - level - trend
            level, trend, total = level + trend + alpha * miss, trend + beta * alpha * miss, total + miss * miss
        return total, level, trend

    grid = min((error(a / 10, b / 10)[0], a / 10, b / 10) for a in range(1, 10) for b in range(10))
    best = grid
    for step in models.refining_steps(6):
        near = [(min(max(best[1] + a * step, 0.0001), 1.0), min(max(best[2] + b * step, 0.0), 1.0)) for a in (-1, 0, 1) for b in (-1, 0, 1)]
        best = min((error(a, b)[0], a, b) for a, b in near)
    assert best[0] < grid[0] and models.refining_steps(6)[-1] < 2e-4
    _, level, trend = error(*best[1:])
    found = frame(models.smoothing(split, rounds=6).where("window = 0"))
    np.testing.assert_allclose(found, [level + trend * k for k in range(1, 31)], rtol=1e-9)
