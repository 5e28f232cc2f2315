import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from isochron.operators import panel, reports

KEY = ["region_clean"]
START = dt.datetime(2024, 1, 1)


def make_panel(spark, series):
    """series: name -> {hour: value}."""
    rows = [(k, START + dt.timedelta(hours=h), v) for k, values in series.items() for h, v in values.items()]
    return spark.createDataFrame(rows, "region_clean string, ts_utc timestamp, consumption_mw double")


def gappy(seed, hours=90):
    """Values with single gaps, a gap of thirty hours, and null measures, also at the start."""
    rng = np.random.default_rng(seed)
    values = {h: float(np.round(rng.normal(50, 9), 2)) for h in range(hours) if rng.random() > 0.2 and not 40 <= h < 70}
    for h in list(values)[:3] + list(values)[20:22]:
        values[h] = None
    values[hours] = 7.0
    return values


def dense_frame(series):
    frames = []
    for name, values in series.items():
        y = pd.Series(values, dtype=float).sort_index()
        frames.append(pd.DataFrame({"region_clean": name, "h": range(y.index[0], y.index[-1] + 1)}).assign(
            y=lambda d, y=y: d["h"].map(y)))
    return frames


@pytest.fixture(autouse=True)
def short_slices(monkeypatch):
    """Slices much shorter than the series, so that every carry across slices is exercised."""
    monkeypatch.setattr(panel, "SLICE", 26)


def test_densify_has_no_gaps(spark):
    series = {"a": gappy(1), "b": {5: 1.0}, "c": {0: 1.0, 100: 2.0}}
    dense = panel.densify(make_panel(spark, series), KEY).toPandas().sort_values(["region_clean", "idx"])
    for name, values in series.items():
        part = dense[dense["region_clean"] == name]
        length = max(values) - min(values) + 1
        assert list(part["idx"]) == list(range(length)) and set(part["n_rows"]) == {length}
        assert list(part["observed"]) == [h in values for h in range(min(values), max(values) + 1)]


def test_history_equals_pandas(spark):
    series = {"a": gappy(2), "b": gappy(3)}
    columns = panel.lag_columns("consumption_mw", [1, 24], "lag") | panel.rolling_columns("consumption_mw", [3, 24], "mean")
    dense = panel.densify(make_panel(spark, series), KEY)
    found = panel.with_history(dense, KEY, 25, columns).toPandas().sort_values(["region_clean", "idx"], ignore_index=True)
    assert len(found) == sum(max(v) - min(v) + 1 for v in series.values())
    for name, frame in zip(series, dense_frame(series)):
        part = found[found["region_clean"] == name].reset_index(drop=True)
        np.testing.assert_allclose(part["lag24"].astype(float), frame["y"].shift(24))
        np.testing.assert_allclose(part["mean3"].astype(float), frame["y"].rolling(3, min_periods=1).mean(), atol=1e-9)
        np.testing.assert_allclose(part["mean24"].astype(float), frame["y"].rolling(24, min_periods=1).mean(), atol=1e-9)


def test_history_beyond_the_slice(spark, monkeypatch):
    monkeypatch.setattr(panel, "SLICE", 16)
    dense = panel.densify(make_panel(spark, {"a": {h: float(h) for h in range(100)}}), KEY)
    found = panel.with_history(dense, KEY, 40, panel.lag_columns("consumption_mw", [40], "lag")).toPandas().sort_values("idx")
    np.testing.assert_allclose(found["lag40"].astype(float), [np.nan] * 40 + list(range(60)))


@pytest.mark.parametrize("exclude", [False, True])
def test_features_equal_forward_then_backward_fill(spark, exclude):
    series = {"a": gappy(4), "b": gappy(5, 60), "d": {0: None, 1: None}}
    dense = panel.densify(make_panel(spark, series), KEY)
    found = panel.model_features(dense, KEY, lags=[1, 24], spans=[3, 24], exclude_current=exclude)
    found = found.toPandas().sort_values(["region_clean", "idx"], ignore_index=True)
    for name, frame in zip(series, dense_frame(series)):
        part = found[found["region_clean"] == name].reset_index(drop=True)
        past = frame["y"].shift(1) if exclude else frame["y"]
        expected = {"consumption_mw": frame["y"], "consumption_lag_1": frame["y"].shift(1), "consumption_lag_24": frame["y"].shift(24),
                    "consumption_rolling_mean_3": past.rolling(3, min_periods=1).mean(),
                    "consumption_rolling_mean_24": past.rolling(24, min_periods=1).mean()}
        for column, values in expected.items():
            np.testing.assert_allclose(part[column].astype(float), values.ffill().bfill().fillna(0), atol=1e-9, err_msg=column)


def test_fill_gaps_treats_infinity_as_missing(spark):
    dense = panel.densify(make_panel(spark, {"a": {0: float("inf"), 1: 2.0, 2: float("-inf"), 30: None}}), KEY)
    found = panel.fill_gaps(dense, KEY, ["consumption_mw"]).orderBy("idx").toPandas()
    assert set(found["consumption_mw"]) == {2.0} and len(found) == 31


def test_mean_by_step_can_count_missing_as_zero(spark):
    rows = make_panel(spark, {"a": {0: 4.0}}).union(make_panel(spark, {"a": {0: None}}))
    for flag, expected in ((False, 4.0), (True, 2.0)):
        assert panel.mean_by_step(rows, KEY, "ts_utc", ["consumption_mw"], null_as_zero=flag).first()["consumption_mw"] == expected


def test_correlation_edges(spark):
    rows = [("const", float(i), 1.0) for i in range(10)] + [("nine", float(i), float(i)) for i in range(9)]
    rows += [("null", float(i), float(i) if i % 2 else None) for i in range(10)]
    df = spark.createDataFrame(rows, "region_clean string, consumption_mw double, temperature_c double")
    found = {r["region_clean"]: r["consumption_temperature_correlation"] for r in reports.weather_correlations(df).collect()}
    assert found["const"] is None and "nine" not in found and found["null"] == pytest.approx(1.0)


def test_lagged_correlation_of_a_shifted_copy(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=80)
    rows = [("a", START + dt.timedelta(hours=i), float(x[i - 3]) if i >= 3 else None, float(x[i])) for i in range(80)]
    df = spark.createDataFrame(rows, "region_clean string, ts_utc timestamp, consumption_mw double, other double")
    found = {r["lag"]: r["correlation"] for r in reports.lagged_correlations(panel.densify(df, KEY), "other").collect()}
    assert found[3] == pytest.approx(1.0) and abs(found[0]) < 0.5


def test_quality_filter(spark):
    df = spark.createDataFrame([(None,), (-1.0,), (0.0,), (60.0,)], "v double")
    assert panel.quality_filter(df, "v", low=0).count() == 3
    assert panel.quality_filter(df, "v", low=0, high=60, keep_null=False, closed=False).count() == 0
    assert panel.quality_filter(df, "v", low=0, high=60, keep_null=False).agg(F.count("*")).first()[0] == 2


def test_features_known_at_a_horizon():
    assert panel.feature_names(horizon=12)[:3] == ["consumption_lag_12", "consumption_lag_24", "hour"]
    assert len(panel.feature_names()) == 6 + 4 + 7
