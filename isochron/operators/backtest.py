"""Sliding-window backtests: the splitter, horizons, scored forecast rows.

A window holds exactly `train` + `test` rows of a series, so every (series, window) group is bounded by configuration, not
by data. All windows that fit are made unless `max_windows` asks for the first few.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isochron.fixed_values import LONG_HORIZONS, SHORT_HORIZONS, STEP_DAYS, TRAIN_DAYS

KEY = "region_clean"
GROUP = [KEY, "window"]


@dataclass(frozen=True)
class Geometry:
    """Rows in training, between window starts, horizons, and the largest number of windows (None: all that fit)."""

    train: int = TRAIN_DAYS * 24
    step: int = STEP_DAYS * 24
    horizons: Sequence[int] = field(default_factory=lambda: [*SHORT_HORIZONS, *LONG_HORIZONS])
    max_windows: int | None = None
    min_rows: int = 48
    min_coverage: float = 0.0
    expanding: bool = False

    @property
    def test(self) -> int:
        return max(self.horizons)


def split_windows(dense: DataFrame, geometry: Geometry) -> DataFrame:
    """Copy each row of a dense panel into the windows it belongs to.

    Adds window, role ('train' or 'test') and lead (1, 2, ... in the test part, 0 or less before it). Which windows
    hold a row is arithmetic on its position, so there is no join and no shuffle. With `max_windows` the rows behind the
    last window are dropped before the copy.
    """
    g = geometry
    idx, length = F.col("idx"), g.train + g.test
    final = F.floor((F.col("n_rows") - length) / g.step)
    if g.max_windows is not None:
        final = F.least(final, F.lit(g.max_windows - 1))
    oldest = F.greatest(F.ceil((idx - length + 1) / g.step), F.lit(0))
    newest = final if g.expanding else F.least(F.floor(idx / g.step), final)
    inside = dense.where((F.col("n_rows") >= max(g.min_rows, length)) & (idx < length + g.step * final))
    copied = inside.withColumn(
        "window", F.explode(F.when(oldest <= newest, F.sequence(oldest, newest)))
    ).withColumn("window", F.col("window").cast("int"))
    placed = copied.withColumn("lead", (idx - F.col("window") * g.step - g.train + 1).cast("int"))
    split = placed.withColumn("role", F.when(F.col("lead") > 0, "test").otherwise("train"))
    return covered(split, g.min_coverage) if g.min_coverage > 0 else split


def covered(split: DataFrame, share: float) -> DataFrame:
    """Windows in which at least this share of the training rows was observed."""
    train = split.where("role = 'train'").groupBy(*GROUP).agg(F.avg(F.col("observed").cast("int")).alias("_share"))
    return split.join(train.where(F.col("_share") >= share).select(*GROUP), GROUP, "left_semi")


def fan_out(test: DataFrame, horizons: Sequence[int]) -> DataFrame:
    """Repeat each test row for every horizon that reaches it: horizon h keeps leads 1..h."""
    reached = F.filter(F.array(*map(F.lit, horizons)), lambda h: h >= F.col("lead"))
    return test.withColumn("horizon", F.explode(reached))


def score(forecasts: DataFrame, geometry: Geometry, ts: str = "ts_utc", grain: str = "HOUR") -> DataFrame:
    """Forecast rows with errors, training bounds and flags, fanned out over horizons at the end.

    `forecasts` has series, window, lead, ts_utc, model, forecast_mw, actual_mw and sarimax_baseline_used. In a dense panel the bounds of a row's
    training part follow from its lead and the geometry, so nothing is joined or shuffled. mae and rmse
    are per row (both the absolute error); r2 has no value for a single row.
    """
    miss = F.col("actual_mw") - F.col("forecast_mw")
    length = F.lit(geometry.train) + (F.col("window") * geometry.step if geometry.expanding else 0)
    back = lambda steps: F.timestamp_add(grain, (-steps).cast("int"), F.col(ts))
    rows = forecasts.select(
        F.col(KEY).alias("region"), "model", F.lit("sliding").alias("validation_type"), "window", ts, "forecast_mw", "actual_mw",
        back(F.col("lead") + length - 1).alias("train_start"), back(F.col("lead")).alias("train_end"), F.col(ts).alias("test_end"),
        F.abs(miss).alias("mae"), F.sqrt(miss * miss).alias("rmse"), F.lit(None).cast("double").alias("r2"),
        "sarimax_baseline_used", F.startswith("model", F.lit("baseline_")).alias("is_baseline"), KEY, "lead",
    )
    return fan_out(rows, geometry.horizons).withColumn("test_start", F.timestamp_add("HOUR", 1 - F.col("horizon"), F.col(ts)))


def best_by_error(results: DataFrame) -> DataFrame:
    """The model with the lowest mean absolute error per series and horizon.

    Errors equal to nine decimals tie, whatever order their sums were taken in; ties go by name.
    """
    per_model = results.groupBy(KEY, "horizon", "model").agg(
        F.avg("mae").alias("mae"), F.avg("rmse").alias("rmse"), F.count("*").alias("forecasts")
    )
    return per_model.groupBy(KEY, "horizon").agg(
        F.min(F.struct(F.round("mae", 9), "model", "mae", "rmse", "forecasts")).alias("b")
    ).select(KEY, "horizon", "b.model", "b.mae", "b.rmse", "b.forecasts")


def complete_series(panel: DataFrame, results: DataFrame) -> DataFrame:
    """Actual rows (horizon 0, model 'actual') together with the best model's forecast rows per horizon."""
    actual = panel.withColumns({
        "data_type": F.lit("actual"), "forecast_horizon": F.lit(0), "model": F.lit("actual"),
        "forecast_mw": F.col("consumption_mw"),
    })
    best = best_by_error(results).select(KEY, "horizon", "model")
    forecast = results.join(best, [KEY, "horizon", "model"], "left_semi").select(
        KEY, "ts_utc", F.lit("forecast").alias("data_type"), F.col("horizon").alias("forecast_horizon"), "model",
        "forecast_mw", "mae", "rmse", "r2",
    )
    return actual.unionByName(forecast, allowMissingColumns=True)


def split_horizons(complete: DataFrame, bound: int = 24) -> tuple[DataFrame, DataFrame]:
    """(forecasts `bound` steps ahead or more, forecasts fewer steps ahead)."""
    forecasts = complete.where("data_type = 'forecast'")
    return forecasts.where(F.col("forecast_horizon") >= bound), forecasts.where(F.col("forecast_horizon") < bound)
