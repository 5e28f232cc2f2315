"""Reports: data quality, correlations, model performance, panel summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isochron.fixed_values import CORRELATION_LAGS
from isochron.operators.backtest import KEY
from isochron.operators.panel import lag_columns, with_history


def correlation(a: str, b: str) -> Column:
    """Pearson correlation of the rows that have both values; null if either side is constant."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    x, y = F.when(both, F.col(a)), F.when(both, F.col(b))
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def data_quality(panel: DataFrame, complete: DataFrame | None = None, measure: str = "consumption_mw") -> DataFrame:
    """Per region: rows, time range, missing and zero values, mean and range, completeness, number of forecasts."""
    value = F.col(measure)
    profile = panel.groupBy(KEY).agg(
        F.count("*").alias("total_records"),
        F.min("ts_utc").alias("data_start"), F.max("ts_utc").alias("data_end"),
        F.count_if(value.isNull()).alias("missing_values"), F.count_if(value == 0).alias("zero_values"),
        F.avg(value).alias("avg_consumption"), F.max(value).alias("max_consumption"), F.min(value).alias("min_consumption"),
        ((1 - F.count_if(value.isNull()) / F.count("*")) * 100).alias("data_completeness"),
    )
    if complete is None:
        return profile
    forecasts = complete.where("data_type = 'forecast'").groupBy(KEY).agg(F.count("*").alias("forecast_count"))
    return profile.join(forecasts, KEY, "left").fillna(0, ["forecast_count"])


def weather_correlations(panel: DataFrame, min_rows: int = 10, measure: str = "consumption_mw") -> DataFrame:
    """Correlation of demand with temperature, solar and wind per region of at least ten rows."""
    names = {"temperature_c": "consumption_temperature_correlation"}
    names |= {c: f"consumption_{c}_correlation" for c in ("solar_production_mw", "wind_production_mw")}
    present = [c for c in names if c in panel.columns]
    return panel.groupBy(KEY).agg(
        *[correlation(measure, c).alias(names[c]) for c in present], F.count("*").alias("sample_size")
    ).where(F.col("sample_size") >= min_rows)


def lagged_correlations(dense: DataFrame, other: str, measure: str = "consumption_mw", lags: Sequence[int] = CORRELATION_LAGS) -> DataFrame:
    """Correlation of demand with another measure some steps earlier: one row per region and lag."""
    columns = lag_columns(other, [k for k in lags if k], "_lag")
    shifted = with_history(dense, [KEY], max(lags), columns).withColumn("_lag0", F.col(other))
    wide = shifted.groupBy(KEY).agg(*[correlation(measure, f"_lag{k}").alias(f"c{k}") for k in lags])
    pairs = F.array(*[F.struct(F.lit(k).alias("lag"), F.col(f"c{k}").alias("correlation")) for k in lags])
    return wide.select(KEY, F.explode(pairs).alias("p")).select(KEY, "p.lag", "p.correlation")


def model_performance(results: DataFrame) -> DataFrame:
    """Per model: forecasts, mean absolute error, mean R2 over (region, window, horizon) cells, hybrid forecasts."""
    miss = F.col("actual_mw") - F.col("forecast_mw")
    cells = results.groupBy("model", KEY, "window", "horizon").agg(
        F.count("*").alias("n"), F.sum("mae").alias("abs_sum"), F.sum(miss * miss).alias("sse"),
        (F.var_pop("actual_mw") * F.count("*")).alias("sst"),
        F.count_if("sarimax_baseline_used").alias("hybrid"),
    )
    r2 = F.when((F.col("n") > 1) & (F.col("sst") > 1e-9), 1 - F.try_divide("sse", "sst"))
    return cells.groupBy("model").agg(
        F.sum("n").alias("forecasts"),
        (F.sum("abs_sum") / F.sum("n")).alias("avg_mae"),
        F.avg(r2).alias("avg_r2"),
        F.sum("hybrid").alias("hybrid_forecasts"),
    )


def panel_summary(panel: DataFrame, key: str, measure: str, ts: str = "ts_utc") -> DataFrame:
    """One row: series, rows, mean and range of the measure, time range. Series are counted by a grouping of their own,
    so that the distinct count combines on the map side."""
    per_key = panel.groupBy(key).agg(
        F.count("*").alias("n"), F.sum(measure).alias("s"), F.count(measure).alias("c"),
        F.min(measure).alias("lo"), F.max(measure).alias("hi"), F.min(ts).alias("t0"), F.max(ts).alias("t1"),
    )
    return per_key.agg(
        F.count("*").alias("series"), F.sum("n").alias("rows"),
        F.try_divide(F.sum("s"), F.sum("c")).alias("mean"), F.min("lo").alias("min"), F.max("hi").alias("max"),
        F.min("t0").alias("first_ts"), F.max("t1").alias("last_ts"),
    )
