"""Panels: one row per series and time step.

Rows per series are bounded by the time range divided by the step, whatever the number of raw rows, because every
panel starts with a grouped mean that combines on the map side. Window functions still never see a whole series:
the dense panel is cut into slices of SLICE steps, and each slice carries the few steps before it that the window
looks back on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isochron.fixed_values import FEATURE_LAGS, FEATURE_SPANS
from isochron.functions.clock import calendar_parts, dow_from_monday, utc_to_local
from isochron.functions.numeric import cyclic, number_or_zero
from isochron.operators.shape import quoted

SLICE = 8192
STEP_SECONDS = {"hour": 3600, "day": 86400}


def mean_by_step(
    df: DataFrame, keys: Sequence[str], ts: str, measures: Sequence[str], out: str = "ts_utc",
    grain: str = "hour", null_as_zero: bool = False,
) -> DataFrame:
    """Mean of each measure per key and time step; missing values are left out, or count as 0 on request."""
    def value(name: str) -> Column:
        return number_or_zero(F.col(name)) if null_as_zero else F.col(name)

    step = F.date_trunc(grain, F.col(ts)).alias(out)
    return df.groupBy(*keys, step).agg(*[F.avg(value(m)).alias(m) for m in measures])


def densify(panel: DataFrame, keys: Sequence[str], ts: str = "ts_utc", grain: str = "hour") -> DataFrame:
    """Every step between a series' first and last row, with its position idx, the series length n_rows and an observed flag.

    Steps are generated block by block, spread over an explicit number of partitions (which AQE leaves alone), so
    long series and many series alike fan out. The panel is read twice; hand in a stored one.
    """
    step = STEP_SECONDS[grain]
    lo, hi = F.unix_seconds(F.min(ts)), F.unix_seconds(F.max(ts))
    bounds = panel.groupBy(*keys).agg(lo.alias("_lo"), (F.floor((hi - lo) / step) + 1).alias("n_rows"))
    last = F.col("n_rows") - 1
    partitions = int(panel.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = bounds.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(last / SLICE))))
    first = F.col("_block") * SLICE
    spine = (
        blocks.repartition(partitions, *keys, "_block")
        .withColumn("idx", F.explode(F.sequence(first, F.least(first + (SLICE - 1), last))))
        .withColumn(ts, F.timestamp_seconds(F.col("_lo") + F.col("idx") * step))
        .select(*keys, ts, "idx", "n_rows")
    )
    seen = panel.withColumn("observed", F.lit(True))
    return spine.join(seen, [*keys, ts], "left").withColumn("observed", F.coalesce("observed", F.lit(False)))


def with_history(dense: DataFrame, keys: Sequence[str], lookback: int, columns: dict[str, str]) -> DataFrame:
    """Add window columns that look back at most `lookback` rows of a dense panel, slice by slice.

    A column is an SQL expression in which OVER names the window, as made by lag_columns and rolling_columns. A slice is at
    least as long as the look-back, so a row is needed by its own slice and at most by the next.
    """
    length = max(SLICE, lookback)
    own, reached = F.floor(F.col("idx") / length), F.floor((F.col("idx") + lookback) / length)
    sliced = dense.withColumn("_own", own).withColumn("_slice", F.explode(F.array_distinct(F.array(own, reached))))
    window = f"OVER (PARTITION BY {', '.join(map(quoted, keys))}, _slice ORDER BY idx"
    added = sliced.withColumns({name: F.expr(sql.replace("OVER (", window + " ")) for name, sql in columns.items()})
    return added.where("_slice = _own").drop("_own", "_slice")


def lag_columns(measure: str, lags: Sequence[int], prefix: str) -> dict[str, str]:
    return {f"{prefix}{k}": f"lag({quoted(measure)}, {k}) OVER ()" for k in lags}


def rolling_columns(measure: str, spans: Sequence[int], prefix: str, exclude_current: bool = False) -> dict[str, str]:
    """Trailing means over up to `span` rows, ending at the current row or, on request, at the one before."""
    def frame(span: int) -> str:
        first, last = (span, "1 PRECEDING") if exclude_current else (span - 1, "CURRENT ROW")
        return f"ROWS BETWEEN {first} PRECEDING AND {last}"

    return {f"{prefix}{n}": f"avg({quoted(measure)}) OVER ({frame(n)})" for n in spans}


def demand_history(dense: DataFrame, keys: Sequence[str], measure: str = "consommation_mw", stem: str = "consommation") -> DataFrame:
    """A day's and a week's lag and the trailing week's mean, in one pass over the slices."""
    week = 168
    columns = lag_columns(measure, [24, week], f"{stem}_lag") | rolling_columns(measure, [week], f"{stem}_roll")
    return with_history(dense, keys, week, columns)


def add_calendar(df: DataFrame, ts: str = "ts_utc", local: str = "ts_paris", only: Sequence[str] | None = None) -> DataFrame:
    """Local timestamp and calendar parts that are not there yet."""
    if local not in df.columns:
        df = df.withColumn(local, utc_to_local(F.col(ts)))
    parts = calendar_parts(F.col(local))
    return df.withColumns({k: v for k, v in parts.items() if k not in df.columns and (only is None or k in only)})


def add_cyclic(df: DataFrame, **periods: int) -> DataFrame:
    """add_cyclic(df, hour=24) adds hour_sin and hour_cos."""
    added = {}
    for name, period in periods.items():
        added[f"{name}_sin"], added[f"{name}_cos"] = cyclic(F.col(name), period)
    return df.withColumns(added)


def _finite(measure: str) -> Column:
    return F.expr(f"CASE WHEN abs({quoted(measure)}) < double('infinity') THEN {quoted(measure)} END")


def fill_gaps(dense: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Per series: infinities to null, then the last value before, else the series' first value, else 0.

    Rows without an earlier value all stand before the series' first value, so filling backwards needs no window over
    following rows (which costs quadratic time). Values are carried within a slice by a running window, and across
    slices through one summary row per slice.
    """
    by = ", ".join(map(quoted, keys))
    finite = dense.withColumns({m: _finite(m) for m in measures}).withColumn("_slice", F.floor(F.col("idx") / SLICE))
    ends = finite.groupBy(*keys, "_slice").agg(*[
        F.expr(f"{end}({quoted(m)}, CASE WHEN {quoted(m)} IS NOT NULL THEN idx END) AS `_{end}_{m}`")
        for m in measures for end in ("max_by", "min_by")
    ])
    series = f"OVER (PARTITION BY {by} ORDER BY _slice ROWS BETWEEN UNBOUNDED PRECEDING AND"
    carried = ends.selectExpr(
        *map(quoted, keys), "_slice",
        *[f"last(`_max_by_{m}`, true) {series} 1 PRECEDING) AS `_before_{m}`" for m in measures],
        *[f"first(`_min_by_{m}`, true) {series} UNBOUNDED FOLLOWING) AS `_first_{m}`" for m in measures],
    )
    running = f"OVER (PARTITION BY {by}, _slice ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    inside = finite.withColumns({f"_past_{m}": F.expr(f"last({quoted(m)}, true) {running}") for m in measures})
    return inside.join(carried, [*keys, "_slice"], "left").selectExpr(*[
        f"coalesce(`_past_{c}`, `_before_{c}`, `_first_{c}`, 0.0D) AS {quoted(c)}" if c in measures else quoted(c)
        for c in dense.columns
    ])


def model_features(
    dense: DataFrame, keys: Sequence[str], measure: str = "consumption_mw", lags: Sequence[int] = FEATURE_LAGS,
    spans: Sequence[int] = FEATURE_SPANS, exclude_current: bool = False, extra: Sequence[str] = (),
) -> DataFrame:
    """Lags, trailing means, UTC calendar parts (Monday = 0) and their cyclic forms; gaps of all numbers filled.

    exclude_current keeps the row's own value out of its trailing means, as a forecasting model needs it.
    Only the measures are filled; filling the derived columns then has closed forms. A lag is the lag of the filled
    measure, or the series' first value before there is one. A trailing mean runs over present values; if its span holds
    none, the last mean there was is the last value before the gap.
    """
    stem, name = measure.removesuffix("_mw"), quoted(measure)
    present = dense.withColumn("_present", _finite(measure))
    filled = fill_gaps(present, keys, [measure, *extra])
    first = f"first({name}) OVER (ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    lagged = {c: f"coalesce({sql}, {first})" for c, sql in lag_columns(measure, lags, f"{stem}_lag_").items()}
    last = f"coalesce(lag({name}, 1) OVER (), {first})" if exclude_current else name
    means = rolling_columns("_present", spans, f"{stem}_rolling_mean_", exclude_current)
    columns = lagged | {c: f"coalesce({sql}, {last})" for c, sql in means.items()}
    featured = with_history(filled, keys, max([*lags, *spans], default=0) + 1, columns).drop("_present")
    ts = F.col("ts_utc")
    featured = featured.withColumns({"hour": F.hour(ts), "dow": dow_from_monday(ts), "month": F.month(ts)})
    return add_cyclic(featured, hour=24, dow=7)


def feature_names(
    stem: str = "consumption", lags: Sequence[int] = FEATURE_LAGS, spans: Sequence[int] = FEATURE_SPANS, horizon: int = 0,
) -> list[str]:
    """Names of the model features. With a horizon only those known that many steps ahead: lags that long, and the calendar."""
    history = [f"{stem}_lag_{k}" for k in lags if k >= horizon]
    if not horizon:
        history += [f"{stem}_rolling_mean_{n}" for n in spans]
    return [*history, "hour", "dow", "month", "hour_sin", "hour_cos", "dow_sin", "dow_cos"]


def quality_filter(df: DataFrame, measure: str, low: float | None = None, high: float | None = None,
                   keep_null: bool = True, closed: bool = True) -> DataFrame:
    """Rows whose measure lies within the bounds; null passes unless told otherwise."""
    value, test = F.col(measure), F.lit(True)
    if low is not None:
        test = test & (value >= low if closed else value > low)
    if high is not None:
        test = test & (value <= high if closed else value < high)
    return df.where(value.isNull() | test if keep_null else value.isNotNull() & test)
