"""Forecast models over split windows.

Each takes the output of split_windows and returns one row per test row and model: series, window, lead, ts_utc,
actual_mw, model, forecast_mw, sarimax_baseline_used. Where SQL aggregates express a model it is written in them;
least squares and nearest neighbours run as numpy inside (series, window) groups, whose size the geometry fixes;
forests and boosting use Spark ML on all series together.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial, reduce
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isochron.fixed_values import SEASON
from isochron.functions.binding import let
from isochron.operators import trees as grown
from isochron.operators.backtest import GROUP, KEY
from isochron.session import shared_folder

Y = "consumption_mw"
OUTPUT = f"{KEY} string, window int, lead int, ts_utc timestamp, actual_mw double, forecast_mw double"


def _test_rows(split: DataFrame, ts: str = "ts_utc") -> DataFrame:
    return split.where("role = 'test'").select(*GROUP, "lead", ts, F.col(Y).alias("actual_mw"))


def _recent(split: DataFrame, rows: int) -> Column:
    """Aggregate: the last `rows` training values, oldest first; a bounded list."""
    recent = F.when(F.col("lead") > -rows, F.struct("lead", Y))
    return F.transform(F.array_sort(F.collect_list(recent)), lambda pair: pair[Y])


def _named(forecasts: DataFrame, model: str, arima: bool = False) -> DataFrame:
    return forecasts.withColumns({"model": F.lit(model), "sarimax_baseline_used": F.lit(arima)})


def _last(values: Column, back: Column | int) -> Column:
    """The value `back` places from the end (1 = last) of an array; null if there are fewer."""
    place = F.size(values) - back
    return F.when(place >= 0, F.get(values, place))


def recent_values(split: DataFrame, rows: int = SEASON + 1) -> DataFrame:
    """One row per group with its last training values; the source of all models that need no more than these."""
    return split.where("role = 'train'").groupBy(*GROUP).agg(
        _recent(split, rows).alias("recent"), F.count("*").alias("train_rows")
    )


def naive(values: Column) -> Column:
    return F.coalesce(_last(values, 1), F.lit(0.0))


def seasonal_naive(values: Column, lead: Column, season: int = SEASON) -> Column:
    """The value one season back, repeated; the last value if there is less than one season."""
    return F.when(F.size(values) >= season, _last(values, season - (lead - 1) % season)).otherwise(naive(values))


def moving_average(values: Column, span: int = SEASON) -> Column:
    tail = F.slice(values, F.greatest(F.size(values) - span + 1, F.lit(1)), F.lit(span))
    total = F.aggregate(tail, F.lit(0.0), lambda done, value: done + value)
    return F.when(F.size(values) > 0, total / F.size(tail))


def seasonal_difference(values: Column, lead: Column, season: int = SEASON) -> Column:
    """Closed form of the once and seasonally once differenced random walk: a season back plus the drift per season."""
    drift = _last(values, 1) - _last(values, season + 1)
    return _last(values, season - (lead - 1) % season) + F.ceil(lead / season) * drift


def last_value_models(split: DataFrame) -> DataFrame:
    """baseline_naive, baseline_seasonal_naive and baseline_moving_average in one aggregation and one join."""
    lead, values = F.col("lead"), F.col("recent")
    rows = _test_rows(split).join(recent_values(split, SEASON), GROUP)
    models = {
        "baseline_naive": naive(values),
        "baseline_seasonal_naive": seasonal_naive(values, lead),
        "baseline_moving_average": moving_average(values),
    }
    forecasts = F.array(*[F.struct(F.lit(m).alias("model"), f.alias("forecast_mw")) for m, f in models.items()])
    return rows.withColumn("f", F.explode(forecasts)).select(
        *GROUP, "lead", "ts_utc", "actual_mw", "f.model", "f.forecast_mw", F.lit(False).alias("sarimax_baseline_used")
    )


def _holt_fold(values: Column, alpha: Column, beta: Column) -> Column:
    """Level, trend and squared one-step errors after running over the values, as one native fold."""
    start = F.struct(
        F.get(values, F.lit(0)).alias("level"),
        (F.get(values, F.lit(1)) - F.get(values, F.lit(0))).alias("trend"),
        F.lit(0.0).alias("sse"),
    )

    def step(state: Column, value: Column) -> Column:
        expected = state["level"] + state["trend"]
        miss = value - expected
        level = expected + alpha * miss
        return F.struct(
            level.alias("level"), (state["trend"] + beta * alpha * miss).alias("trend"),
            (state["sse"] + miss * miss).alias("sse"),
        )

    return F.aggregate(F.slice(values, 2, F.greatest(F.size(values) - 1, F.lit(0))), start, step)


SMALLEST_WEIGHT = 0.0001


def refining_steps(rounds: int, step: float = 0.1) -> list[float]:
    """Distances between the points of each finer grid: a third of the one before."""
    return [step / 3 ** (i + 1) for i in range(rounds)]


def smoothing(
    split: DataFrame, alphas: Sequence[float] | None = None, betas: Sequence[float] | None = None, rounds: int = 0,
) -> DataFrame:
    """baseline_exponential_smoothing: additive trend, no season.

    The smoothing weights minimise the squared one-step error over a grid, then over `rounds` grids of nine points around the best so far, each a
    third as wide: six rounds fix them to four decimals. All points are folded over a group's
    values where they were gathered, so a series is shuffled once. Under ten training rows: the moving average.
    """
    grid = [round(0.1 * i, 1) for i in range(1, 10)]
    alphas, betas = alphas or grid, betas or [0.0, *grid]
    points = F.array(*[F.struct(F.lit(a).alias("alpha"), F.lit(b).alias("beta")) for a in alphas for b in betas])
    ordered = F.array_sort(F.collect_list(F.struct("lead", Y)))
    series = split.where("role = 'train'").groupBy(*GROUP).agg(
        F.transform(ordered, lambda pair: pair[Y]).alias("values")
    )

    def trial(point: Column) -> Column:
        return let(_holt_fold(F.col("values"), point["alpha"], point["beta"]), lambda s: F.struct(
            s["sse"].alias("sse"), point["alpha"].alias("alpha"), point["beta"].alias("beta"), s["level"].alias("level"), s["trend"].alias("trend")
        ))

    def finer(step: float) -> Callable[[Column], Column]:
        near = [(a * step, b * step) for a in (-1, 0, 1) for b in (-1, 0, 1)]
        offsets = F.array(*[F.struct(F.lit(a).alias("alpha"), F.lit(b).alias("beta")) for a, b in near])

        def least(best: Column) -> Column:
            around = F.transform(offsets, lambda o: F.struct(
                F.least(F.greatest(best["alpha"] + o["alpha"], F.lit(SMALLEST_WEIGHT)), F.lit(1.0)).alias("alpha"),
                F.least(F.greatest(best["beta"] + o["beta"], F.lit(0.0)), F.lit(1.0)).alias("beta"),
            ))
            return F.array_min(F.transform(around, trial))

        return least

    found = F.array_min(F.transform(points, trial))
    for step in refining_steps(rounds):
        found = let(found, finer(step))
    best = series.select(
        *GROUP, found.alias("s"),
        F.when(F.size("values") < 10, moving_average(F.col("values"))).alias("short"),
    )
    rows = _test_rows(split).join(best, GROUP)
    forecast = F.coalesce("short", F.col("s.level") + F.col("lead") * F.col("s.trend"))
    out = rows.select(*GROUP, "lead", "ts_utc", "actual_mw", forecast.alias("forecast_mw"))
    return _named(out, "baseline_exponential_smoothing")


def baselines(split: DataFrame) -> DataFrame:
    return last_value_models(split).unionByName(smoothing(split))


def seasonal_difference_model(split: DataFrame, season: int = SEASON) -> DataFrame:
    """The last of the seasonal ARIMA orders, in closed form."""
    rows = _test_rows(split).join(recent_values(split, season + 1), GROUP)
    forecast = seasonal_difference(F.col("recent"), F.col("lead"), season)
    out = rows.select(*GROUP, "lead", "ts_utc", "actual_mw", forecast.alias("forecast_mw"))
    return _named(out, "SARIMAX", True)


def seasonal_ar1(split: DataFrame, season: int = SEASON) -> DataFrame:
    """AR(1) on the seasonal difference: phi = sum(d_t d_{t-1}) / sum(d_{t-1}^2), lags by window, the rest aggregates."""
    order = Window.partitionBy(*GROUP).orderBy("lead")
    diff = split.where("role = 'train'").select(*GROUP, "lead", (F.col(Y) - F.lag(Y, season).over(order)).alias("d"))
    both = diff.withColumn("d_before", F.lag("d").over(order))
    fit = both.groupBy(*GROUP).agg(
        F.coalesce(F.try_divide(F.sum(F.col("d") * F.col("d_before")), F.sum(F.col("d_before") * F.col("d_before"))),
                   F.lit(0.0)).alias("phi"),
        F.max_by("d", "lead").alias("d_last"),
    )
    rows = _test_rows(split).join(recent_values(split, season), GROUP).join(fit, GROUP)
    seasons = F.ceil(F.col("lead") / season).cast("int")
    first = (F.col("lead") - 1) % season + 1
    # Differences decay as phi^k * d_last; a forecast adds those of its own hour over the seasons passed.
    decay = F.aggregate(
        F.sequence(F.lit(0), seasons - 1), F.lit(0.0),
        lambda done, i: done + F.pow(F.col("phi"), first + i * season) * F.col("d_last"),
    )
    forecast = seasonal_naive(F.col("recent"), F.col("lead"), season) + decay
    out = rows.select(*GROUP, "lead", "ts_utc", "actual_mw", forecast.alias("forecast_mw"), "phi")
    return _named(out, "SARIMAX", True)


def linear_one_feature(split: DataFrame, feature: str) -> DataFrame:
    """Least squares on one feature as aggregates."""
    fit = split.where("role = 'train'").groupBy(*GROUP).agg(
        F.avg(feature).alias("mx"), F.avg(Y).alias("my"),
        F.covar_pop(feature, Y).alias("cov"), F.var_pop(feature).alias("var"),
    )
    slope = F.coalesce(F.try_divide(F.col("cov"), F.col("var")), F.lit(0.0))
    rows = split.where("role = 'test'").join(fit, GROUP)
    forecast = F.col("my") + slope * (F.col(feature) - F.col("mx"))
    out = rows.select(*GROUP, "lead", "ts_utc", F.col(Y).alias("actual_mw"), forecast.alias("forecast_mw"))
    return _named(out, "linear")


def _solve(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Minimum-norm least squares with intercept."""
    mean_x, mean_y = x.mean(axis=0), y.mean()
    weights = np.linalg.lstsq(x - mean_x, y - mean_y, rcond=None)[0]
    return weights, mean_y - mean_x @ weights


def _per_group(split: DataFrame, features: Sequence[str], target: str, predict) -> DataFrame:
    """Run predict(x_train, y_train, x_test) in each group; feature values missing count as 0."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("lead", ignore_index=True)
        train = (pdf["role"] == "train").to_numpy()
        x, y = pdf[list(features)].fillna(0.0).to_numpy(float), pdf[target].fillna(0.0).to_numpy(float)
        out = pdf.loc[~train, [*GROUP, "lead", "ts_utc", Y]].rename(columns={Y: "actual_mw"})
        return out.assign(forecast_mw=predict(x[train], y[train], x[~train]) if train.any() else np.nan)

    columns = list(dict.fromkeys([*GROUP, "lead", "role", "ts_utc", Y, target, *features]))
    return split.select(*columns).groupBy(*GROUP).applyInPandas(run, OUTPUT)


def predict_linear(x: np.ndarray, y: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Least squares on all features."""
    weights, intercept = _solve(x, y)
    return new @ weights + intercept


def predict_nearest(x: np.ndarray, y: np.ndarray, new: np.ndarray, k: int = 10) -> np.ndarray:
    """Mean of the k training rows nearest in unscaled Euclidean distance (ties to the earlier row)."""
    n = min(k, len(x))
    means = []
    for block in np.array_split(new, max(1, len(new) // 64)):
        distance = ((x[None] - block[:, None]) ** 2).sum(axis=2)
        bound = np.partition(distance, n - 1, axis=1)[:, n - 1:n]
        nearer, tied = distance < bound, distance == bound
        room = n - nearer.sum(axis=1, keepdims=True)
        means.append(((nearer | (tied & (tied.cumsum(axis=1) <= room))) @ y) / n)
    return np.concatenate(means)


def predicted(split: DataFrame, features: Sequence[str], predict) -> DataFrame:
    """Any function of (training features, training values, test features) in each group."""
    return _per_group(split, features, Y, predict)


def linear(split: DataFrame, features: Sequence[str], target: str = Y) -> DataFrame:
    """Least squares on all features, one small solve per group."""
    return _named(_per_group(split, features, target, predict_linear), "linear")


def knn(split: DataFrame, features: Sequence[str], k: int = 10, target: str = Y) -> DataFrame:
    """Nearest neighbours inside each group."""
    return _named(_per_group(split, features, target, partial(predict_nearest, k=k)), "knn")


# Seasonal ARIMA orders in the sequence tried, as (p, d, q, seasonal p, seasonal d, seasonal q).
ARIMA_ORDERS = [(1, 1, 1, 1, 1, 1), (1, 1, 0, 1, 1, 0), (0, 1, 1, 0, 1, 1), (1, 0, 0, 1, 0, 0), (0, 1, 0, 0, 1, 0)]
ARIMA_OUTPUT = f"{KEY} string, window int, lead int, fitted double, fit_ok boolean, arima_order int"


def _differencing(d: int, seasonal_d: int, season: int) -> np.ndarray:
    """Coefficients c of the differencing polynomial: w_t = sum_i c_i y_{t-i}, with c_0 = 1."""
    poly = np.array([1.0])
    for _ in range(d):
        poly = np.convolve(poly, [1.0, -1.0])
    for _ in range(seasonal_d):
        poly = np.convolve(poly, np.r_[1.0, np.zeros(season - 1), -1.0])
    return poly


def _arima_path(y: np.ndarray, n: int, x: np.ndarray, order: tuple, season: int) -> np.ndarray | None:
    """One-step fits of the first n values followed by forecasts of the rest; None if the order cannot be fitted.

    Conditional least squares on the differenced values. With moving-average terms there are two stages: a regression
    on all lags gives errors, and the lagged errors then enter as regressors.
    """
    p, d, q, sp, sd, sq = order
    ar, ma = _lags(p, sp, season), _lags(q, sq, season)
    poly = _differencing(d, sd, season)
    reach = len(poly) - 1
    w = np.convolve(y[:n], poly, mode="valid")
    extra = [np.convolve(column, poly, mode="valid") for column in x.T]
    extra = [e for e in extra if np.abs(e).max() > 1e-9]
    rows = np.arange(max([0, *ar, *ma]), len(w))
    if len(rows) <= len(ar) + len(ma) + len(extra) + 2:
        return None

    def regress(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        matrix = np.array([*columns, *[e[rows] for e in extra]]).reshape(-1, len(rows)).T
        weights = np.linalg.lstsq(matrix, w[rows], rcond=None)[0]
        errors = np.zeros(len(w))
        errors[rows] = w[rows] - matrix @ weights
        return weights, errors

    weights, errors = regress(*[w[rows - lag] for lag in (sorted({*ar, *ma}) if ma else ar)])
    if ma:
        weights, errors = regress(*[w[rows - lag] for lag in ar], *[errors[rows - lag] for lag in ma])

    steps = len(y) - n
    w, shocks, path = np.r_[w, np.zeros(steps)], np.r_[errors, np.zeros(steps)], np.r_[y[:n], np.zeros(steps)]
    for t in range(len(errors), len(w)):
        terms = [*[w[t - lag] for lag in ar], *[shocks[t - lag] for lag in ma], *[e[t] for e in extra]]
        w[t] = np.dot(terms, weights)
        path[t + reach] = w[t] - poly[1:] @ path[t:t + reach][::-1]
    path[reach:n] -= errors
    return path if np.isfinite(path).all() and np.abs(path).max() <= 10 * (np.abs(y[:n]).max() + 1.0) else None


def _lags(order: int, seasonal: int, season: int) -> list[int]:
    return sorted({i + season * j for i in range(order + 1) for j in range(seasonal + 1)} - {0})


def arima_chain(y: np.ndarray, n: int, x: np.ndarray, orders: Sequence[tuple], season: int) -> tuple[np.ndarray, bool, int]:
    """(fits of n training values and forecasts after them, whether an order worked, which)."""
    if n >= 48:
        for chosen, order in enumerate(orders):
            path = _arima_path(y, n, x, order, season)
            if path is not None:
                return path, True, chosen
    return np.r_[y[:n], np.full(len(y) - n, y[max(n - season, 0):n].mean() if n else 0.0)], False, -1


def arima_fits(
    split: DataFrame, exogenous: Sequence[str] = (), orders: Sequence[tuple] = tuple(ARIMA_ORDERS), season: int = SEASON,
) -> DataFrame:
    """Per row: the fit (training) or forecast (test) of the first order that works, whether one did, and which.

    Orders that give non-finite or exploding paths count as failed. Under 48 training rows, or if all fail, forecasts
    are the moving average and training fits equal the values. An approximation of maximum likelihood by conditional
    least squares.
    """
    orders = list(orders)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("lead", ignore_index=True)
        n = int((pdf["role"] == "train").sum())
        y, x = pdf[Y].to_numpy(float), pdf[list(exogenous)].fillna(0.0).to_numpy(float)
        path, ok, chosen = arima_chain(y, n, x, orders, season)
        out = pdf[[*GROUP, "lead"]].copy()
        return out.assign(fitted=path, fit_ok=ok, arima_order=chosen)

    columns = list(dict.fromkeys([*GROUP, "lead", "role", Y, *exogenous]))
    return split.select(*columns).groupBy(*GROUP).applyInPandas(run, ARIMA_OUTPUT)


def arima(split: DataFrame, exogenous: Sequence[str] = (), **options) -> DataFrame:
    """The seasonal ARIMA chain as a model of its own."""
    rows = _test_rows(split).join(arima_fits(split, exogenous, **options), [*GROUP, "lead"])
    out = rows.select(*GROUP, "lead", "ts_utc", "actual_mw", F.col("fitted").alias("forecast_mw"), "fit_ok", "arima_order")
    return _named(out, "SARIMAX").withColumn("sarimax_baseline_used", F.col("fit_ok"))


def seasonal_difference_fits(split: DataFrame, season: int = SEASON) -> DataFrame:
    """The same columns as arima_fits for the closed-form order: y(t-1) + y(t-s) - y(t-s-1) in training."""
    order = Window.partitionBy(*GROUP).orderBy("lead")
    expected = F.lag(Y, 1).over(order) + F.lag(Y, season).over(order) - F.lag(Y, season + 1).over(order)
    fits = split.where("role = 'train'").select(*GROUP, "lead", F.coalesce(expected, F.col(Y)).alias("fitted"))
    tests = seasonal_difference_model(split, season).select(*GROUP, "lead", F.col("forecast_mw").alias("fitted"))
    return fits.unionByName(tests).withColumns({"fit_ok": F.lit(True), "arima_order": F.lit(len(ARIMA_ORDERS) - 1)})


def hybrid(split: DataFrame, fits: DataFrame, residual_model) -> DataFrame:
    """A model of the ARIMA residuals added to the ARIMA forecast; where no order fitted, the model of the values.

    residual_model(split) sees the residuals (or the values) in the target column.
    """
    joined = split.join(fits, [*GROUP, "lead"])
    actual = joined.select(*GROUP, "lead", F.col(Y).alias("_y"), "fitted", "fit_ok")
    target = F.when(F.col("fit_ok") & (F.col("role") == "train"), F.col(Y) - F.col("fitted")).otherwise(F.col(Y))
    modelled = residual_model(joined.withColumn(Y, target)).drop("actual_mw").join(actual, [*GROUP, "lead"])
    base = F.when(F.col("fit_ok"), F.col("fitted")).otherwise(F.lit(0.0))
    return modelled.select(
        *GROUP, "lead", "ts_utc", F.col("_y").alias("actual_mw"), (F.col("forecast_mw") + base).alias("forecast_mw"),
        F.when(F.col("fit_ok"), F.concat(F.lit("SARIMAX_"), "model")).otherwise(F.col("model")).alias("model"),
        F.col("fit_ok").alias("sarimax_baseline_used"),
    )


def feature_matrix(split: DataFrame, features: Sequence[str]) -> DataFrame:
    """Rows with a Spark ML feature vector: the level of the series (its mean over the window's training part), then the features,
    missing values as 0."""
    from pyspark.ml.feature import VectorAssembler

    level = split.where("role = 'train'").groupBy(*GROUP).agg(F.coalesce(F.avg(Y), F.lit(0.0)).alias("series_level"))
    filled = split.withColumns({f: F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features})
    assembler = VectorAssembler(inputCols=["series_level", *features], outputCol="features", handleInvalid="error")
    return assembler.transform(filled.join(level, GROUP))


# Partitions of the training rows of a tree fit, and fits at once. Bagging draws per partition, so the number must not follow the
# size of the data or the session's settings; a cluster that fits on more rows passes a larger one.
TREE_PARTITIONS, FITS_AT_ONCE = 8, 4


def tree_model(split: DataFrame, features: Sequence[str], estimator, name: str, partitions: int = TREE_PARTITIONS) -> DataFrame:
    """Fit a Spark ML regressor per window on all series together and predict the window's test rows.

    Only the list of windows comes to the driver; a few fits run at a time, each distributed over the rows. Rows lie in the
    same partitions in the same order on every run, so forecasts do not depend on how the rows arrived.
    """
    matrix = feature_matrix(split, features).select(
        *GROUP, "lead", "role", "ts_utc", F.col(Y).alias("actual_mw"), F.col(Y).alias("label"), "features"
    )
    windows = [r["window"] for r in split.where("role = 'train'").select("window").distinct().orderBy("window").collect()]

    def run(window: int) -> DataFrame:
        rows = matrix.where(F.col("window") == window)
        train = rows.where("role = 'train'").repartition(partitions, KEY, "lead").sortWithinPartitions(KEY, "lead")
        return estimator.fit(train).transform(rows.where("role = 'test'"))

    with ThreadPool(FITS_AT_ONCE) as pool:
        fitted = pool.map(inheritable_thread_target(split.sparkSession)(run), windows)
    union = reduce(DataFrame.unionByName, fitted)
    out = union.select(*GROUP, "lead", "ts_utc", "actual_mw", F.col("prediction").alias("forecast_mw"))
    return _named(out, name)


def forest(split: DataFrame, features: Sequence[str], trees: int = 100, depth: int = 15, seed: int = 42) -> DataFrame:
    from pyspark.ml.regression import RandomForestRegressor

    estimator = RandomForestRegressor(numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="all")
    return tree_model(split, features, estimator, "random_forest")


def boosting(split: DataFrame, features: Sequence[str], trees: int = 100, depth: int = 10, seed: int = 42) -> DataFrame:
    from pyspark.ml.regression import GBTRegressor

    shared_folder(split.sparkSession)  # the booster cuts its lineage there
    estimator = GBTRegressor(maxIter=trees, maxDepth=depth, seed=seed)
    return tree_model(split, features, estimator, "gradient_boosting")


# Models by name: functions of (training features, training values, test features) that give the test values. Baselines come from `baselines`.
REGISTRY = {"linear": predict_linear, "random_forest": grown.forest, "gradient_boosting": grown.boosting, "knn": predict_nearest}
ROWS = f"{OUTPUT}, model string, sarimax_baseline_used boolean"
FIT_TASKS = 4


def run_models(
    split: DataFrame, features: Sequence[str], names: Sequence[str], exogenous: Sequence[str] = (),
    orders: Sequence[tuple] | None = tuple(ARIMA_ORDERS), season: int = SEASON,
) -> DataFrame:
    """Forecasts of the seasonal ARIMA chain and of the named models in one shuffle: each (series, window) group is fitted once by all of them.

    The models learn the residuals of the chain, and its forecast is added to theirs (SARIMAX_<name>); where no order fits, they learn the
    values and stand alone. Without `orders` there is no chain. A group holds the training and test rows of a window, which the
    geometry bounds; all series and windows run in parallel, and a repeated task gives the same rows.
    """
    chosen = {name: REGISTRY[name] for name in names}
    inputs = list(dict.fromkeys([*features, *exogenous]))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("lead", ignore_index=True)
        n = int((pdf["role"] == "train").sum())
        cells = pdf[inputs].astype(float).fillna(0.0)
        y = pdf[Y].fillna(0.0).to_numpy(float)
        x, path, ok = cells[list(features)].to_numpy(float), np.zeros(len(y)), False
        found = []
        if orders is not None:
            path, ok, _ = arima_chain(y, n, cells[list(exogenous)].to_numpy(float), orders, season)
            found.append(("SARIMAX", path[n:]))
        base = path if ok else np.zeros(len(y))
        for name, predict in chosen.items():
            values = predict(x[:n], y[:n] - base[:n], x[n:]) + base[n:] if n else np.full(len(y) - n, np.nan)
            found.append((f"SARIMAX_{name}" if ok else name, values))
        rows = pdf.loc[n:, [*GROUP, "lead", "ts_utc", Y]].rename(columns={Y: "actual_mw"})
        return pd.concat([rows.assign(forecast_mw=values, model=model, sarimax_baseline_used=ok) for model, values in found])

    columns = list(dict.fromkeys([*GROUP, "lead", "role", "ts_utc", Y, *inputs]))
    # Fits cost far more than rows, so groups are spread over a number of tasks of their own, which the size of the rows does not lower.
    tasks = FIT_TASKS * int(split.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return split.select(*columns).repartition(tasks, *GROUP).groupBy(*GROUP).applyInPandas(run, ROWS)
