"""Statistics of backtest windows without copying rows into windows.

A series is summed up once; a sum over any run of rows is then the difference of two of its running sums. So a window
costs two rows, however long it is and however many windows share a row: means, variances, covariances and the normal
equations of least squares all come from sums of values and of products.

Running sums start anew in every slice of a series, and what the slices before hold is added from one row per slice.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isochron.functions.binding import let
from isochron.operators.backtest import GROUP, KEY, Geometry
from isochron.operators.panel import SLICE
from isochron.operators.shape import quoted

Y = "consumption_mw"
# A column is taken as a sum of others where less than this share of its own variation is left.
DEPENDENT = 1e-10


def running_sums(dense: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Per row of a dense panel: the sums of the named values over the series up to and with the row. Nulls count as 0."""
    zero = F.lit(0.0)
    sliced = dense.select(
        KEY, "idx", "n_rows", F.floor(F.col("idx") / SLICE).alias("_slice"),
        *[F.coalesce(v.cast("double"), zero).alias(name) for name, v in values.items()],
    )
    totals = sliced.groupBy(KEY, "_slice").agg(*[F.sum(quoted(name)).alias(name) for name in values])
    series = f"OVER (PARTITION BY {KEY} ORDER BY _slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    before = totals.selectExpr(KEY, "_slice", *[f"coalesce(sum({quoted(name)}) {series}, 0.0D) AS {quoted('_before_' + name)}" for name in values])
    inside = f"OVER (PARTITION BY {KEY}, _slice ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    summed = sliced.selectExpr(KEY, "idx", "n_rows", "_slice", *[f"sum({quoted(name)}) {inside} AS {quoted(name)}" for name in values])
    return summed.join(before, [KEY, "_slice"]).select(
        KEY, "idx", "n_rows", *[(F.col(quoted(name)) + F.col(quoted("_before_" + name))).alias(name) for name in values]
    )


def final_window(geometry: Geometry) -> Column:
    """The number of a series' last window; negative where there is none."""
    g = geometry
    last = F.floor((F.col("n_rows") - (g.train + g.test)) / g.step)
    if g.max_windows is not None:
        last = F.least(last, F.lit(g.max_windows - 1))
    return F.when(F.col("n_rows") >= max(g.min_rows, g.train + g.test), last).otherwise(F.lit(-1))


def _at(sums: DataFrame, offset: int, geometry: Geometry, names: Sequence[str], prefix: str = "") -> DataFrame:
    """The running sums just before row `offset` of each window. Which window a row bounds is arithmetic on its position."""
    place = F.col("idx") + 1 - offset
    window = F.floor(place / geometry.step)
    bounds = sums.where((place >= 0) & (place % geometry.step == 0) & (window <= final_window(geometry)))
    return bounds.select(KEY, window.cast("int").alias("window"), *[F.col(quoted(n)).alias(prefix + n) for n in names])


def window_sums(sums: DataFrame, geometry: Geometry, names: Sequence[str], span: int | None = None) -> DataFrame:
    """One row per (series, window): the sums of the named values over its training rows, or its last `span` of them.

    Hand in stored running sums: two filters read them, and the rows that bound windows are joined.
    """
    if geometry.expanding:
        return _at(sums, geometry.train, geometry, names)
    ends = _at(sums, geometry.train, geometry, names)
    starts = _at(sums, geometry.train - (span or geometry.train), geometry, names, "_from_")
    both = ends.join(starts, GROUP, "left")
    return both.select(*GROUP, *[(F.col(quoted(n)) - F.coalesce(F.col(quoted("_from_" + n)), F.lit(0.0))).alias(n) for n in names])


def test_rows(dense: DataFrame, geometry: Geometry) -> DataFrame:
    """Rows of a dense panel in the test parts of windows, with window and lead; training rows are never copied."""
    g = geometry
    oldest = F.greatest(F.ceil((F.col("idx") - g.train - g.test + 1) / g.step), F.lit(0))
    newest = F.least(F.floor((F.col("idx") - g.train) / g.step), final_window(g))
    placed = dense.where(F.col("idx") >= g.train).withColumn("window", F.explode(F.when(oldest <= newest, F.sequence(oldest, newest))))
    return placed.withColumns({
        "window": F.col("window").cast("int"), "lead": (F.col("idx") - F.col("window") * g.step - g.train + 1).cast("int"),
    })


# -- Statistics ----------------------------------------------------------------------------------------------------------


def moving_average(sums: DataFrame, dense: DataFrame, geometry: Geometry, span: int, measure: str = Y) -> DataFrame:
    """The mean of the last `span` training values as forecast of every test row; `sums` holds the measure's running sums."""
    mean = window_sums(sums, geometry, [measure], span).select(*GROUP, (F.col(measure) / min(span, geometry.train)).alias("forecast_mw"))
    rows = test_rows(dense, geometry).select(*GROUP, "lead", "ts_utc", F.col(measure).alias("actual_mw"))
    return rows.join(mean, GROUP)


def moments(features: Sequence[str], target: str = Y) -> dict[str, Column]:
    """The values whose sums make the normal equations: 1, each column, and the products of all pairs; the target comes last."""
    columns = [F.coalesce(F.col(quoted(c)).cast("double"), F.lit(0.0)) for c in [*features, target]]
    singles = {f"s{i}": c for i, c in enumerate(columns)}
    pairs = {f"s{i}_{j}": columns[i] * columns[j] for i, j in combinations_with_replacement(range(len(columns)), 2)}
    return {"s": F.lit(1.0), **singles, **pairs}


def _centred(size: int) -> Column:
    """Rows of the normal equations around the means, each with the target's product at its end."""
    def cell(i: int, j: int) -> Column:
        low, high = min(i, j), max(i, j)
        return F.col(f"s{low}_{high}") - F.col(f"s{i}") * F.col(f"s{j}") / F.col("s")

    return F.array(*[F.array(*[cell(i, j) for j in range(size + 1)]) for i in range(size)])


def solved(size: int) -> Column:
    """Weights of least squares from columns of summed moments, by elimination as a fold over the columns.

    The matrix is symmetric and never negative, so the pivots are taken in order without exchanges; a column that the ones before explain gets
    the weight 0.
    """
    def eliminate(rows: Column, k: Column, left: Column) -> Column:
        row = F.get(rows, k)
        pivot = F.get(row, k)
        usable = pivot > F.get(left, k) * DEPENDENT
        scaled = F.when(usable, F.transform(row, lambda v: v / pivot)).otherwise(F.transform(row, lambda _: F.lit(0.0)))
        return let(scaled, lambda own: F.transform(
            rows, lambda other, i: F.when(i == k, own).otherwise(F.zip_with(other, own, lambda a, b: a - F.get(other, k) * b))
        ))

    if not size:
        return F.array().cast("array<double>")
    matrix = _centred(size)
    swept = let(matrix, lambda m: F.aggregate(
        F.sequence(F.lit(0), F.lit(size - 1)), m, lambda rows, k: eliminate(rows, k, F.transform(m, lambda row, i: F.get(row, i)))
    ))
    return F.transform(swept, lambda row: F.get(row, F.lit(size)))


def fitted(sums: DataFrame, features: Sequence[str]) -> DataFrame:
    """weights (one per feature) and intercept of each (series, window) from its summed moments."""
    size = len(features)
    weighed = sums.select(*GROUP, solved(size).alias("weights"), F.array(*[F.col(f"s{i}") / F.col("s") for i in range(size)]).alias("_means"),
                          (F.col(f"s{size}") / F.col("s")).alias("_level"))
    return weighed.select(*GROUP, "weights", (F.col("_level") - _product(F.col("weights"), F.col("_means"))).alias("intercept"))


def _product(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda done, value: done + value)


def _forecast(rows: DataFrame, fits: DataFrame, features: Sequence[str]) -> DataFrame:
    values = F.array(*[F.coalesce(F.col(quoted(f)).cast("double"), F.lit(0.0)) for f in features]).cast("array<double>")
    joined = rows.select(*GROUP, "lead", "ts_utc", F.col(Y).alias("actual_mw"), values.alias("_x")).join(fits, GROUP)
    forecast = F.col("intercept") + _product(F.col("weights"), F.col("_x"))
    return joined.select(*GROUP, "lead", "ts_utc", "actual_mw", forecast.alias("forecast_mw"))


def least_squares(split: DataFrame, features: Sequence[str]) -> DataFrame:
    """Least squares on any features over split windows: one aggregation of moments, combined where the rows lie, and a fold per group.

    No group passes through one task, so groups may be of any size.
    """
    terms = moments(features)
    trained = split.where("role = 'train'").select(*GROUP, *[v.alias(n) for n, v in terms.items()])
    sums = trained.groupBy(*GROUP).agg(*[F.sum(n).alias(n) for n in terms])
    return _forecast(split.where("role = 'test'"), fitted(sums, features), features)


def least_squares_by_sums(sums: DataFrame, dense: DataFrame, geometry: Geometry, features: Sequence[str]) -> DataFrame:
    """The same from stored running sums of `moments(features)`: no training row is copied."""
    fits = fitted(window_sums(sums, geometry, list(moments(features))), features)
    return _forecast(test_rows(dense, geometry), fits, features)
