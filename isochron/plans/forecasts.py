"""Registered queries: backtests, models, selection, views over forecasts, reports on forecasts.

Model queries run on the hourly panel of event types, the views and reports on the panel of regions.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isochron.fixed_values import FEATURE_LAGS, FEATURE_SPANS, MAX_WINDOWS, SEASON
from isochron.functions.regions import LABELS
from isochron.operators import backtest, models, panel, reports, star, trees, windows
from isochron.operators.backtest import Geometry
from isochron.operators.holidays import holiday_features
from isochron.plans import inputs, views
from isochron.plans.basics import SQL_RATING
from isochron.plans.registry import query
from isochron.plans.series import SQL_DIM_REGION, SQL_FILLED
from isochron.session import stored

KEY = ["region_clean"]
GEOMETRY = Geometry(train=240, step=168)
FEATURES = panel.feature_names()
REGION_MEASURES = ["consumption_mw", "solar_production_mw", "wind_production_mw"]


def _features(spark: SparkSession, sf: str) -> DataFrame:
    dense = inputs.dense_type_panel(spark, sf)
    return stored(panel.model_features(dense, KEY, exclude_current=True), "features")


def _split(spark: SparkSession, sf: str) -> DataFrame:
    return backtest.split_windows(_features(spark, sf), GEOMETRY)


def _filled(spark: SparkSession, sf: str) -> DataFrame:
    return stored(panel.fill_gaps(inputs.dense_type_panel(spark, sf), KEY, ["consumption_mw"]), "filled")


def _filled_split(spark: SparkSession, sf: str) -> DataFrame:
    """Split windows of the filled series alone, for models without features."""
    return backtest.split_windows(_filled(spark, sf), GEOMETRY)


_RAW_FEATURES = [f"consumption_lag_{k}" for k in FEATURE_LAGS] + [f"consumption_rolling_mean_{n}" for n in FEATURE_SPANS]


def _sql_filled(column: str) -> str:
    return (f"coalesce(last_value({column} IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
            f"first_value({column} IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS {column}")


def _sql_features(extra: list[str]) -> str:
    lags = [f"lag(consumption_mw, {k}) OVER w AS consumption_lag_{k}" for k in FEATURE_LAGS]
    means = [
        f"avg(consumption_mw) OVER (w ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) AS consumption_rolling_mean_{n}"
        for n in FEATURE_SPANS
    ]
    columns = ["consumption_mw", *extra, *_RAW_FEATURES]
    return f"""
history AS (SELECT *, {", ".join(lags + means)} FROM dense WINDOW w AS (PARTITION BY region_clean ORDER BY ts_utc)),
filled AS (
  SELECT region_clean, ts_utc, idx, n_rows, observed, {", ".join(map(_sql_filled, columns))},
         hour(ts_utc)::INT AS hour, (isodow(ts_utc) - 1)::INT AS dow, month(ts_utc)::INT AS month,
         sin(2 * pi() * hour(ts_utc) / 24) AS hour_sin, cos(2 * pi() * hour(ts_utc) / 24) AS hour_cos,
         sin(2 * pi() * (isodow(ts_utc) - 1) / 7) AS dow_sin, cos(2 * pi() * (isodow(ts_utc) - 1) / 7) AS dow_cos
  FROM history WINDOW w AS (PARTITION BY region_clean ORDER BY ts_utc))"""


def _sql_split(g: Geometry) -> str:
    last = g.max_windows if g.max_windows is not None else f"(SELECT max(n_rows) // {g.step} + 1 FROM filled)"
    return f"""
split AS (
  SELECT f.*, w.range::INT AS window, (idx - w.range * {g.step} - {g.train} + 1)::INT AS lead,
         CASE WHEN idx - w.range * {g.step} >= {g.train} THEN 'test' ELSE 'train' END AS role
  FROM filled f JOIN (SELECT unnest(range({last})) AS range) w
    ON idx >= w.range * {g.step} AND idx < w.range * {g.step} + {g.train + g.test}
    AND w.range * {g.step} + {g.train + g.test} <= n_rows),
train AS (SELECT *, consumption_mw AS y FROM split WHERE role = 'train'),
test AS (SELECT region_clean, "window", lead, ts_utc, consumption_mw AS actual_mw FROM split WHERE role = 'test')"""


SQL_SPLIT = _sql_split(GEOMETRY)
SQL_TYPES = f"{inputs.SQL_TYPE_PANEL}, {SQL_FILLED}, {SQL_SPLIT}"
SQL_TYPES_FEATURES = f"{inputs.SQL_TYPE_PANEL}, {_sql_features([])}, {SQL_SPLIT}"

# One SELECT per model: region_clean, window, lead, ts_utc, actual_mw, forecast_mw.
SQL_NAIVE = """
SELECT t.*, f.forecast_mw FROM test t JOIN (
  SELECT region_clean, "window", max_by(y, lead) AS forecast_mw FROM train GROUP BY 1, 2) f USING (region_clean, "window")"""
SQL_SEASONAL_NAIVE = """
SELECT t.*, r.y AS forecast_mw FROM test t JOIN train r
  ON r.region_clean = t.region_clean AND r.window = t.window AND r.lead = (t.lead - 1) % 24 - 23"""
SQL_MOVING_AVERAGE = """
SELECT t.*, f.forecast_mw FROM test t JOIN (
  SELECT region_clean, "window", avg(y) AS forecast_mw FROM train WHERE lead > -24 GROUP BY 1, 2) f USING (region_clean, "window")"""
SQL_SDIFF = """
SELECT t.*, r.y + ceil(t.lead / 24) * (l.y - s.y) AS forecast_mw FROM test t
JOIN train r ON r.region_clean = t.region_clean AND r.window = t.window AND r.lead = (t.lead - 1) % 24 - 23
JOIN train l ON l.region_clean = t.region_clean AND l.window = t.window AND l.lead = 0
JOIN train s ON s.region_clean = t.region_clean AND s.window = t.window AND s.lead = -24"""


def _sql_holt(alphas: list[float], betas: list[float]) -> str:
    """Recursive CTEs holt(region_clean, window, alpha, beta, lead, level, trend, sse) and best."""
    first = 1 - GEOMETRY.train
    return f"""
grid AS (SELECT a.a AS alpha, b.b AS beta FROM (SELECT unnest({alphas}::DOUBLE[]) AS a) a, (SELECT unnest({betas}::DOUBLE[]) AS b) b),
holt AS (
  SELECT t.region_clean, t.window, alpha, beta, t.lead, t.y AS level, n.y - t.y AS trend, 0.0::DOUBLE AS sse
  FROM train t JOIN train n ON n.region_clean = t.region_clean AND n.window = t.window AND n.lead = t.lead + 1, grid
  WHERE t.lead = {first}
  UNION ALL
  SELECT h.region_clean, h.window, alpha, beta, t.lead, h.level + h.trend + alpha * (t.y - (h.level + h.trend)),
         h.trend + beta * alpha * (t.y - (h.level + h.trend)), h.sse + (t.y - (h.level + h.trend)) * (t.y - (h.level + h.trend))
  FROM holt h JOIN train t ON t.region_clean = h.region_clean AND t.window = h.window AND t.lead = h.lead + 1),
best_holt AS (
  SELECT * FROM holt WHERE lead = 0
  QUALIFY row_number() OVER (PARTITION BY region_clean, "window" ORDER BY sse, alpha, beta) = 1)"""


def _sql_refined(rounds: int) -> str:
    """The same grid, then `rounds` grids of nine points around the best point so far."""
    parts, before = [], "best_holt"
    first = 1 - GEOMETRY.train
    for i, step in enumerate(models.refining_steps(rounds)):
        near = [(a * step, b * step) for a in (-1, 0, 1) for b in (-1, 0, 1)]
        offsets = ", ".join(f"({a!r}::DOUBLE, {b!r}::DOUBLE)" for a, b in near)
        parts.append(f"""
near{i} AS (
  SELECT region_clean, "window", least(greatest(alpha + a, {models.SMALLEST_WEIGHT}::DOUBLE), 1.0::DOUBLE) AS alpha, least(greatest(beta + b, 0.0::DOUBLE), 1.0::DOUBLE) AS beta
  FROM {before}, (VALUES {offsets}) o(a, b)),
holt{i} AS (
  SELECT t.region_clean, t.window, alpha, beta, t.lead, t.y AS level, n.y - t.y AS trend, 0.0::DOUBLE AS sse
  FROM train t JOIN train n ON n.region_clean = t.region_clean AND n.window = t.window AND n.lead = t.lead + 1
  JOIN near{i} p ON p.region_clean = t.region_clean AND p.window = t.window WHERE t.lead = {first}
  UNION ALL
  SELECT h.region_clean, h.window, alpha, beta, t.lead, h.level + h.trend + alpha * (t.y - (h.level + h.trend)),
         h.trend + beta * alpha * (t.y - (h.level + h.trend)), h.sse + (t.y - (h.level + h.trend)) * (t.y - (h.level + h.trend))
  FROM holt{i} h JOIN train t ON t.region_clean = h.region_clean AND t.window = h.window AND t.lead = h.lead + 1),
best_holt{i} AS (
  SELECT * FROM holt{i} WHERE lead = 0
  QUALIFY row_number() OVER (PARTITION BY region_clean, "window" ORDER BY sse, alpha, beta) = 1)""")
        before = f"best_holt{i}"
    return ",".join(parts)


REFINING_ROUNDS = 6
SQL_HOLT = """
SELECT t.*, h.level + t.lead * h.trend AS forecast_mw FROM test t
JOIN best_holt h ON h.region_clean = t.region_clean AND h.window = t.window"""
_GRID = [round(0.1 * i, 1) for i in range(1, 10)]
_SHOWN = ["actual_mw", "forecast_mw"]


def _shown(forecasts: DataFrame) -> DataFrame:
    return forecasts.select(*KEY, "window", "lead", "ts_utc", "actual_mw", "forecast_mw")


@query(f"""WITH {SQL_TYPES}
SELECT region_clean, ts_utc, "window", lead, role, horizon, consumption_mw FROM split
LEFT JOIN (SELECT unnest({GEOMETRY.horizons}) AS horizon) h ON role = 'test' AND horizon >= lead
""", rounded=["consumption_mw"])
def backtest_windows(spark: SparkSession, sf: str) -> DataFrame:
    split = _filled_split(spark, sf)
    tests = backtest.fan_out(split.where("role = 'test'"), GEOMETRY.horizons)
    both = split.where("role = 'train'").withColumn("horizon", F.lit(None).cast("int")).unionByName(tests)
    return both.select(*KEY, "ts_utc", "window", "lead", "role", "horizon", "consumption_mw")


COVERED = Geometry(train=240, step=168, min_coverage=0.8)


def _sql_covered(panel_sql: str, side: str) -> str:
    return f"""
SELECT * FROM (WITH {panel_sql}, {SQL_FILLED}, {_sql_split(COVERED)},
shares AS (SELECT region_clean, "window", avg(observed::INT) AS share FROM train GROUP BY 1, 2)
SELECT '{side}' AS side, region_clean, "window", share FROM shares WHERE share >= {COVERED.min_coverage})"""


@query(f"""{_sql_covered(inputs.SQL_TYPE_PANEL, "types")} UNION ALL {_sql_covered(inputs.sql_dense(
    f"SELECT {inputs.sql_pick(LABELS, 'user_id')} AS region_clean, date_trunc('hour', ts) AS ts_utc, avg(value) AS consumption_mw FROM events GROUP BY 1, 2"), "regions")}""",
       rounded=["share"])
def backtest_covered(spark: SparkSession, sf: str) -> DataFrame:
    """Windows of which four fifths of the training hours were observed, with that share."""
    regions = inputs.events(spark, sf).select(inputs.pick(LABELS, F.col("user_id")).alias("region_clean"), "ts", F.col("value").alias("consumption_mw"))
    sides = {"types": inputs.type_panel(spark, sf), "regions": stored(panel.mean_by_step(regions, KEY, "ts", ["consumption_mw"]), "regions-panel")}
    found = []
    for side, observed in sides.items():
        split = backtest.split_windows(panel.densify(observed, KEY), COVERED).where("role = 'train'")
        shares = split.groupBy(*KEY, "window").agg(F.avg(F.col("observed").cast("int")).alias("share"))
        found.append(shares.select(F.lit(side).alias("side"), *KEY, "window", "share"))
    return found[0].unionByName(found[1])


@query(f"""WITH {SQL_TYPES_FEATURES}
SELECT region_clean, "window", lead, ts_utc, {", ".join(FEATURES)} FROM split""",
       rounded=[*_RAW_FEATURES, "hour_sin", "hour_cos", "dow_sin", "dow_cos"])
def feature_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """The assembled vectors, taken apart again."""
    from pyspark.ml.functions import vector_to_array

    split = _split(spark, sf)
    whole = {"hour", "dow", "month"}
    values = vector_to_array("features")
    cells = [values[i + 1].cast("int" if f in whole else "double").alias(f) for i, f in enumerate(FEATURES)]
    return models.feature_matrix(split, FEATURES).select(*KEY, "window", "lead", "ts_utc", *cells)


@query(f"WITH {SQL_TYPES} {SQL_NAIVE}", rounded=_SHOWN)
def fc_naive(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(models.last_value_models(_filled_split(spark, sf)).where("model = 'baseline_naive'"))


@query(f"WITH {SQL_TYPES} {SQL_SEASONAL_NAIVE}", rounded=_SHOWN)
def fc_seasonal_naive(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(models.last_value_models(_filled_split(spark, sf)).where("model = 'baseline_seasonal_naive'"))


@query(f"WITH {SQL_TYPES} {SQL_MOVING_AVERAGE}", rounded=_SHOWN)
def fc_moving_average(spark: SparkSession, sf: str) -> DataFrame:
    """From differences of running sums."""
    filled = _filled(spark, sf)
    sums = stored(windows.running_sums(filled, {"consumption_mw": F.col("consumption_mw")}), "running-sums")
    return _shown(windows.moving_average(sums, filled, GEOMETRY, SEASON))


_STATS = ["mean", "variance", "covariance", "slope"]


@query(f"""WITH {SQL_TYPES_FEATURES}
SELECT region_clean, "window", count(*) AS train_rows, avg(y) AS mean, var_pop(y) AS variance,
       covar_pop(consumption_lag_24, y) AS covariance, coalesce(covar_pop(consumption_lag_24, y) / nullif(var_pop(consumption_lag_24), 0), 0) AS slope
FROM train GROUP BY 1, 2""", rounded=_STATS)
def fc_window_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Mean, variance, covariance with the day before and slope of each training window, from two rows of running sums."""
    terms = windows.moments(["consumption_lag_24"])
    sums = stored(windows.running_sums(_features(spark, sf), terms), "running-sums")
    found = windows.window_sums(sums, GEOMETRY, list(terms))
    n, mean_x, mean_y = F.col("s"), F.col("s0") / F.col("s"), F.col("s1") / F.col("s")
    covariance, spread = F.col("s0_1") / n - mean_x * mean_y, F.col("s0_0") / n - mean_x * mean_x
    return found.select(
        *KEY, "window", n.cast("bigint").alias("train_rows"), mean_y.alias("mean"), (F.col("s1_1") / n - mean_y * mean_y).alias("variance"),
        covariance.alias("covariance"), F.when(spread > 1e-9, covariance / spread).otherwise(F.lit(0.0)).alias("slope"),
    )


@query(f"WITH RECURSIVE {SQL_TYPES}, {_sql_holt([0.3], [0.1])} {SQL_HOLT}", rounded=_SHOWN)
def fc_holt(spark: SparkSession, sf: str) -> DataFrame:
    """Smoothing with given weights."""
    return _shown(models.smoothing(_filled_split(spark, sf), [0.3], [0.1]))


@query(f"""WITH RECURSIVE {SQL_TYPES}, {_sql_holt(_GRID, [0.0, *_GRID])}, {_sql_refined(REFINING_ROUNDS)}
{SQL_HOLT.replace("best_holt", f"best_holt{REFINING_ROUNDS - 1}")}""", rounded=_SHOWN)
def fc_holt_refined(spark: SparkSession, sf: str) -> DataFrame:
    """Smoothing with weights chosen on the grid and refined to four decimals."""
    return _shown(models.smoothing(_filled_split(spark, sf), rounds=REFINING_ROUNDS))


@query(f"""WITH RECURSIVE {SQL_TYPES}, {_sql_holt(_GRID, [0.0, *_GRID])}
SELECT *, 'baseline_naive' AS model FROM ({SQL_NAIVE}) UNION ALL SELECT *, 'baseline_seasonal_naive' FROM ({SQL_SEASONAL_NAIVE})
UNION ALL SELECT *, 'baseline_moving_average' FROM ({SQL_MOVING_AVERAGE})
UNION ALL SELECT *, 'baseline_exponential_smoothing' FROM ({SQL_HOLT})""", rounded=_SHOWN)
def fc_baselines(spark: SparkSession, sf: str) -> DataFrame:
    """All four baselines, the smoothing weights chosen on the grid."""
    return models.baselines(_filled_split(spark, sf)).drop("sarimax_baseline_used")


SQL_DAILY = inputs.sql_dense("""
  SELECT o_orderstatus AS region_clean, o_orderdate AS ts_utc, sum(o_totalprice) AS consumption_mw FROM orders GROUP BY 1, 2
""").replace("INTERVAL 1 HOUR", "INTERVAL 1 DAY")


def _sql_long_panel(geometry: Geometry) -> str:
    return f"""WITH {SQL_DAILY}, {SQL_FILLED}, {_sql_split(geometry)}
SELECT *, 'baseline_naive' AS model FROM ({SQL_NAIVE}) UNION ALL SELECT *, 'baseline_seasonal_naive' FROM ({SQL_SEASONAL_NAIVE})
UNION ALL SELECT *, 'baseline_moving_average' FROM ({SQL_MOVING_AVERAGE}) UNION ALL SELECT *, 'SARIMAX' FROM ({SQL_SDIFF})
"""


def _daily_dense(spark: SparkSession, sf: str) -> DataFrame:
    daily = inputs.table(spark, sf, "orders").groupBy(
        F.col("o_orderstatus").alias("region_clean"), F.col("o_orderdate").cast("timestamp").alias("ts_utc")
    ).agg(F.sum("o_totalprice").alias("consumption_mw"))
    return panel.densify(stored(daily, "daily-panel"), KEY, grain="day")


def _long_panel(spark: SparkSession, sf: str, geometry: Geometry) -> DataFrame:
    filled = stored(panel.fill_gaps(_daily_dense(spark, sf), KEY, ["consumption_mw"]), "filled")
    split = backtest.split_windows(filled, geometry)
    forecasts = models.last_value_models(split).unionByName(models.seasonal_difference_model(split))
    return forecasts.drop("sarimax_baseline_used")


@query(_sql_long_panel(Geometry()), rounded=_SHOWN)
def fc_long_panel(spark: SparkSession, sf: str) -> DataFrame:
    """The default geometry (1440 training rows, all windows that fit) on the daily order totals per status."""
    return _long_panel(spark, sf, Geometry())


@query(_sql_long_panel(Geometry(max_windows=MAX_WINDOWS)), rounded=_SHOWN)
def fc_long_panel_capped(spark: SparkSession, sf: str) -> DataFrame:
    """The same with the first five windows of each series only, as asked for by an argument."""
    return _long_panel(spark, sf, Geometry(max_windows=MAX_WINDOWS))


@query(f"""WITH {SQL_DAILY}
SELECT region_clean, ts_utc::TIMESTAMP AS ts_utc, idx, lag(consumption_mw, 2190) OVER w AS lag2190, avg(consumption_mw) OVER (w ROWS BETWEEN 364 PRECEDING AND CURRENT ROW) AS mean365
FROM dense WINDOW w AS (PARTITION BY region_clean ORDER BY ts_utc)""", rounded=["lag2190", "mean365"], digits=3)
def long_lag_features(spark: SparkSession, sf: str) -> DataFrame:
    """A lag of six years of days and a trailing year on the daily panel."""
    columns = panel.lag_columns("consumption_mw", [2190], "lag") | panel.rolling_columns("consumption_mw", [365], "mean")
    found = panel.with_history(_daily_dense(spark, sf), KEY, 2190, columns)
    return found.select("region_clean", "ts_utc", "idx", "lag2190", "mean365")


@query(f"WITH {SQL_TYPES} {SQL_SDIFF}", rounded=_SHOWN)
def fc_sdiff(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(models.seasonal_difference_model(_filled_split(spark, sf)))


@query(f"""WITH {SQL_TYPES},
diffs AS (SELECT region_clean, "window", lead, y - lag(y, 24) OVER (PARTITION BY region_clean, "window" ORDER BY lead) AS d FROM train),
pairs AS (SELECT *, lag(d) OVER (PARTITION BY region_clean, "window" ORDER BY lead) AS b FROM diffs),
fit AS (SELECT region_clean, "window", coalesce(sum(d * b) / nullif(sum(b * b), 0), 0) AS phi, max_by(d, lead) AS last_d FROM pairs GROUP BY 1, 2)
SELECT t.*, phi, r.y + last_d * list_sum([power(phi, (t.lead - 1) % 24 + 1 + 24 * i) for i in range(ceil(t.lead / 24)::INT)]) AS forecast_mw
FROM test t JOIN fit USING (region_clean, "window")
JOIN train r ON r.region_clean = t.region_clean AND r.window = t.window AND r.lead = (t.lead - 1) % 24 - 23
""", rounded=[*_SHOWN, "phi"])
def fc_sar1(spark: SparkSession, sf: str) -> DataFrame:
    return models.seasonal_ar1(_filled_split(spark, sf)).drop("model", "sarimax_baseline_used")


@query(f"""WITH {SQL_TYPES_FEATURES},
fit AS (SELECT region_clean, "window", regr_slope(y, consumption_lag_24) AS b, regr_intercept(y, consumption_lag_24) AS a FROM train GROUP BY 1, 2)
SELECT region_clean, "window", lead, ts_utc, consumption_mw AS actual_mw, a + b * consumption_lag_24 AS forecast_mw
FROM split JOIN fit USING (region_clean, "window") WHERE role = 'test'""", rounded=_SHOWN)
def fc_linear1(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(models.linear_one_feature(_split(spark, sf), "consumption_lag_24"))


@query()
def fc_linear(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(models.linear(_split(spark, sf), FEATURES))


_THREE = ["consumption_lag_1", "consumption_lag_24", "consumption_rolling_mean_12"]


def _sql_cramer(features: list[str], source: str = "train") -> str:
    """fit(region_clean, window, w0, w1, w2, intercept): least squares on three features by Cramer's rule."""
    cov = ", ".join(
        [f"covar_pop({a}, {b}) AS c{i}{j}" for i, a in enumerate(features) for j, b in enumerate(features) if i <= j]
        + [f"covar_pop({a}, y) AS b{i}" for i, a in enumerate(features)] + [f"avg({a}) AS m{i}" for i, a in enumerate(features)]
    )
    matrix = [["c00", "c01", "c02"], ["c01", "c11", "c12"], ["c02", "c12", "c22"]]

    def determinant(m: list[list[str]]) -> str:
        (a, b, c), (d, e, f), (g, h, i) = m
        return f"({a} * ({e} * {i} - {f} * {h}) - {b} * ({d} * {i} - {f} * {g}) + {c} * ({d} * {h} - {e} * {g}))"

    def replaced(k: int) -> list[list[str]]:
        return [[f"b{r}" if c == k else matrix[r][c] for c in range(3)] for r in range(3)]

    weights = ", ".join(f"{determinant(replaced(k))} / {determinant(matrix)} AS w{k}" for k in range(3))
    return f"""
moments AS (SELECT region_clean, "window", avg(y) AS level, {cov} FROM {source} GROUP BY 1, 2),
weighed AS (SELECT *, {weights} FROM moments),
fit AS (SELECT region_clean, "window", w0, w1, w2, level - w0 * m0 - w1 * m1 - w2 * m2 AS intercept FROM weighed)"""


SQL_LINEAR3 = f"""WITH {SQL_TYPES_FEATURES}, {_sql_cramer(_THREE)}
SELECT region_clean, "window", lead, ts_utc, consumption_mw AS actual_mw,
       intercept + w0 * {_THREE[0]} + w1 * {_THREE[1]} + w2 * {_THREE[2]} AS forecast_mw
FROM split JOIN fit USING (region_clean, "window") WHERE role = 'test'"""


@query(SQL_LINEAR3, rounded=_SHOWN)
def fc_linear3(spark: SparkSession, sf: str) -> DataFrame:
    """Least squares on three features: moments as one aggregation, solved by a fold."""
    return _shown(windows.least_squares(_split(spark, sf), _THREE))


@query(SQL_LINEAR3, rounded=_SHOWN)
def fc_linear3_sums(spark: SparkSession, sf: str) -> DataFrame:
    """The same from running sums, without copying training rows into windows."""
    features = _features(spark, sf)
    sums = stored(windows.running_sums(features, windows.moments(_THREE)), "running-sums")
    return _shown(windows.least_squares_by_sums(sums, features, GEOMETRY, _THREE))


_DISTANCE = " + ".join(f"(t.{f} - r.{f}) * (t.{f} - r.{f})" for f in FEATURES)


@query(f"""WITH {SQL_TYPES_FEATURES},
near AS (
  SELECT t.region_clean, t.window, t.lead, t.ts_utc, t.consumption_mw AS actual_mw, r.y,
         row_number() OVER (PARTITION BY t.region_clean, t.window, t.lead ORDER BY {_DISTANCE}, r.lead) AS place
  FROM split t JOIN train r ON r.region_clean = t.region_clean AND r.window = t.window WHERE t.role = 'test')
SELECT region_clean, "window", lead, ts_utc, actual_mw, avg(y) AS forecast_mw FROM near WHERE place <= 10 GROUP BY ALL
""", rounded=_SHOWN)
def fc_knn(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(models.knn(_split(spark, sf), FEATURES))


@query()
def fc_sar(spark: SparkSession, sf: str) -> DataFrame:
    """The chain of seasonal ARIMA orders with calendar columns as regressors."""
    exogenous = ["hour_sin", "hour_cos", "dow_sin", "dow_cos"]
    return models.arima(_split(spark, sf), exogenous).drop("model")


@query(f"""WITH {SQL_TYPES},
pairs AS (SELECT *, lag(y) OVER (PARTITION BY region_clean, "window" ORDER BY lead) AS b FROM train),
fit AS (SELECT region_clean, "window", sum(y * b) / nullif(sum(b * b), 0) AS phi, max_by(y, lead) AS last_y FROM pairs GROUP BY 1, 2)
SELECT region_clean, "window", lead, ts_utc, actual_mw, last_y * power(phi, lead) AS forecast_mw, 'autoregression' AS model FROM test JOIN fit USING (region_clean, "window")
UNION ALL SELECT region_clean, "window", lead, ts_utc, actual_mw, forecast_mw, 'seasonal difference' FROM ({SQL_SDIFF})""", rounded=_SHOWN)
def fc_sar_closed(spark: SparkSession, sf: str) -> DataFrame:
    """The fitted chain held to two orders with closed forms: a first autoregression, and the seasonal difference."""
    split = _filled_split(spark, sf)
    orders = {"autoregression": (1, 0, 0, 0, 0, 0), "seasonal difference": (0, 1, 0, 0, 1, 0)}
    found = [_shown(models.arima(split, orders=[order])).withColumn("model", F.lit(name)) for name, order in orders.items()]
    return found[0].unionByName(found[1])


_RESIDUAL_DISTANCE = " + ".join(f"(t.{f} - r.{f}) * (t.{f} - r.{f})" for f in _THREE)


SQL_RESIDUALS = """
fits AS (SELECT *, coalesce(lag(y, 1) OVER w + lag(y, 24) OVER w - lag(y, 25) OVER w, y) AS fitted
         FROM train WINDOW w AS (PARTITION BY region_clean, "window" ORDER BY lead)),
residuals AS (SELECT * REPLACE (y - fitted AS y) FROM fits)"""


@query(f"""WITH {SQL_TYPES_FEATURES}, {SQL_RESIDUALS}, {_sql_cramer(_THREE, "residuals")},
base AS ({SQL_SDIFF}),
near AS (
  SELECT t.region_clean, t.window, t.lead, r.y,
         row_number() OVER (PARTITION BY t.region_clean, t.window, t.lead ORDER BY {_RESIDUAL_DISTANCE}, r.lead) AS place
  FROM split t JOIN residuals r ON r.region_clean = t.region_clean AND r.window = t.window WHERE t.role = 'test'),
added AS (
  SELECT region_clean, "window", lead, intercept + w0 * {_THREE[0]} + w1 * {_THREE[1]} + w2 * {_THREE[2]} AS residual, 'SARIMAX_linear' AS model
  FROM split JOIN fit USING (region_clean, "window") WHERE role = 'test'
  UNION ALL SELECT region_clean, "window", lead, avg(y), 'SARIMAX_knn' FROM near WHERE place <= 10 GROUP BY 1, 2, 3
  UNION ALL SELECT region_clean, "window", lead, 0, 'SARIMAX' FROM test)
SELECT base.* REPLACE (base.forecast_mw + residual AS forecast_mw), model FROM base JOIN added USING (region_clean, "window", lead)""", rounded=_SHOWN)
def fc_hybrid_closed(spark: SparkSession, sf: str) -> DataFrame:
    """The one pass of all models held to the seasonal difference, with linear and nearest-neighbour models of its residuals."""
    found = models.run_models(_split(spark, sf), _THREE, ["linear", "knn"], orders=[(0, 1, 0, 0, 1, 0)])
    return found.drop("sarimax_baseline_used")


@query(f"""WITH {SQL_TYPES_FEATURES},
fits AS (SELECT *, coalesce(lag(y, 1) OVER w + lag(y, 24) OVER w - lag(y, 25) OVER w, y) AS fitted
         FROM train WINDOW w AS (PARTITION BY region_clean, "window" ORDER BY lead)),
line AS (SELECT region_clean, "window", regr_slope(y - fitted, consumption_rolling_mean_24) AS b,
                regr_intercept(y - fitted, consumption_rolling_mean_24) AS a FROM fits GROUP BY 1, 2),
base AS ({SQL_SDIFF})
SELECT region_clean, "window", lead, base.ts_utc, base.actual_mw, base.forecast_mw + a + b * s.consumption_rolling_mean_24 AS forecast_mw,
       'SARIMAX_linear' AS model, true AS sarimax_baseline_used
FROM base JOIN split s USING (region_clean, "window", lead) JOIN line USING (region_clean, "window")""", rounded=_SHOWN)
def fc_hybrid(spark: SparkSession, sf: str) -> DataFrame:
    """The seasonal difference with a linear model of its residuals."""
    split = _split(spark, sf)
    return models.hybrid(
        split, models.seasonal_difference_fits(split),
        lambda part: models.linear_one_feature(part, "consumption_rolling_mean_24"),
    )


@query()
def fc_hybrid_models(spark: SparkSession, sf: str) -> DataFrame:
    """The fitted ARIMA chain with linear and nearest-neighbour models of its residuals."""
    return models.run_models(_split(spark, sf), FEATURES, ["linear", "knn"]).where("model <> 'SARIMAX'")


@query()
def fc_forest(spark: SparkSession, sf: str) -> DataFrame:
    """100 trees of depth 15."""
    return _shown(models.forest(_split(spark, sf), FEATURES))


@query()
def fc_gbt(spark: SparkSession, sf: str) -> DataFrame:
    """100 rounds of depth 10."""
    return _shown(models.boosting(_split(spark, sf), FEATURES))


SQL_STUMP = """
levels AS (SELECT region_clean, "window", avg(y) AS series_level FROM train GROUP BY 1, 2),
cells AS (
  SELECT "window", f, v, sum(y) AS s, count(*) AS n FROM (
    SELECT "window", y, unnest(['series_level', 'hour']) AS f, unnest([series_level, hour::DOUBLE]) AS v
    FROM train JOIN levels USING (region_clean, "window")) GROUP BY 1, 2, 3),
cuts AS (
  SELECT "window", f, v, sum(s) OVER w AS s, sum(n) OVER w AS n, sum(s) OVER (PARTITION BY "window", f) AS all_s,
         sum(n) OVER (PARTITION BY "window", f) AS all_n FROM cells WINDOW w AS (PARTITION BY "window", f ORDER BY v)),
best_cut AS (
  SELECT * FROM cuts WHERE n < all_n
  QUALIFY row_number() OVER (PARTITION BY "window" ORDER BY s * s / n + (all_s - s) * (all_s - s) / (all_n - n) DESC, f, v) = 1),
stump AS (
  SELECT region_clean, "window", lead, ts_utc, consumption_mw AS actual_mw,
         CASE WHEN (CASE WHEN f = 'hour' THEN hour::DOUBLE ELSE series_level END) <= v THEN s / n ELSE (all_s - s) / (all_n - n) END AS forecast_mw
  FROM split JOIN levels USING (region_clean, "window") JOIN best_cut USING ("window") WHERE role = 'test')"""


@query(f"""WITH {SQL_TYPES_FEATURES}, {SQL_STUMP}
SELECT * FROM stump, (SELECT unnest(['random_forest', 'gradient_boosting']) AS model)""", rounded=_SHOWN)
def fc_tree_stump(spark: SparkSession, sf: str) -> DataFrame:
    """One split on the level of the series or the hour: a forest of one tree without sampling, and one step of boosting."""
    from pyspark.ml.regression import RandomForestRegressor

    split = _split(spark, sf)
    tree = RandomForestRegressor(numTrees=1, maxDepth=1, seed=42, featureSubsetStrategy="all", bootstrap=False)
    found = models.tree_model(split, ["hour"], tree, "random_forest").unionByName(models.boosting(split, ["hour"], trees=1, depth=1))
    return found.select(*KEY, "window", "lead", "ts_utc", "actual_mw", "forecast_mw", "model")


def _sql_series_stump(name: str, rows: str, target: str) -> str:
    """<name>(region_clean, window, f, v, low, high): the best single cut of a target over three features in each training window."""
    unpivoted = f"""SELECT region_clean, "window", {target} AS y, unnest({_THREE!r}) AS f, unnest([{", ".join(_THREE)}]) AS v FROM {rows}"""
    return f"""
{name}_cells AS (SELECT region_clean, "window", f, v, sum(y) AS s, count(*) AS n FROM ({unpivoted}) GROUP BY ALL),
{name}_cuts AS (
  SELECT *, sum(s) OVER w AS left_s, sum(n) OVER w AS left_n, sum(s) OVER g AS all_s, sum(n) OVER g AS all_n, lead(v) OVER w AS next_v
  FROM {name}_cells WINDOW w AS (PARTITION BY region_clean, "window", f ORDER BY v), g AS (PARTITION BY region_clean, "window", f)),
{name} AS (
  SELECT region_clean, "window", f, (v + next_v) / 2 AS v, left_s / left_n AS low, (all_s - left_s) / (all_n - left_n) AS high
  FROM {name}_cuts WHERE left_n < all_n
  QUALIFY row_number() OVER (PARTITION BY region_clean, "window"
                             ORDER BY left_s * left_s / left_n + (all_s - left_s) * (all_s - left_s) / (all_n - left_n) DESC, f, v) = 1)"""


def _sql_step(stump: str) -> str:
    value = " ".join(f"WHEN {stump}.f = '{f}' THEN {f}" for f in _THREE)
    return f"CASE WHEN (CASE {value} END) <= {stump}.v THEN {stump}.low ELSE {stump}.high END"


@query(f"""WITH {SQL_TYPES_FEATURES},
{_sql_series_stump("whole", "train", "y")},
centred AS (SELECT *, y - avg(y) OVER (PARTITION BY region_clean, "window") AS e FROM train),
{_sql_series_stump("one", "centred", "e")},
after_one AS (SELECT centred.*, e - 0.1 * {_sql_step("one")} AS e2 FROM centred JOIN one USING (region_clean, "window")),
{_sql_series_stump("two", "after_one", "e2")},
levels AS (SELECT region_clean, "window", avg(y) AS level FROM train GROUP BY 1, 2),
tests AS (SELECT * FROM split WHERE role = 'test')
SELECT region_clean, "window", lead, ts_utc, consumption_mw AS actual_mw, {_sql_step("whole")} AS forecast_mw, 'random_forest' AS model
FROM tests JOIN whole USING (region_clean, "window")
UNION ALL
SELECT region_clean, "window", lead, ts_utc, consumption_mw, level + 0.1 * {_sql_step("one")} + 0.1 * {_sql_step("two")}, 'gradient_boosting'
FROM tests JOIN levels USING (region_clean, "window") JOIN one USING (region_clean, "window") JOIN two USING (region_clean, "window")""", rounded=_SHOWN)
def fc_series_stumps(spark: SparkSession, sf: str) -> DataFrame:
    """The trees of single series at their smallest: one cut without drawing rows, and two rounds of boosting with one cut each."""
    split, found = _split(spark, sf), []
    for name, predict in {
        "random_forest": partial(trees.forest, trees=1, depth=1, bootstrap=False), "gradient_boosting": partial(trees.boosting, trees=2, depth=1),
    }.items():
        found.append(models.predicted(split, _THREE, predict).withColumn("model", F.lit(name)))
    return found[0].unionByName(found[1])


@query()
def fc_series_trees(spark: SparkSession, sf: str) -> DataFrame:
    """100 trees of depth 15 and 100 rounds of depth 10 for each series and window."""
    return models.run_models(_split(spark, sf), FEATURES, ["random_forest", "gradient_boosting"], orders=None)


# Regions: results of four models that SQL can check and of all models, selection, complete series, views, reports.

def _region_features(spark: SparkSession, sf: str) -> DataFrame:
    demand = inputs.region_demand(spark, sf).select(
        *KEY, "ts_utc", F.col("consommation_mw").alias("consumption_mw"), F.col("solaire_mw").alias("solar_production_mw"),
        F.col("eolien_mw").alias("wind_production_mw"),
    )
    dense = panel.densify(stored(demand, "region-panel"), KEY)
    features = panel.model_features(dense, KEY, exclude_current=True, extra=REGION_MEASURES[1:])
    return stored(features, "region-features")


def _results(features: DataFrame) -> DataFrame:
    split = backtest.split_windows(features, GEOMETRY)
    forecasts = models.last_value_models(split).unionByName(models.seasonal_difference_model(split))
    return stored(backtest.score(forecasts, GEOMETRY), "results")


def _complete(features: DataFrame, results: DataFrame) -> DataFrame:
    actual = features.drop("idx", "n_rows", "observed")
    return backtest.complete_series(actual, results)


def _published(complete: DataFrame) -> DataFrame:
    """The stored form: the clock as epoch nanoseconds."""
    return complete.withColumn("ts_utc", F.unix_micros("ts_utc") * 1000)


SQL_REGION_PANEL = inputs.sql_dense(f"""
  SELECT {inputs.sql_pick(LABELS, "user_id")} AS region_clean, date_trunc('hour', ts) AS ts_utc, sum(value) AS consumption_mw,
         sum(value) FILTER (event_type = 'view') AS solar_production_mw, sum(value) FILTER (event_type = 'click') AS wind_production_mw
  FROM events GROUP BY 1, 2""", ", ".join(f"p.{m}" for m in REGION_MEASURES))
SQL_RESULTS = f"""
{SQL_REGION_PANEL}, {_sql_features(REGION_MEASURES[1:])}, {SQL_SPLIT},
forecasts AS (
  SELECT *, 'baseline_naive' AS model, false AS sarimax_baseline_used FROM ({SQL_NAIVE})
  UNION ALL SELECT *, 'baseline_seasonal_naive', false FROM ({SQL_SEASONAL_NAIVE})
  UNION ALL SELECT *, 'baseline_moving_average', false FROM ({SQL_MOVING_AVERAGE})
  UNION ALL SELECT *, 'SARIMAX', true FROM ({SQL_SDIFF})),
bounds AS (SELECT region_clean, "window", min(ts_utc) AS train_start, max(ts_utc) AS train_end FROM train GROUP BY 1, 2),
results AS (
  SELECT region_clean AS region, model, 'sliding' AS validation_type, horizon::INT AS horizon, "window", ts_utc, forecast_mw, actual_mw,
         train_start, train_end, ts_utc - INTERVAL 1 HOUR * (horizon - 1) AS test_start, ts_utc AS test_end,
         abs(actual_mw - forecast_mw) AS mae, sqrt((actual_mw - forecast_mw) * (actual_mw - forecast_mw)) AS rmse, NULL::DOUBLE AS r2,
         sarimax_baseline_used, starts_with(model, 'baseline_') AS is_baseline, region_clean, lead
  FROM forecasts JOIN bounds USING (region_clean, "window")
  JOIN (SELECT unnest({GEOMETRY.horizons}) AS horizon) h ON horizon >= lead),
per_model AS (SELECT region_clean, horizon, model, avg(mae) AS mae, avg(rmse) AS rmse, count(*) AS forecasts FROM results GROUP BY 1, 2, 3),
best AS (SELECT * FROM per_model QUALIFY row_number() OVER (PARTITION BY region_clean, horizon ORDER BY round(mae, 9), model) = 1),
complete AS (
  SELECT region_clean, ts_utc, {", ".join(REGION_MEASURES)}, {", ".join(FEATURES)}, 'actual' AS data_type, 0 AS forecast_horizon, 'actual' AS model,
         consumption_mw AS forecast_mw, NULL::DOUBLE AS mae, NULL::DOUBLE AS rmse, NULL::DOUBLE AS r2 FROM filled
  UNION ALL BY NAME
  SELECT r.region_clean, r.ts_utc, 'forecast' AS data_type, r.horizon AS forecast_horizon, r.model, r.forecast_mw, r.mae, r.rmse, r.r2
  FROM results r JOIN best b ON b.region_clean = r.region_clean AND b.horizon = r.horizon AND b.model = r.model),
long_fact AS (SELECT * FROM complete WHERE data_type = 'forecast' AND forecast_horizon >= 24),
short_fact AS (SELECT * FROM complete WHERE data_type = 'forecast' AND forecast_horizon < 24),
last_actual AS (SELECT region_clean, max(ts_utc) AS last_actual_ts FROM complete WHERE data_type = 'actual' GROUP BY 1)"""


@query(f"WITH {SQL_RESULTS} SELECT * FROM results", rounded=["forecast_mw", "actual_mw", "mae", "rmse"])
def forecast_results(spark: SparkSession, sf: str) -> DataFrame:
    return _results(_region_features(spark, sf))


@query()
def forecast_results_all(spark: SparkSession, sf: str) -> DataFrame:
    """Results of every model: all baselines, the ARIMA chain, and each model of the registry on its residuals (or direct where none fitted)."""
    return _all_results(_region_features(spark, sf))


def _all_results(features: DataFrame) -> DataFrame:
    measures = REGION_MEASURES[1:]
    split = backtest.split_windows(features, GEOMETRY)
    modelled = models.run_models(split, [*measures, *FEATURES], tuple(models.REGISTRY), measures)
    forecasts = stored(models.baselines(split).unionByName(modelled), "all-forecasts")
    return backtest.score(forecasts, GEOMETRY)


@query(f"WITH {SQL_RESULTS} SELECT region_clean, horizon, model, mae, rmse, forecasts FROM best", rounded=["mae", "rmse"])
def best_model_mae(spark: SparkSession, sf: str) -> DataFrame:
    return backtest.best_by_error(_results(_region_features(spark, sf)))


_COMPLETE = [*REGION_MEASURES, *_RAW_FEATURES, "hour_sin", "hour_cos", "dow_sin", "dow_cos", "forecast_mw"]


@query(f"WITH {SQL_RESULTS} SELECT * FROM complete", rounded=[*_COMPLETE, "mae", "rmse"])
def complete_series(spark: SparkSession, sf: str) -> DataFrame:
    features = _region_features(spark, sf)
    return _complete(features, _results(features))


@query(f"""WITH {SQL_RESULTS}
SELECT 'long' AS side, region_clean, ts_utc, forecast_horizon, model, forecast_mw FROM long_fact
UNION ALL SELECT 'short', region_clean, ts_utc, forecast_horizon, model, forecast_mw FROM short_fact""", rounded=["forecast_mw"])
def split_horizon(spark: SparkSession, sf: str) -> DataFrame:
    features = _region_features(spark, sf)
    long, short = backtest.split_horizons(_complete(features, _results(features)))
    columns = [*KEY, "ts_utc", "forecast_horizon", "model", "forecast_mw"]
    return long.select(F.lit("long").alias("side"), *columns).unionByName(short.select(F.lit("short").alias("side"), *columns))


@query(f"""WITH {SQL_RESULTS},
counts AS (SELECT region_clean, count(*) AS forecast_count FROM complete WHERE data_type = 'forecast' GROUP BY 1)
SELECT d.region_clean, count(*) AS total_records, min(ts_utc) AS data_start, max(ts_utc) AS data_end,
       count(*) FILTER (consumption_mw IS NULL) AS missing_values, count(*) FILTER (consumption_mw = 0) AS zero_values,
       avg(consumption_mw) AS avg_consumption, max(consumption_mw) AS max_consumption, min(consumption_mw) AS min_consumption,
       (1 - count(*) FILTER (consumption_mw IS NULL) / count(*)) * 100 AS data_completeness,
       coalesce(any_value(forecast_count), 0) AS forecast_count
FROM dense d LEFT JOIN counts USING (region_clean) GROUP BY 1""",
       rounded=["avg_consumption", "max_consumption", "min_consumption", "data_completeness"])
def data_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Quality of the dense panel before filling, with the number of forecasts."""
    demand = inputs.region_demand(spark, sf).select(*KEY, "ts_utc", F.col("consommation_mw").alias("consumption_mw"))
    dense = panel.densify(stored(demand, "region-panel"), KEY)
    features = _region_features(spark, sf)
    return reports.data_quality(dense, _complete(features, _results(features)))


@query(f"""WITH {SQL_RESULTS},
cells AS (
  SELECT model, region_clean, "window", horizon, count(*) AS n, sum(mae) AS abs_sum, sum(rmse * rmse) AS sse,
         var_pop(actual_mw) * count(*) AS sst, count(*) FILTER (sarimax_baseline_used) AS hybrid FROM results GROUP BY 1, 2, 3, 4)
SELECT model, sum(n)::BIGINT AS forecasts, sum(abs_sum) / sum(n) AS avg_mae,
       avg(CASE WHEN n > 1 AND sst > 1e-9 THEN 1 - sse / sst END) AS avg_r2, sum(hybrid)::BIGINT AS hybrid_forecasts
FROM cells GROUP BY 1""", rounded=["avg_mae", "avg_r2"])
def model_performance(spark: SparkSession, sf: str) -> DataFrame:
    return reports.model_performance(_results(_region_features(spark, sf)))


@query(f"WITH {SQL_RESULTS} SELECT * FROM last_actual")
def last_actual(spark: SparkSession, sf: str) -> DataFrame:
    features = _region_features(spark, sf)
    return views.last_actual(_published(_complete(features, _results(features))))


SQL_BEST_LONG = """
best_long AS (
  SELECT region_clean, forecast_horizon, model, forecast_mw, mae, rmse FROM long_fact WHERE rmse IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY region_clean, forecast_horizon ORDER BY round(rmse, 9), round(mae, 9), model, ts_utc, forecast_mw) = 1)"""
SQL_BEST_SHORT = """
counted AS (
  SELECT region_clean, forecast_horizon, model, count(*) AS forecast_count, avg(mae) AS avg_mae, avg(rmse) AS avg_rmse,
         avg(forecast_mw) AS avg_forecast_mw FROM short_fact GROUP BY 1, 2, 3),
best_short AS (
  SELECT * FROM counted QUALIFY row_number() OVER (PARTITION BY region_clean, forecast_horizon ORDER BY forecast_count DESC, model) = 1)"""


@query(f"""WITH {SQL_RESULTS}, {SQL_BEST_LONG}, {SQL_BEST_SHORT}
SELECT 'error' AS rule, region_clean, forecast_horizon, model, forecast_mw FROM best_long
UNION ALL SELECT 'count', region_clean, forecast_horizon, model, avg_forecast_mw FROM best_short""", rounded=["forecast_mw"])
def best_model_rank(spark: SparkSession, sf: str) -> DataFrame:
    features = _region_features(spark, sf)
    long, short = backtest.split_horizons(_complete(features, _results(features)))
    columns = [*KEY, "forecast_horizon", "model"]
    by_error = views.rank_models_by_error(long).select(F.lit("error").alias("rule"), *columns, "forecast_mw")
    by_count = views.rank_models_by_count(short)
    return by_error.unionByName(
        by_count.select(F.lit("count").alias("rule"), *columns, F.col("avg_forecast_mw").alias("forecast_mw"))
    )


def _february_holidays(spark: SparkSession, sf: str) -> DataFrame:
    """Holidays of the days after the last event: January rows moved on by thirty days."""
    rows = inputs.january_holidays(spark, sf)
    moved = F.date_format(F.date_add(F.to_date("date"), 30), "yyyy-MM-dd")
    return stored(star.dim_holiday(holiday_features(rows.withColumn("date", moved))), "dim-holiday")


def _view_inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    """(long fact, short fact, complete series, regions, holidays) as the views read them."""
    features = _region_features(spark, sf)
    complete = stored(_published(_complete(features, _results(features))), "complete")
    long, short = backtest.split_horizons(complete)
    return long, short, complete, star.dim_region(features), _february_holidays(spark, sf)


SQL_FEBRUARY_HOLIDAYS = inputs.SQL_JANUARY_HOLIDAYS.replace("holiday_rows AS (\n  SELECT DISTINCT make_date(2024, 1, day(date_paris))",
                                                            "holiday_rows AS (\n  SELECT DISTINCT make_date(2024, 1, day(date_paris)) + 30")
SQL_VIEWS = f"""{SQL_RESULTS}, {SQL_BEST_LONG}, {SQL_BEST_SHORT},
demand AS (SELECT DISTINCT region_clean FROM panel), {SQL_DIM_REGION}, {SQL_FEBRUARY_HOLIDAYS}, {inputs.SQL_HOLIDAYS},
view_long AS (
  SELECT l.last_actual_ts + INTERVAL 1 HOUR * b.forecast_horizon AS forecast_timestamp, b.region_clean, 'forecast' AS data_type,
         b.forecast_horizon, b.model, b.forecast_mw, b.mae, b.rmse, region_canon, cap_lat, cap_lon
  FROM best_long b JOIN last_actual l USING (region_clean) JOIN dim_region d USING (region_clean) WHERE forecast_horizon >= 24),
view_short AS (
  SELECT l.last_actual_ts + INTERVAL 1 HOUR * b.forecast_horizon AS forecast_timestamp, b.region_clean, 'forecast' AS data_type,
         b.forecast_horizon, b.model, avg_mae, avg_rmse, avg_forecast_mw, region_canon, cap_lat, cap_lon
  FROM best_short b JOIN last_actual l USING (region_clean) JOIN dim_region d USING (region_clean))"""
SQL_MARKS = "coalesce(h.holiday_name, 'No Holiday') AS holiday_name, coalesce(h.is_national_holiday, 0) AS is_national_holiday"


@query(f"""WITH {SQL_VIEWS}
SELECT v.*, hour(forecast_timestamp)::INT AS forecast_hour, isodow(forecast_timestamp)::INT AS forecast_dow, {SQL_MARKS},
       coalesce(h.holiday_season, 'regular') AS holiday_season
FROM view_long v LEFT JOIN one_holiday h ON h.date_paris = forecast_timestamp::DATE""", rounded=["forecast_mw", "mae", "rmse"])
def view_best_longhorizon(spark: SparkSession, sf: str) -> DataFrame:
    long, _, complete, regions, holidays = _view_inputs(spark, sf)
    return views.best_long_horizon(long, complete, regions, holidays)


@query(f"""WITH {SQL_VIEWS}
SELECT v.*, {SQL_MARKS} FROM view_short v LEFT JOIN one_holiday h ON h.date_paris = forecast_timestamp::DATE
""", rounded=["avg_mae", "avg_rmse", "avg_forecast_mw"])
def view_best_shorthorizon(spark: SparkSession, sf: str) -> DataFrame:
    _, short, complete, regions, holidays = _view_inputs(spark, sf)
    return views.best_short_horizon(short, complete, regions, holidays)


@query(f"""WITH {SQL_VIEWS},
both_views AS (
  SELECT 'intraday' AS forecast_type, forecast_timestamp, region_clean, region_canon, forecast_horizon, model, avg_forecast_mw,
         NULL::DOUBLE AS mae, NULL::DOUBLE AS rmse FROM view_short
  UNION ALL SELECT 'dayahead', forecast_timestamp, region_clean, region_canon, forecast_horizon, model, forecast_mw, mae, rmse FROM view_long)
SELECT v.*, {SQL_MARKS}, hour(forecast_timestamp)::INT AS forecast_hour, isodow(forecast_timestamp)::INT AS forecast_dow,
       month(forecast_timestamp)::INT AS forecast_month, {SQL_RATING.format("rmse")} AS performance_rating
FROM both_views v LEFT JOIN one_holiday h ON h.date_paris = forecast_timestamp::DATE""", rounded=["avg_forecast_mw", "mae", "rmse"])
def view_best_overview(spark: SparkSession, sf: str) -> DataFrame:
    long, short, complete, regions, holidays = _view_inputs(spark, sf)
    return views.best_overview(
        views.best_short_horizon(short, complete, regions, holidays),
        views.best_long_horizon(long, complete, regions, holidays),
    )


@query(f"WITH {SQL_RESULTS} SELECT ts_utc AS ts_utc_timestamp, * EXCLUDE (ts_utc, mae, rmse, r2) FROM complete", rounded=_COMPLETE)
def view_series_normalized(spark: SparkSession, sf: str) -> DataFrame:
    features = _region_features(spark, sf)
    return views.series_normalized(_published(_complete(features, _results(features))))
