"""Forecasting queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import functions as F

from tidecast.catalog.common import (
    AHEAD,
    DAILY_SQL,
    LEVELS,
    MONTHLY_SQL,
    NATIONS_SQL,
    WEEKLY_SQL,
    Z,
    daily_events,
    daily_nations,
    forecast_sql,
    monthly_orders,
    quantiles_sql,
    rounded,
    weekly_supply,
)
from tidecast.operators.baseline import BASELINES, as_forecast_table, backtest_rows, baseline_forecast, forecast_rows, item_statistics
from tidecast.operators.columns import ITEM, STAMP
from tidecast.operators.lagreg import LagRegression
from tidecast.operators.leaderboard import rank_models, score_forecasts, score_rows, weighted_ensemble
from tidecast.operators.series import holdout_split, last_steps
from tidecast.operators.smoothing import HOLT_GRID, SES_GRID
from tidecast.plans.forecast import ForecastEstimator, forecast

QUERIES: dict = {}
SQL: dict[str, str] = {}


def _one_model(name: str, model: str, build, freq: str, horizon: int, season: int, source_sql: str) -> None:
    def run(spark, sf_dir):
        return rounded(
            forecast(build(spark, sf_dir), horizon, quantile_levels=LEVELS, model=model, freq=freq)
        )

    QUERIES[name] = run
    SQL[name] = f"""
    WITH s AS ({source_sql}), {forecast_sql("s", horizon, season, freq, [model])}
    SELECT item_id, ts AS "timestamp", round(mean, 4) AS mean, {quantiles_sql()} FROM fc"""


for _model in BASELINES:
    _one_model(f"fc_{_model}", _model, daily_events, "D", 7, 7, DAILY_SQL)
_one_model("fc_weekly_seasonal_naive", "seasonal_naive", weekly_supply, "W-MON", 13, 52, WEEKLY_SQL)
_one_model("fc_weekly_drift", "drift", weekly_supply, "W-MON", 13, 52, WEEKLY_SQL)
# Long histories with a long horizon.
_one_model("fc_nations_seasonal_naive", "seasonal_naive", daily_nations, "D", 64, 7, NATIONS_SQL)
_one_model("fc_monthly_trend", "trend", monthly_orders, "MS", 6, 12, MONTHLY_SQL)


# -- backtest, metrics, leaderboard -------------------------------------------------------

_METRICS = ("MAE", "MSE", "RMSE", "MAPE", "SMAPE", "WAPE", "MASE", "WQL")


def fc_backtest_metrics(spark, sf_dir):
    marked = last_steps(weekly_supply(spark, sf_dir), 13, "W-MON")
    return rounded(score_rows(backtest_rows(marked, 13, "W-MON", 52, BASELINES, scale=True), _METRICS, LEVELS))


_PINBALL = " + ".join(
    f"greatest({q} * (a.y - (mean + {z} * coalesce(sigma, 0))), ({q} - 1) * (a.y - (mean + {z} * coalesce(sigma, 0))))"
    for q, z in Z.items()
)
_SPLIT = f"""
    s0 AS ({WEEKLY_SQL}),
    marked AS (SELECT *, k > max(k) OVER (PARTITION BY item_id) - 13 AS held FROM s0),
    s AS (SELECT item_id, ts, k, y FROM marked WHERE NOT held),
    a AS (SELECT item_id, ts, y FROM marked WHERE held)"""
SQL["fc_backtest_metrics"] = f"""
    WITH {_SPLIT}, {forecast_sql("s", 13, 52, "W-MON", BASELINES, ", scale_abs")}
    SELECT model, round(avg(abs(a.y - mean)), 4) AS mae, round(avg((a.y - mean) ** 2), 4) AS mse,
           round(sqrt(avg((a.y - mean) ** 2)), 4) AS rmse,
           round(avg(CASE WHEN a.y <> 0 THEN abs((a.y - mean) / a.y) END), 4) AS mape,
           round(avg(2 * abs(a.y - mean) / nullif(abs(a.y) + abs(mean), 0)), 4) AS smape,
           round(sum(abs(a.y - mean)) / sum(abs(a.y)), 4) AS wape,
           round(avg(CASE WHEN scale_abs > 0 THEN abs(a.y - mean) / scale_abs END), 4) AS mase,
           round(2 * sum({_PINBALL}) / (3 * sum(abs(a.y))), 4) AS wql
    FROM fc JOIN a USING (item_id, ts) GROUP BY model"""
QUERIES["fc_backtest_metrics"] = fc_backtest_metrics


def fc_leaderboard(spark, sf_dir):
    errors = score_rows(backtest_rows(last_steps(daily_events(spark, sf_dir), 7, "D"), 7, "D", 7), ["MAE"])
    board = errors.select("model", (-F.round("mae", 4)).alias("score_val"), F.lit("MAE").alias("eval_metric"))
    return rank_models(board)


_DAILY_SPLIT = f"""
    s0 AS ({DAILY_SQL}),
    marked AS (SELECT *, k > max(k) OVER (PARTITION BY item_id) - 7 AS held FROM s0),
    s AS (SELECT item_id, ts, k, y FROM marked WHERE NOT held),
    a AS (SELECT item_id, ts, y FROM marked WHERE held)"""
QUERIES["fc_leaderboard"] = fc_leaderboard
SQL["fc_leaderboard"] = f"""
    WITH {_DAILY_SPLIT}, {forecast_sql("s", 7, 7, "D", BASELINES)}
    SELECT model, -round(avg(abs(a.y - mean)), 4) AS score_val, 'MAE' AS eval_metric
    FROM fc JOIN a USING (item_id, ts) GROUP BY model ORDER BY score_val DESC, model"""


def fc_fit_predict(spark, sf_dir):
    """Backtest all baselines, keep the best by MAE, forecast beyond the end."""
    estimator = ForecastEstimator(prediction_length=7, freq="D", eval_metric="MAE", quantile_levels=LEVELS)
    return rounded(estimator.fit_predict(daily_events(spark, sf_dir), hyperparameters=list(BASELINES)))


def _prefixed(cte_text: str, prefix: str) -> str:
    for name in ("lagged", "st", "ph", "ahead", "fc"):
        cte_text = cte_text.replace(f"    {name} AS (", f"    {prefix}{name} AS (")
        cte_text = cte_text.replace(f"FROM {name} ", f"FROM {prefix}{name} ").replace(f"FROM {name})", f"FROM {prefix}{name})")
        cte_text = cte_text.replace(f"JOIN {name} ON", f"JOIN {prefix}{name} {name} ON").replace(
            f"FROM {name},", f"FROM {prefix}{name} {name},"
        )
    return cte_text


QUERIES["fc_fit_predict"] = fc_fit_predict
SQL["fc_fit_predict"] = f"""
    WITH {_DAILY_SPLIT}, {forecast_sql("s", 7, 7, "D", BASELINES)},
    best AS (SELECT model FROM fc JOIN a USING (item_id, ts) GROUP BY model ORDER BY avg(abs(a.y - mean)), model LIMIT 1),
    {_prefixed(forecast_sql("s0", 7, 7, "D", BASELINES), "full_")}
    SELECT item_id, ts AS "timestamp", round(mean, 4) AS mean, {quantiles_sql()}
    FROM full_fc WHERE model = (SELECT model FROM best)"""


def fc_ensemble(spark, sf_dir):
    rows = baseline_forecast(daily_events(spark, sf_dir), 7, "D", 7, ["seasonal_naive", "drift", "mean"])
    return rounded(as_forecast_table(weighted_ensemble(rows, {"seasonal_naive": 0.5, "drift": 0.2, "mean": 0.3}), LEVELS))


QUERIES["fc_ensemble"] = fc_ensemble
SQL["fc_ensemble"] = f"""
    WITH s AS ({DAILY_SQL}), {forecast_sql("s", 7, 7, "D", ["seasonal_naive", "drift", "mean"])},
    w AS (SELECT item_id, ts, sum(w * mean) AS mean, sum(w * sigma) AS sigma
          FROM (SELECT *, CASE model WHEN 'seasonal_naive' THEN 0.5 WHEN 'drift' THEN 0.2 ELSE 0.3 END AS w FROM fc)
          GROUP BY ALL)
    SELECT item_id, ts AS "timestamp", round(mean, 4) AS mean, {quantiles_sql()} FROM w"""


# -- fitted forecasters -------------------------------------------------------------------


def _smooth(model: str):
    def run(spark, sf_dir):
        series = monthly_orders(spark, sf_dir)
        return rounded(forecast(series, 6, quantile_levels=LEVELS, model=model, freq="MS"), 2)

    return run


QUERIES["fc_ses"] = _smooth("ses")
QUERIES["fc_holt"] = _smooth("holt")

# State before a step is a * x + b in the unknown start x; s0, s1, s2 are the squared error
# as a quadratic in x. One recursion per item and grid point.
SQL["fc_ses"] = f"""
    WITH RECURSIVE s AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY k) AS i FROM ({MONTHLY_SQL})),
    grid AS (SELECT unnest([{", ".join(map(str, SES_GRID))}])::DOUBLE AS alpha),
    fold AS (
        SELECT item_id, alpha, 0::BIGINT AS i, 1.0::DOUBLE AS a, 0.0::DOUBLE AS b,
               0.0::DOUBLE AS s0, 0.0::DOUBLE AS s1, 0.0::DOUBLE AS s2
        FROM (SELECT DISTINCT item_id FROM s), grid
        UNION ALL
        SELECT f.item_id, alpha, s.i, a * (1 - alpha), b + alpha * (y - b),
               s0 + (y - b) ** 2, s1 + (y - b) * a, s2 + a * a
        FROM fold f JOIN s ON s.item_id = f.item_id AND s.i = f.i + 1),
    ends AS (SELECT item_id, max(i) AS n, max(ts) AS last_ts FROM s GROUP BY item_id),
    fitted AS (SELECT f.item_id, alpha, n, last_ts, greatest(s0 - s1 * s1 / s2, 0) AS sse, a * s1 / s2 + b AS mean
               FROM fold f JOIN ends e ON e.item_id = f.item_id AND e.n = f.i),
    best AS (SELECT * FROM fitted QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY round(sse, 6), alpha) = 1),
    fc AS (SELECT item_id, {AHEAD["MS"]} AS ts, mean, sqrt(sse / n * (1 + (h - 1) * alpha * alpha)) AS sigma
           FROM best, (SELECT unnest(range(1, 7)) AS h))
    SELECT item_id, ts AS "timestamp", round(mean, 2) AS mean, {quantiles_sql(2)} FROM fc"""

_HOLT = ", ".join(f"({a}::DOUBLE, {a * s}::DOUBLE, {i})" for i, (a, s) in enumerate(HOLT_GRID))


def _holt_sql(source: str, freq: str, horizon: int) -> str:
    """Holt smoothing as one recursion per item and grid point; unobserved steps only add trend."""
    return f"""
    WITH RECURSIVE s AS (
        SELECT *, row_number() OVER w AS i, coalesce(k - lag(k) OVER w, 1) AS g FROM ({source})
        WINDOW w AS (PARTITION BY item_id ORDER BY k)),
    grid(alpha, beta, p) AS (VALUES {_HOLT}),
    fold AS (
        SELECT item_id, alpha, beta, p, 0::BIGINT AS i,
               1.0::DOUBLE AS l1, 0.0::DOUBLE AS l2, 0.0::DOUBLE AS lb,
               0.0::DOUBLE AS t1, 1.0::DOUBLE AS t2, 0.0::DOUBLE AS tb,
               0.0::DOUBLE AS s0, 0.0::DOUBLE AS p1, 0.0::DOUBLE AS p2,
               0.0::DOUBLE AS q11, 0.0::DOUBLE AS q12, 0.0::DOUBLE AS q22
        FROM (SELECT DISTINCT item_id FROM s), grid
        UNION ALL
        SELECT f.item_id, alpha, beta, p, s.i,
               (l1 + g * t1) * (1 - alpha), (l2 + g * t2) * (1 - alpha), lb + g * tb + alpha * (y - lb - g * tb),
               t1 - beta * (l1 + g * t1), t2 - beta * (l2 + g * t2), tb + beta * (y - lb - g * tb),
               s0 + (y - lb - g * tb) ** 2, p1 + (y - lb - g * tb) * (l1 + g * t1), p2 + (y - lb - g * tb) * (l2 + g * t2),
               q11 + (l1 + g * t1) ** 2, q12 + (l1 + g * t1) * (l2 + g * t2), q22 + (l2 + g * t2) ** 2
        FROM fold f JOIN s ON s.item_id = f.item_id AND s.i = f.i + 1),
    ends AS (SELECT item_id, max(i) AS n, max(ts) AS last_ts FROM s GROUP BY item_id),
    solved AS (SELECT f.*, n, last_ts, (q22 * p1 - q12 * p2) / (q11 * q22 - q12 * q12) AS x1,
                      (q11 * p2 - q12 * p1) / (q11 * q22 - q12 * q12) AS x2
               FROM fold f JOIN ends e ON e.item_id = f.item_id AND e.n = f.i),
    fitted AS (SELECT *, s0 - p1 * x1 - p2 * x2 AS sse, l1 * x1 + l2 * x2 + lb AS level,
                      t1 * x1 + t2 * x2 + tb AS trend FROM solved),
    best AS (SELECT * FROM fitted QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY round(sse, 6), p) = 1),
    fc AS (SELECT item_id, {AHEAD[freq]} AS ts, level + h * trend AS mean,
                  sqrt(sse / n * (1 + (h - 1) * (alpha * alpha + alpha * beta * h + beta * beta * h * (2 * h - 1) / 6)))
                  AS sigma
           FROM best, (SELECT unnest(range(1, {horizon + 1})) AS h))
    SELECT item_id, ts AS "timestamp", round(mean, 2) AS mean, {quantiles_sql(2)} FROM fc"""


SQL["fc_holt"] = _holt_sql(MONTHLY_SQL, "MS", 6)
SQL["fc_smooth_weekly"] = _holt_sql(WEEKLY_SQL, "W-MON", 13)


def fc_smooth_weekly(spark, sf_dir):
    """Holt smoothing of every supplier's weekly series (gaps included)."""
    return rounded(forecast(weekly_supply(spark, sf_dir), 13, quantile_levels=LEVELS, model="holt", freq="W-MON"), 2)


QUERIES["fc_smooth_weekly"] = fc_smooth_weekly


def fc_lag_regression(spark, sf_dir):
    """One regression on the value 7 days earlier, shared by all items."""
    series = daily_events(spark, sf_dir)
    model = LagRegression(7, "D", 7, lags=[7], calendar=False).fit(series)
    return rounded(as_forecast_table(model.predict(series), LEVELS), 3)


QUERIES["fc_lag_regression"] = fc_lag_regression
SQL["fc_lag_regression"] = f"""
    WITH s AS ({DAILY_SQL}),
    pairs AS (SELECT a.item_id, a.k, a.y, b.y AS x FROM s a JOIN s b ON b.item_id = a.item_id AND b.k = a.k - 7),
    line AS (SELECT regr_slope(y, x) AS w, regr_intercept(y, x) AS c FROM pairs),
    sd AS (SELECT item_id, sqrt(avg((y - w * x - c) ** 2)) AS sigma FROM pairs, line GROUP BY item_id),
    ends AS (SELECT item_id, max(k) AS k1, max(ts) AS last_ts, arg_max(y, k) AS y1 FROM s GROUP BY item_id),
    fc AS (SELECT e.item_id, {AHEAD["D"]} AS ts, w * coalesce(s.y, y1) + c AS mean, sigma
           FROM ends e CROSS JOIN (SELECT unnest(range(1, 8)) AS h) CROSS JOIN line
           LEFT JOIN s ON s.item_id = e.item_id AND s.k = e.k1 + h - 7
           LEFT JOIN sd ON sd.item_id = e.item_id)
    SELECT item_id, ts AS "timestamp", round(mean, 3) AS mean, {quantiles_sql(3)} FROM fc"""


def _calendar(rows):
    return rows.withColumn("weekend", (F.weekday(STAMP) >= 5).cast("double"))


def fc_fit_predict_global(spark, sf_dir):
    """Regression on lags, calendar, a known covariate and a static feature."""
    from tidecast.operators.series import future_index

    series = _calendar(daily_events(spark, sf_dir))
    known = _calendar(future_index(series, 7, "D"))
    static = series.select(ITEM).distinct().withColumn("length", F.length(ITEM).cast("double"))
    estimator = ForecastEstimator(
        prediction_length=7, freq="D", quantile_levels=LEVELS, known_covariates_names=["weekend"]
    )
    return rounded(
        estimator.fit_predict(
            series, known_covariates=known, static_features=static, hyperparameters={"lag_regression": {}}
        ),
        2,
    )


QUERIES["fc_fit_predict_global"] = fc_fit_predict_global

_GLOBAL_LAGS = (7, 8, 9, 14)  # of horizon 7 and season 7


def _features_sql(row: str, lagged: Sequence[str]) -> list[str]:
    """The regression's inputs for a row with ``ts``, ``k`` and ``item_id``."""
    month, season = f"month({row}.ts) * 2 * pi() / 12", f"({row}.k % 7) * 2 * pi() / 7"
    return [
        *lagged, f"sin({month})", f"cos({month})", f"sin({season})", f"cos({season})",
        f"CAST(isodow({row}.ts) >= 6 AS DOUBLE)", f"CAST(length({row}.item_id) AS DOUBLE)",
    ]


def _least_squares_sql(source: str, n: int) -> str:
    """CTEs that end in ``fit`` (w0 to w<n-1>, c): y regressed on f0 to f<n-1> of ``source``.

    Normal equations on covariances, solved by elimination, a CTE per step. An input that is constant
    gets no weight.
    """
    inverse = lambda p: f"(CASE WHEN {a(p, p)} > 1e-9 THEN 1 / {a(p, p)} ELSE 0 END)"
    span = range(n)
    pairs = [(i, j) for i in span for j in span if i <= j]
    a = lambda i, j: f"a{min(i, j)}_{max(i, j)}"
    means = ", ".join(f"avg(f{i}) AS m{i}" for i in span)
    covariances = ", ".join(f"covar_pop(f{i}, f{j}) AS {a(i, j)}" for i, j in pairs)
    steps = [f"e0 AS (SELECT avg(y) AS my, {means}, {covariances}, {', '.join(f'covar_pop(f{i}, y) AS d{i}' for i in span)} FROM {source})"]
    for p in span:
        rest = [f"{a(i, j)} - {a(p, i)} * {a(p, j)} * {inverse(p)} AS {a(i, j)}" if i > p else a(i, j) for i, j in pairs]
        right = [f"d{i} - {a(p, i)} * d{p} * {inverse(p)} AS d{i}" if i > p else f"d{i}" for i in span]
        steps.append(f"e{p + 1} AS (SELECT my, {', '.join(f'm{i}' for i in span)}, {', '.join(rest)}, {', '.join(right)} FROM e{p})")
    before = f"e{n}"
    for p in reversed(span):
        solved = " ".join(f"- {a(p, j)} * w{j}" for j in range(p + 1, n))
        steps.append(f"s{p} AS (SELECT *, (d{p} {solved}) * {inverse(p)} AS w{p} FROM {before})")
        before = f"s{p}"
    constant = " ".join(f"- w{i} * m{i}" for i in span)
    steps.append(f"fit AS (SELECT {', '.join(f'w{i}' for i in span)}, my {constant} AS c FROM {before})")
    return ",\n    ".join(steps)


def _global_sql() -> str:
    n = len(_features_sql("a", _GLOBAL_LAGS))
    value = " + ".join(f"w{i} * f{i}" for i in range(n)) + " + c"
    joins = " ".join(f"JOIN s l{k} ON l{k}.item_id = a.item_id AND l{k}.k = a.k - {k}" for k in _GLOBAL_LAGS)
    known = ", ".join(f"{x} AS f{i}" for i, x in enumerate(_features_sql("a", [f"l{k}.y" for k in _GLOBAL_LAGS])))
    later = ", ".join(f"{x} AS f{i}" for i, x in enumerate(_features_sql("a", [f"coalesce(l{k}.y, y1)" for k in _GLOBAL_LAGS])))
    return f"""
    WITH s AS ({DAILY_SQL}),
    seen AS (SELECT a.item_id, a.y, {known} FROM s a {joins}),
    {_least_squares_sql("seen", n)},
    sd AS (SELECT item_id, sqrt(avg((y - ({value})) ** 2)) AS sigma FROM seen, fit GROUP BY item_id),
    ends AS (SELECT item_id, max(k) AS k1, max(ts) AS last_ts, arg_max(y, k) AS y1 FROM s GROUP BY item_id),
    ahead AS (SELECT item_id, y1, k1 + h AS k, {AHEAD["D"]} AS ts FROM ends, (SELECT unnest(range(1, 8)) AS h)),
    fc AS (SELECT item_id, ts, {value} AS mean, sigma FROM (
           SELECT a.item_id, a.ts, {later} FROM ahead a {joins.replace("JOIN", "LEFT JOIN")}) CROSS JOIN fit LEFT JOIN sd USING (item_id))
    SELECT item_id, ts AS "timestamp", round(mean, 2) AS mean, {quantiles_sql(2)} FROM fc"""


SQL["fc_fit_predict_global"] = _global_sql()


def fc_best_quality(spark, sf_dir):
    """All candidates and their weighted ensemble; the result is the leaderboard."""
    estimator = ForecastEstimator(prediction_length=6, freq="MS", eval_metric="MASE", quantile_levels=LEVELS)
    model = estimator.fit(monthly_orders(spark, sf_dir), presets="best_quality")
    return rounded(model.leaderboard(spark).drop("fit_time"))


QUERIES["fc_best_quality"] = fc_best_quality
