"""Queries over forecast requests: mixed batches, fitted models, refused bodies, long tables."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import functions as F

from tidecast.catalog.common import (
    DAILY_SQL,
    HOURLY_SQL,
    LEVELS,
    WEEKLY_SQL,
    daily_events,
    forecast_sql,
    hourly_events,
    quantiles_sql,
    rounded,
    weekly_supply,
)
from tidecast.catalog.series import _ZERO_DAYS, _bodies
from tidecast.operators.columns import ITEM, STAMP, TARGET
from tidecast.operators.series import regularize
from tidecast.plans.forecast import ForecastEstimator
from tidecast.session import scratch_path
from tidecast.streaming.queries import read_stream
from tidecast.streaming.requests import (
    answer_requests,
    forecast_stream,
    judge_for,
    level_columns,
    read_forecasts,
    read_refused,
    table_stream,
)

QUERIES: dict = {}
SQL: dict[str, str] = {}

KINDS = ((daily_events, DAILY_SQL, "D", 7, 5), (hourly_events, HOURLY_SQL, "h", 24, 30), (weekly_supply, WEEKLY_SQL, "W-MON", 52, 9))
LISTS = 50  # lists of levels that the mixed requests take in turn


def _mixed_bodies(spark, sf_dir):
    """One request per item of three tables, each with its frequency, horizon and one of LISTS level lists."""
    out = None
    for build, _, freq, _, horizon in KINDS:
        rows = regularize(build(spark, sf_dir), freq)
        packed = rows.groupBy(ITEM).agg(F.sort_array(F.collect_list(F.struct(STAMP, TARGET))).alias("rows"))
        item = F.struct(
            ITEM,
            F.date_format(F.col("rows")[0][STAMP], "yyyy-MM-dd'T'HH:mm:ss").alias("start"),
            F.transform("rows", lambda r: r[TARGET]).alias("target"),
        )
        off = (F.crc32(F.col(ITEM).cast("binary")) % LISTS * 5 + 5) / 1000  # 0.005, 0.010 and so on
        levels = F.array(F.round(0.5 + off, 3), F.round(0.5 - off, 3))
        options = F.struct(F.lit(horizon).alias("prediction_length"), F.lit(freq).alias("freq"), levels.alias("quantile_levels"))
        body = F.to_json(F.struct(F.array(item).alias("inputs"), options.alias("parameters")))
        part = packed.select(F.concat_ws("/", F.lit(freq), ITEM).alias("request_id"), body.alias("body"))
        out = part if out is None else out.union(part)
    return out


def _levels_sql() -> str:
    """Rows (list, low, high, z); lists are numbered by the fifth of a permille their levels lie apart."""
    rows = [(5 * i + 5, (500 - 5 * i - 5) / 1000, (505 + 5 * i) / 1000) for i in range(LISTS)]
    return ", ".join(f"({n}, {low}, {high}, {NormalDist().inv_cdf(high)!r})" for n, low, high in rows)


def _mixed_sql() -> str:
    parts = [
        f"""SELECT '{freq}/' || item_id AS request_id, item_id, ts, mean, coalesce(sigma, 0) AS sigma FROM (
            WITH s AS ({sql}), {forecast_sql("s", horizon, season, freq, ["seasonal_naive"])} SELECT * FROM fc)"""
        for _, sql, freq, season, horizon in KINDS
    ]
    return f"""
    WITH fc AS ({" UNION ALL ".join(parts)}),
    lists(n, low, high, z) AS (VALUES {_levels_sql()})
    SELECT request_id, 0 AS pos, item_id, ts AS "timestamp", round(mean, 4) AS mean,
           CAST(low AS DOUBLE) AS low_level, round(mean - z * sigma, 4) AS low, CAST(high AS DOUBLE) AS high_level, round(mean + z * sigma, 4) AS high
    FROM fc JOIN answered USING (request_id) JOIN lists USING (n)"""


def req_mixed(spark, sf_dir):
    """Three frequencies and horizons and fifty lists of levels in one plan; each request's two levels."""
    answers = answer_requests(judge_for("seasonal_naive", _mixed_bodies(spark, sf_dir)))
    names = F.array_sort(F.transform(F.map_keys("quantiles"), lambda q: q.cast("double")))
    low, high = names[0], names[1]
    return rounded(
        answers.select(
            "request_id", "pos", ITEM, STAMP, "mean",
            low.alias("low_level"), F.col("quantiles")[low.cast("string")].alias("low"),
            high.alias("high_level"), F.col("quantiles")[high.cast("string")].alias("high"),
        )
    )


# A list's number from crc32 of the item, which SQL lacks: bits of each byte, eight steps at a time.
_CRC = """xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(item_id, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""

QUERIES["req_mixed"] = req_mixed
SQL["req_mixed"] = _mixed_sql().replace(
    "JOIN answered USING (request_id)", f"JOIN (SELECT DISTINCT request_id, {_CRC} % {LISTS} * 5 + 5 AS n FROM fc) USING (request_id)"
)


# -- a fitted model ----------------------------------------------------------------------------------


def _weekend(rows):
    return rows.withColumn("weekend", (F.weekday(STAMP) >= 5).cast("double"))


def req_fitted(spark, sf_dir):
    """A stream of bodies with covariates, answered by a regression that was saved and loaded."""
    from tidecast.plans.forecast import ForecastModel

    train = _weekend(regularize(daily_events(spark, sf_dir), "D", 0.0))
    estimator = ForecastEstimator(prediction_length=3, freq="D", quantile_levels=LEVELS, known_covariates_names=["weekend"])
    fitted = estimator.fit(train, hyperparameters={"lag_regression": {"lags": [7], "calendar": False}})
    folder, source, output, state = (scratch_path(spark, label) for label in ("model", "requests", "forecasts", "state"))
    fitted.save(spark, folder)
    _bodies(spark, sf_dir).write.json(source)
    stream = read_stream(spark, source, "request_id string, body string", "application/jsonl")
    model = ForecastModel.load(spark, folder)
    forecast_stream(stream, "fitted-requests", output, state, model, available_now=True).awaitTermination()
    return rounded(read_forecasts(spark, output, LEVELS), 3)


QUERIES["req_fitted"] = req_fitted
SQL["req_fitted"] = f"""
    WITH {_ZERO_DAYS},
    q AS (SELECT *, date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS k, (isodow(ts) >= 6)::INT::DOUBLE AS we FROM z),
    pairs AS (SELECT a.y, b.y AS x, a.we FROM q a JOIN q b ON b.item_id = a.item_id AND b.k = a.k - 7),
    m AS (SELECT avg(y) AS my, avg(x) AS mx, avg(we) AS mw, var_pop(x) AS xx, var_pop(we) AS ww, covar_pop(x, we) AS xw,
                 covar_pop(x, y) AS xy, covar_pop(we, y) AS wy FROM pairs),
    plane AS (SELECT (xy * ww - wy * xw) / (xx * ww - xw * xw) AS a, (wy * xx - xy * xw) / (xx * ww - xw * xw) AS b, my, mx, mw FROM m),
    fit AS (SELECT a, b, my - a * mx - b * mw AS c FROM plane),
    own AS (SELECT t.request_id, t.y - a * l.y - b * t.we - c AS e
            FROM q t JOIN q l ON l.request_id = t.request_id AND l.k = t.k - 7, fit),
    sd AS (SELECT request_id, sqrt(avg(e * e)) AS sigma FROM own GROUP BY 1),
    ends AS (SELECT request_id, item_id, max(k) AS k1, max(ts) AS last_ts, arg_max(y, k) AS y1 FROM q GROUP BY ALL),
    ahead AS (SELECT e.*, h, last_ts + to_days(CAST(h AS INTEGER)) AS ts FROM ends e, (SELECT unnest(range(1, 4)) AS h)),
    fc AS (SELECT f.request_id, f.item_id, f.ts, sigma,
                  a * coalesce(l.y, y1) + b * (isodow(f.ts) >= 6)::INT + c AS mean
           FROM ahead f CROSS JOIN fit LEFT JOIN q l ON l.request_id = f.request_id AND l.k = f.k1 + f.h - 7
           LEFT JOIN sd ON sd.request_id = f.request_id)
    SELECT request_id, 0 AS pos, item_id, ts AS "timestamp", round(mean, 3) AS mean, {quantiles_sql(3)} FROM fc"""


# -- bodies that can't be answered -------------------------------------------------------------------

FAULTS = {
    "01": "the body is not the JSON of a request",
    "02": "unknown frequency",
    "03": "`prediction_length` must be at least 1",
    "04": "an item has no `target`",
}


def req_refused(spark, sf_dir):
    """A stream with broken bodies among good ones: what was refused and why, and the steps of the others."""
    month, body = F.substring_index("request_id", "-", -1), F.col("body")
    broken = (
        F.when(month == "01", F.expr("substring(body, 1, length(body) - 2)"))
        .when(month == "02", F.replace(body, F.lit('"freq":"D"'), F.lit('"freq":"fortnight"')))
        .when(month == "03", F.replace(body, F.lit('"prediction_length":3'), F.lit('"prediction_length":0')))
        .when(month == "04", F.replace(body, F.lit('"target":'), F.lit('"targets":')))
        .otherwise(body)
    )
    source, output, errors, state = (scratch_path(spark, label) for label in ("requests", "forecasts", "refused", "state"))
    _bodies(spark, sf_dir).withColumn("body", broken).write.json(source)
    stream = read_stream(spark, source, "request_id string, body string", "application/jsonl")
    forecast_stream(stream, "refusing", output, state, levels=[0.5], available_now=True, errors=errors).awaitTermination()
    steps = spark.read.parquet(output).groupBy("request_id").agg(F.count(F.lit(1)).alias("n_steps"))
    return read_refused(spark, errors).join(steps, "request_id", "full_outer")


QUERIES["req_refused"] = req_refused
_CASES = " ".join(f"WHEN '{m}' THEN '{text}'" for m, text in FAULTS.items())
SQL["req_refused"] = f"""
    WITH {_ZERO_DAYS}, r AS (SELECT DISTINCT request_id, right(request_id, 2) AS mon FROM z)
    SELECT request_id, CASE mon {_CASES} END AS error, CASE WHEN mon > '04' THEN 3::BIGINT END AS n_steps FROM r"""


# -- long tables -------------------------------------------------------------------------------------


REQUEST_ITEMS = 300  # suppliers that share three requests


def _request_of(supplier):
    """A request's id: more suppliers make more requests, not larger ones."""
    group = F.floor(supplier.cast("bigint") / REQUEST_ITEMS).cast("string")
    return F.concat_ws("-", F.lit("r"), (F.crc32(supplier.cast("binary")) % 3).cast("string"), group)


def req_long_tables(spark, sf_dir):
    """Long-table requests in files with their own column names, answered by a fitted forecaster."""
    series = weekly_supply(spark, sf_dir)
    model = ForecastEstimator(prediction_length=13, freq="W-MON", quantile_levels=LEVELS).fit(series, hyperparameters=["drift"])
    source, output, state = (scratch_path(spark, label) for label in ("requests", "forecasts", "state"))
    rows = series.select(_request_of(F.col(ITEM)).alias("request_id"), F.col(ITEM).alias("supplier"), F.col(STAMP).alias("week"), TARGET)
    rows.repartition("request_id").write.parquet(source)
    stream = read_stream(spark, source, rows.schema)
    table_stream(
        stream, "long-requests", output, state, model, available_now=True, id_column="supplier", timestamp_column="week"
    ).awaitTermination()
    answers = spark.read.parquet(output).drop("batch", "request_id")
    return rounded(level_columns(answers, list(map(str, LEVELS))))


QUERIES["req_long_tables"] = req_long_tables
SQL["req_long_tables"] = f"""
    WITH s AS ({WEEKLY_SQL}), {forecast_sql("s", 13, 52, "W-MON", ["drift"])}
    SELECT item_id, ts AS "timestamp", round(mean, 4) AS mean, {quantiles_sql()} FROM fc"""
