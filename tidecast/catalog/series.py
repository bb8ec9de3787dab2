"""Series queries: building, indexing, regularising, joining, nested JSON."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidecast.catalog.common import (
    DAILY_SQL,
    HOURLY_SQL,
    LEVELS,
    MONTHLY_SQL,
    WEEKLY_SQL,
    daily_events,
    forecast_sql,
    hourly_events,
    monthly_orders,
    rounded,
    table,
    weekly_supply,
)
from tidecast.functions.frequency import stamps_from_start
from tidecast.functions.quantiles import empirical_quantiles, group_quantiles
from tidecast.operators.baseline import as_forecast_table, baseline_forecast
from tidecast.operators.columns import ITEM, STAMP, TARGET, canonicalize, known_covariate_names, restore_names
from tidecast.operators.series import (
    check_forecast,
    duplicate_stamps,
    future_index,
    item_bounds,
    item_frequency,
    join_known,
    last_steps,
    missing_covariates,
    off_grid_items,
    order_items,
    regularize,
    stack_frames,
    to_series,
)
from tidecast.sources.nested import (
    covariates_from_nested_json,
    forecast_to_nested_json,
    items_to_lists,
    series_from_nested_json,
)

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def weekend(rows):
    return rows.withColumn("weekend", (F.weekday(STAMP) >= 5).cast("double"))


@query(
    "ts_daily_series",
    f'SELECT item_id, ts AS "timestamp", y AS target FROM ({DAILY_SQL})',
)
def ts_daily_series(spark, sf_dir):
    named = restore_names(daily_events(spark, sf_dir), "event_type", "day").withColumnRenamed(TARGET, "total")
    return canonicalize(named, "event_type", "day", "total")


@query(
    "ts_item_bounds",
    f"""SELECT item_id, min(ts) AS first_timestamp, max(ts) AS last_timestamp, count(*) AS n_rows
        FROM ({WEEKLY_SQL}) GROUP BY item_id""",
)
def ts_item_bounds(spark, sf_dir):
    return item_bounds(weekly_supply(spark, sf_dir))


# -- future index on every kind of calendar ------------------------------------------------


def _last_orders(day):
    """Per priority, one row at the last calendar anchor given by ``day`` over order dates."""

    def build(spark, sf_dir):
        orders = table(spark, sf_dir, "orders")
        return orders.select(
            F.col("o_orderpriority").alias(ITEM), day().cast("timestamp_ntz").alias(STAMP), F.lit(1.0).alias(TARGET)
        )

    return build


def _future(name: str, build, freq: str, horizon: int, last_sql: str, ahead_sql: str) -> None:
    QUERIES[name] = lambda spark, sf_dir: future_index(build(spark, sf_dir), horizon, freq)
    SQL[name] = f"""
    WITH l AS ({last_sql})
    SELECT item_id, CAST({ahead_sql} AS TIMESTAMP) AS "timestamp" FROM l, (SELECT unnest(range(1, {horizon + 1})) AS h)"""


def _priority_sql(day: str) -> str:
    return f"SELECT o_orderpriority AS item_id, max({day}) AS d FROM orders GROUP BY 1"


def _last_sql(source: str) -> str:
    return f"SELECT item_id, max(ts) AS d FROM ({source}) GROUP BY 1"


_future("ts_future_index_d", daily_events, "D", 14, _last_sql(DAILY_SQL), "d + to_days(CAST(h AS INTEGER))")
_future("ts_future_index_h", hourly_events, "h", 24, _last_sql(HOURLY_SQL), "d + to_hours(h)")
_future("ts_future_index_w", weekly_supply, "W-MON", 8, _last_sql(WEEKLY_SQL), "d + to_days(CAST(7 * h AS INTEGER))")
_future("ts_future_index_ms", monthly_orders, "MS", 12, _last_sql(MONTHLY_SQL), "d + to_months(CAST(h AS INTEGER))")
_future(
    "ts_future_index_me",
    _last_orders(lambda: F.last_day("o_orderdate")),
    "ME",
    12,
    _priority_sql("last_day(o_orderdate)"),
    "last_day(d + to_months(CAST(h AS INTEGER)))",
)
_future(
    "ts_future_index_qs",
    _last_orders(lambda: F.trunc("o_orderdate", "QUARTER")),
    "QS",
    6,
    _priority_sql("date_trunc('quarter', o_orderdate)"),
    "d + to_months(CAST(3 * h AS INTEGER))",
)
_future(
    "ts_future_index_ys",
    _last_orders(lambda: F.trunc("o_orderdate", "YEAR")),
    "YS",
    3,
    _priority_sql("date_trunc('year', o_orderdate)"),
    "d + to_years(CAST(h AS INTEGER))",
)


@query(
    "ts_future_index_b",
    """
    WITH l AS (SELECT o_orderpriority AS item_id, max(o_orderdate) AS d FROM orders
               WHERE isodow(o_orderdate) < 6 GROUP BY 1),
    days AS (SELECT item_id, d + to_days(CAST(i AS INTEGER)) AS t FROM l, (SELECT unnest(range(1, 31)) AS i)),
    work AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY t) AS h FROM days WHERE isodow(t) < 6)
    SELECT item_id, t AS "timestamp" FROM work WHERE h <= 10""",
)
def ts_future_index_b(spark, sf_dir):
    """Next ten working days after the last order placed on a working day."""
    orders = table(spark, sf_dir, "orders").filter(F.weekday("o_orderdate") < 5)
    series = orders.select(F.col("o_orderpriority").alias(ITEM), F.col("o_orderdate").alias(STAMP))
    return future_index(series, 10, "B")


def _from_start(name: str, freq: str, stamp_sql: str) -> None:
    def run(spark, sf_dir):
        first = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").cast("string").alias(ITEM))
        starts = first.agg((F.min("o_orderdate") + F.expr("INTERVAL '5' HOUR")).alias("start"))
        return starts.select(ITEM, F.posexplode(stamps_from_start(F.col("start"), F.lit(6), freq)).alias("k", STAMP))

    QUERIES[name] = run
    SQL[name] = f"""
    WITH l AS (SELECT CAST(o_custkey AS VARCHAR) AS item_id, min(o_orderdate) + INTERVAL 5 HOUR AS s FROM orders GROUP BY 1),
    g AS (SELECT *, CAST(k AS INTEGER) AS i FROM l, (SELECT unnest(range(0, 6)) AS k))
    SELECT item_id, i AS k, CAST({stamp_sql} AS TIMESTAMP) AS "timestamp" FROM g"""


_from_start("ts_stamps_d2", "2D", "s + to_days(2 * i)")
_from_start("ts_stamps_min15", "15min", "s + to_minutes(15 * i)")
_from_start("ts_stamps_w", "W", "s + to_days((7 - dayofweek(s)) % 7 + 7 * i)")
_from_start(
    "ts_stamps_ms",
    "MS",
    "date_trunc('month', s) + to_months(i + CASE WHEN day(s) = 1 THEN 0 ELSE 1 END) + (s - date_trunc('day', s))",
)
_from_start(
    "ts_stamps_me", "ME", "last_day(date_trunc('month', s) + to_months(i)) + (s - date_trunc('day', s))"
)
_from_start(
    "ts_stamps_qs",
    "QS",
    "date_trunc('quarter', s) + to_months(3 * (i + CASE WHEN date_trunc('day', s) = date_trunc('quarter', s) THEN 0 ELSE 1 END))"
    " + (s - date_trunc('day', s))",
)


# -- regular grids, frequency, checks --------------------------------------------------------

_GRID = f"""
    s AS ({HOURLY_SQL}),
    b AS (SELECT item_id, min(ts) AS lo, max(ts) AS hi FROM s GROUP BY 1),
    g AS (SELECT item_id, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts FROM b),
    full_grid AS (SELECT g.item_id, g.ts, s.y FROM g LEFT JOIN s USING (item_id, ts))"""


@query("ts_regularize", f'WITH {_GRID} SELECT item_id, ts AS "timestamp", y AS target FROM full_grid')
def ts_regularize(spark, sf_dir):
    return regularize(hourly_events(spark, sf_dir), "h")


@query(
    "ts_regularize_ffill",
    f"""WITH {_GRID}
    SELECT item_id, ts AS "timestamp",
           last_value(y IGNORE NULLS) OVER (PARTITION BY item_id ORDER BY ts) AS target FROM full_grid""",
)
def ts_regularize_ffill(spark, sf_dir):
    return regularize(hourly_events(spark, sf_dir), "h", "ffill")


@query(
    "ts_regularize_zero",
    f'WITH {_GRID} SELECT item_id, ts AS "timestamp", coalesce(y, 0) AS target FROM full_grid',
)
def ts_regularize_zero(spark, sf_dir):
    return regularize(hourly_events(spark, sf_dir), "h", 0.0)


def _gap_sql(source: str, freq: str) -> str:
    return f"""
    WITH gaps AS (SELECT item_id, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY item_id ORDER BY ts)) AS g
                  FROM ({source})),
    n AS (SELECT item_id, g, count(*) AS c FROM gaps WHERE g IS NOT NULL GROUP BY ALL)
    SELECT item_id, g AS modal_gap_us, {freq} AS freq FROM n
    QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY c DESC, g) = 1"""


@query("ts_infer_freq_h", _gap_sql(HOURLY_SQL, "CASE g WHEN 3600000000 THEN 'h' END"))
def ts_infer_freq_h(spark, sf_dir):
    return item_frequency(hourly_events(spark, sf_dir))


@query("ts_infer_freq_ms", _gap_sql(MONTHLY_SQL, "CASE WHEN g / 86400000000 BETWEEN 28 AND 31 THEN 'MS' END"))
def ts_infer_freq_ms(spark, sf_dir):
    return item_frequency(monthly_orders(spark, sf_dir))


@query(
    "ts_duplicate_stamps",
    """SELECT CAST(l_suppkey AS VARCHAR) AS item_id, l_shipdate AS "timestamp", count(*) AS n
       FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
)
def ts_duplicate_stamps(spark, sf_dir):
    series = to_series(table(spark, sf_dir, "lineitem"), "l_suppkey", "l_shipdate", "l_quantity")
    return duplicate_stamps(series)


@query(
    "ts_off_grid",
    """SELECT event_type AS item_id, min(epoch_us(ts) % 3600000000) AS min_phase,
              max(epoch_us(ts) % 3600000000) AS max_phase, true AS anchored
       FROM events GROUP BY 1 HAVING min_phase <> max_phase""",
)
def ts_off_grid(spark, sf_dir):
    """Raw event times are not on an hourly grid."""
    return off_grid_items(to_series(table(spark, sf_dir, "events"), "event_type", "ts", "value"), "h")


@query(
    "ts_holdout_split",
    f"""SELECT item_id, ts AS "timestamp", y AS target, k > max(k) OVER (PARTITION BY item_id) - 13 AS held_out
        FROM ({WEEKLY_SQL})""",
)
def ts_holdout_split(spark, sf_dir):
    return last_steps(weekly_supply(spark, sf_dir), 13, "W-MON").drop("step")


# -- static features and covariates -------------------------------------------------------------

_NATION_DAYS = """
    SELECT c_nationkey AS nation, o_orderdate AS ts, round(sum(o_totalprice), 2) AS y
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL"""


def _nation_days(spark, sf_dir):
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .groupBy(F.col("c_nationkey").alias("nation"), F.col("o_orderdate").alias("day"))
        .agg(F.round(F.sum("o_totalprice"), 2).alias("total"))
    )


@query(
    "ts_static_join",
    f"""SELECT CAST(nation AS VARCHAR) AS item_id, ts AS "timestamp", y AS target, n_name, r_name
        FROM ({_NATION_DAYS}) LEFT JOIN nation ON n_nationkey = nation LEFT JOIN region ON r_regionkey = n_regionkey""",
)
def ts_static_join(spark, sf_dir):
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    static = nation.join(region, nation.n_regionkey == region.r_regionkey, "left").select(
        F.col("n_nationkey").alias("nation"), "n_name", "r_name"
    )
    return to_series(_nation_days(spark, sf_dir), "nation", "day", "total", static)


_AHEAD_DAYS = f"""
    SELECT item_id, ts FROM (
        SELECT item_id, max(ts) + to_days(CAST(h AS INTEGER)) AS ts
        FROM ({DAILY_SQL}), (SELECT unnest(range(1, 11)) AS h) GROUP BY item_id, h)"""


def _partial_covariates(spark, sf_dir):
    """Weekend flags for the next 7 days of every item: three days short of the horizon."""
    return weekend(future_index(daily_events(spark, sf_dir), 7, "D"))


_KNOWN = f"""
    SELECT item_id, ts, CASE WHEN isodow(ts) >= 6 THEN 1.0 ELSE 0.0 END AS weekend
    FROM (SELECT item_id, max(ts) + to_days(CAST(h AS INTEGER)) AS ts
          FROM ({DAILY_SQL}), (SELECT unnest(range(1, 8)) AS h) GROUP BY item_id, h)"""


@query(
    "ts_known_cov_join",
    f"""SELECT f.item_id, f.ts AS "timestamp", CAST(weekend AS DOUBLE) AS weekend
        FROM ({_AHEAD_DAYS}) f LEFT JOIN ({_KNOWN}) k USING (item_id, ts)""",
)
def ts_known_cov_join(spark, sf_dir):
    return join_known(future_index(daily_events(spark, sf_dir), 10, "D"), _partial_covariates(spark, sf_dir))


@query(
    "ts_cov_coverage",
    f"""SELECT f.item_id, f.ts AS "timestamp" FROM ({_AHEAD_DAYS}) f ANTI JOIN ({_KNOWN}) k USING (item_id, ts)""",
)
def ts_cov_coverage(spark, sf_dir):
    return missing_covariates(future_index(daily_events(spark, sf_dir), 10, "D"), _partial_covariates(spark, sf_dir))


@query(
    "ts_known_cov_names",
    f"""SELECT item_id, ts AS "timestamp", CASE WHEN isodow(ts) >= 6 THEN 1.0 ELSE 0.0 END::DOUBLE AS weekend
        FROM ({DAILY_SQL})""",
)
def ts_known_cov_names(spark, sf_dir):
    """Covariate table projected to the inferred covariate names."""
    known = weekend(daily_events(spark, sf_dir)).drop(TARGET)
    return known.select(ITEM, STAMP, *known_covariate_names(known))


@query(
    "ts_stack",
    f"""SELECT item_id, ts AS "timestamp", y AS target, CASE WHEN isodow(ts) >= 6 THEN 1.0 ELSE 0.0 END::DOUBLE AS weekend
        FROM ({DAILY_SQL})
        UNION ALL SELECT item_id, ts, y, NULL FROM ({MONTHLY_SQL})""",
)
def ts_stack(spark, sf_dir):
    """Two series tables under one another; the one without covariate gets nulls."""
    return stack_frames(weekend(daily_events(spark, sf_dir)), monthly_orders(spark, sf_dir))


@query(
    "ts_check_forecast",
    """WITH c AS (SELECT item_id, count(*) AS n_rows FROM ts GROUP BY 1)
       SELECT item_id, n_rows, true AS expected FROM c WHERE n_rows <> 7""".replace(
        "ts GROUP", f"(SELECT item_id, h FROM ({DAILY_SQL}), (SELECT unnest(range(1, 6)) AS h) GROUP BY ALL) GROUP"
    ),
)
def ts_check_forecast(spark, sf_dir):
    """A forecast that is two steps short is reported for every item."""
    series = daily_events(spark, sf_dir)
    return check_forecast(baseline_forecast(series, 5, "D", 7, ["naive"]), series, 7)


@query(
    "ts_quantiles",
    f"""SELECT item_id, round(quantile_cont(y, 0.1), 4) AS "0.1", round(quantile_cont(y, 0.5), 4) AS "0.5",
               round(quantile_cont(y, 0.9), 4) AS "0.9" FROM ({WEEKLY_SQL}) GROUP BY 1""",
)
def ts_quantiles(spark, sf_dir):
    series = weekly_supply(spark, sf_dir)
    return rounded(series.groupBy(ITEM).agg(*empirical_quantiles(F.col(TARGET), LEVELS)))


# -- nested JSON -------------------------------------------------------------------------------


@query(
    "ts_quantiles_of_large_groups",
    """SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.1), 4) AS "0.1", round(quantile_cont(l_extendedprice, 0.5), 4) AS "0.5",
              round(quantile_cont(l_extendedprice, 0.9), 4) AS "0.9" FROM lineitem GROUP BY 1""",
)
def ts_quantiles_of_large_groups(spark, sf_dir):
    """Three groups of nearly all distinct values, ranked without gathering any."""
    return rounded(group_quantiles(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_extendedprice", LEVELS, few=1000))


def _bodies(spark, sf_dir, horizon: int = 3):
    """One request per item and month, made from the zero-filled daily series."""
    daily = weekend(regularize(daily_events(spark, sf_dir), "D", 0.0))
    month = F.date_format(STAMP, "yyyy-MM")
    grouped = daily.groupBy(F.concat_ws("|", ITEM, month).alias("request_id"), ITEM).agg(
        F.min(STAMP).alias("start"),
        F.max(STAMP).alias("end"),
        F.sort_array(F.collect_list(F.struct(STAMP, TARGET, "weekend"))).alias("rows"),
    )
    days = F.sequence(F.lit(1), F.lit(horizon))
    flag = F.transform(days, lambda d: (F.weekday(F.date_add(F.to_date("end"), d)) >= 5).cast("double"))
    item = F.struct(
        ITEM,
        F.date_format("start", "yyyy-MM-dd").alias("start"),
        F.transform("rows", lambda r: r[TARGET]).alias("target"),
        F.struct(F.transform("rows", lambda r: r["weekend"]).alias("weekend")).alias("past_covariates"),
        F.struct(flag.alias("weekend")).alias("future_covariates"),
    )
    options = F.struct(F.lit(horizon).alias("prediction_length"), F.lit("D").alias("freq"))
    return grouped.select(
        "request_id", F.to_json(F.struct(F.array(item).alias("inputs"), options.alias("parameters"))).alias("body")
    )


_ZERO_DAYS = f"""
    s AS ({DAILY_SQL}),
    b AS (SELECT item_id, min(ts) AS lo, max(ts) AS hi FROM s GROUP BY 1),
    g AS (SELECT item_id, unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS ts FROM b),
    z AS (SELECT g.item_id, g.ts, coalesce(y, 0) AS y, g.item_id || '|' || strftime(g.ts, '%Y-%m') AS request_id
          FROM g LEFT JOIN s USING (item_id, ts))"""


@query(
    "json_to_series",
    f"""WITH {_ZERO_DAYS}
    SELECT request_id, 0 AS pos, item_id, ts AS "timestamp", y AS target,
           CASE WHEN isodow(ts) >= 6 THEN 1.0 ELSE 0.0 END::DOUBLE AS weekend FROM z""",
)
def json_to_series(spark, sf_dir):
    return series_from_nested_json(_bodies(spark, sf_dir), ["weekend"])


@query(
    "json_to_covariates",
    f"""WITH {_ZERO_DAYS},
    e AS (SELECT request_id, item_id, max(ts) AS hi FROM z GROUP BY ALL),
    f AS (SELECT *, hi + to_days(CAST(h AS INTEGER)) AS ts FROM e, (SELECT unnest(range(1, 4)) AS h))
    SELECT request_id, 0 AS pos, item_id, ts AS "timestamp",
           CASE WHEN isodow(ts) >= 6 THEN 1.0 ELSE 0.0 END::DOUBLE AS weekend FROM f""",
)
def json_to_covariates(spark, sf_dir):
    return covariates_from_nested_json(_bodies(spark, sf_dir), ["weekend"])


_FC_DAILY = f'WITH s AS ({DAILY_SQL}), {forecast_sql("s", 7, 7, "D", ["seasonal_naive"])}'


def _daily_forecast(spark, sf_dir):
    rows = baseline_forecast(daily_events(spark, sf_dir), 7, "D", 7, ["seasonal_naive"])
    return rounded(as_forecast_table(rows, [0.5]))


@query(
    "fc_items_to_lists",
    _FC_DAILY
    + """ SELECT item_id, list(ts ORDER BY ts) AS "timestamp", list(round(mean, 4) ORDER BY ts) AS mean,
          list(round(mean, 4) ORDER BY ts) AS "0.5" FROM fc GROUP BY 1""",
)
def fc_items_to_lists(spark, sf_dir):
    return items_to_lists(_daily_forecast(spark, sf_dir))


@query(
    "fc_to_nested_json",
    _FC_DAILY
    + """ SELECT item_id, '{"mean":[' || string_agg(CAST(round(mean, 4) AS VARCHAR), ',' ORDER BY ts)
          || '],"0.5":[' || string_agg(CAST(round(mean, 4) AS VARCHAR), ',' ORDER BY ts)
          || '],"item_id":"' || item_id || '","start":"' || strftime(min(ts), '%Y-%m-%dT%H:%M:%S') || '"}' AS prediction
          FROM fc GROUP BY 1""",
)
def fc_to_nested_json(spark, sf_dir):
    return forecast_to_nested_json(_daily_forecast(spark, sf_dir))


@query("ts_order_items", _FC_DAILY + ' SELECT item_id, ts AS "timestamp", round(mean, 4) AS mean, round(mean, 4) AS "0.5" FROM fc')
def ts_order_items(spark, sf_dir):
    return order_items(_daily_forecast(spark, sf_dir))
