"""Tables, derived series and SQL fragments the catalogue shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.operators.columns import ITEM, STAMP, TARGET, col


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles rounded, so that two engines agree whatever order they summed in."""
    return df.select(
        *[F.round(col(n), digits).alias(n) if t == "double" else col(n) for n, t in df.dtypes]
    )


# -- series: one Spark definition and the same thing in SQL ------------------------------


def daily_events(spark, sf_dir) -> DataFrame:
    """Daily value per event type."""
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias(ITEM), F.to_date("ts").cast("timestamp_ntz").alias(STAMP))
        .agg(F.round(F.sum("value"), 2).alias(TARGET))
    )


def hourly_events(spark, sf_dir) -> DataFrame:
    """Hourly value per event type; has gaps."""
    hour = F.to_date("ts").cast("timestamp_ntz") + F.hour("ts") * F.expr("INTERVAL '1' HOUR")
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias(ITEM), hour.alias(STAMP))
        .agg(F.round(F.sum("value"), 2).alias(TARGET))
    )


def weekly_supply(spark, sf_dir) -> DataFrame:
    """Weekly quantity per supplier (weeks begin on Monday); has gaps."""
    week = F.date_sub(F.to_date("l_shipdate"), F.weekday("l_shipdate")).cast("timestamp_ntz")
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_suppkey").cast("string").alias(ITEM), week.alias(STAMP))
        .agg(F.sum("l_quantity").alias(TARGET))
    )


def monthly_orders(spark, sf_dir) -> DataFrame:
    """Monthly order value per priority."""
    month = F.trunc("o_orderdate", "MM").cast("timestamp_ntz")
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderpriority").alias(ITEM), month.alias(STAMP))
        .agg(F.round(F.sum("o_totalprice"), 2).alias(TARGET))
    )


def daily_nations(spark, sf_dir) -> DataFrame:
    """Daily order value per customer nation: long series (more than 2,000 days)."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .groupBy(F.col("c_nationkey").cast("string").alias(ITEM), F.col("o_orderdate").alias(STAMP))
        .agg(F.round(F.sum("o_totalprice"), 2).alias(TARGET))
    )


# Each gives item_id, ts, k (calendar step) and y.
DAILY_SQL = """
    SELECT event_type AS item_id, date_trunc('day', ts) AS ts,
           date_diff('day', DATE '1970-01-01', CAST(date_trunc('day', ts) AS DATE)) AS k,
           round(sum(value), 2) AS y
    FROM events GROUP BY ALL"""
HOURLY_SQL = """
    SELECT event_type AS item_id, date_trunc('hour', ts) AS ts,
           date_diff('hour', TIMESTAMP '1970-01-01', date_trunc('hour', ts)) AS k,
           round(sum(value), 2) AS y
    FROM events GROUP BY ALL"""
WEEKLY_SQL = """
    SELECT CAST(l_suppkey AS VARCHAR) AS item_id, CAST(date_trunc('week', l_shipdate) AS TIMESTAMP) AS ts,
           date_diff('day', DATE '1970-01-05', CAST(date_trunc('week', l_shipdate) AS DATE)) // 7 AS k,
           sum(l_quantity) AS y
    FROM lineitem GROUP BY ALL"""
MONTHLY_SQL = """
    SELECT o_orderpriority AS item_id, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS ts,
           year(o_orderdate) * 12 + month(o_orderdate) - 1 AS k,
           round(sum(o_totalprice), 2) AS y
    FROM orders GROUP BY ALL"""

NATIONS_SQL = """
    SELECT CAST(c_nationkey AS VARCHAR) AS item_id, o_orderdate AS ts,
           date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS k,
           round(sum(o_totalprice), 2) AS y
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL"""

AHEAD = {
    "D": "last_ts + to_days(CAST(h AS INTEGER))",
    "h": "last_ts + to_hours(CAST(h AS BIGINT))",
    "W-MON": "last_ts + to_days(CAST(7 * h AS INTEGER))",
    "MS": "last_ts + to_months(CAST(h AS INTEGER))",
}


def stats_sql(source: str, season: int) -> str:
    """CTEs ``st`` (per-item statistics) and ``ph`` (latest value per season position) over ``source``."""
    return f"""
    lagged AS (
        SELECT a.*, a.y - b.y AS d1, a.y - c.y AS dm
        FROM {source} a
        LEFT JOIN {source} b ON b.item_id = a.item_id AND b.k = a.k - 1
        LEFT JOIN {source} c ON c.item_id = a.item_id AND c.k = a.k - {season}),
    st AS (
        SELECT item_id, count(*) AS n, max(ts) AS last_ts, min(k) AS k0, max(k) AS k1,
               arg_max(y, k) AS y1, arg_min(y, k) AS y0, avg(y) AS ym, var_samp(y) AS yv,
               count(d1) AS n1, sum(d1) AS sd1, sum(d1 * d1) AS ss1,
               count(dm) AS nm, sum(dm * dm) AS ssm, avg(abs(dm)) AS scale_abs,
               regr_avgx(y, k) AS xb, regr_avgy(y, k) AS yb,
               regr_sxx(y, k) AS sxx, regr_syy(y, k) AS syy, regr_sxy(y, k) AS sxy
        FROM lagged GROUP BY item_id),
    ph AS (SELECT item_id, k % {season} AS phase, arg_max(y, k) AS yp FROM {source} GROUP BY ALL)"""


_MEAN_SIGMA = {
    "naive": ("y1", "sqrt(ss1 / nullif(n1, 0)) * sqrt(h)"),
    "seasonal_naive": (
        "CASE WHEN k1 - k0 + 1 < {m} THEN y1 ELSE coalesce(yp, y1) END",
        "CASE WHEN k1 - k0 + 1 < {m} THEN sqrt(ss1 / nullif(n1, 0)) * sqrt(h) "
        "ELSE sqrt(ssm / nullif(nm, 0)) * sqrt((h - 1) // {m} + 1) END",
    ),
    "mean": ("ym", "sqrt(yv) * sqrt(1 + 1.0 / n)"),
    "drift": (
        "y1 + h * slope",
        "sqrt(greatest((ss1 - 2 * slope * sd1 + n1 * slope * slope) / nullif(n1 - 1, 0), 0)) "
        "* sqrt(h * (1 + h / nullif(k1 - k0, 0)))",
    ),
    "trend": (
        "yb + sxy / sxx * (k1 + h - xb)",
        "sqrt(greatest((syy - sxy / sxx * sxy) / nullif(n - 2, 0), 0)) "
        "* sqrt(1 + 1.0 / n + (k1 + h - xb) * (k1 + h - xb) / sxx)",
    ),
}


def forecast_sql(source: str, horizon: int, season: int, freq: str, models, extra: str = "") -> str:
    """CTE ``fc`` (item_id, ts, h, model, mean, sigma) of the baselines over CTE ``source``."""
    parts = []
    for model in models:
        mean, sigma = (text.format(m=season) for text in _MEAN_SIGMA[model])
        parts.append(
            f"SELECT item_id, {AHEAD[freq]} AS ts, h, '{model}' AS model, {mean} AS mean, {sigma} AS sigma{extra} FROM ahead"
        )
    return (
        stats_sql(source, season)
        + f""",
    ahead AS (
        SELECT g.*, ph.yp FROM (
            SELECT st.*, t.h, coalesce((y1 - y0) / nullif(k1 - k0, 0), 0) AS slope
            FROM st, (SELECT unnest(range(1, {horizon + 1})) AS h) t) g
        LEFT JOIN ph ON ph.item_id = g.item_id AND ph.phase = (g.k1 + g.h) % {season}),
    fc AS ({" UNION ALL ".join(parts)})"""
    )


# Standard normal quantiles of the levels used in the catalogue.
Z = {"0.1": -1.2815515655446008, "0.5": 0.0, "0.9": 1.2815515655446008}
LEVELS = [0.1, 0.5, 0.9]


def quantiles_sql(digits: int = 4) -> str:
    return ", ".join(f'round(mean + {z} * coalesce(sigma, 0), {digits}) AS "{q}"' for q, z in Z.items())
