"""Plans must not gather an item: groups stay bounded and hot items are spread."""

import re

import pytest
from pyspark.sql import functions as F

from tidecast.operators.baseline import BASELINES, backtest_rows, baseline_forecast
from tidecast.operators.chunks import CHUNK, chunk_size, with_halo
from tidecast.operators.leaderboard import score_forecasts, score_rows
from tidecast.operators.series import future_index, holdout_split, last_steps, regularize, with_step
from tidecast.operators.smoothing import smoothing_states


@pytest.fixture(scope="module")
def skewed(spark):
    """One item with a third of all rows, the rest in many short ones."""
    n = 60_000
    hot = F.col("id") < n // 3
    return spark.range(n).select(
        F.when(hot, "hot").otherwise(F.concat(F.lit("i"), F.pmod("id", F.lit(400)).cast("string"))).alias("item_id"),
        (F.lit("2020-01-01").cast("timestamp_ntz") + F.floor(F.when(hot, F.col("id")).otherwise(F.col("id") / 400))
         * F.expr("INTERVAL '1' MINUTE")).alias("timestamp"),
        F.rand(1).alias("target"),
    ).cache()


def test_chunks_bound_every_group(skewed):
    halo = 1440
    groups = with_halo(with_step(skewed, "min"), halo).groupBy("item_id", "chunk").count()
    assert groups.agg(F.max("count")).first()[0] <= chunk_size(halo) + halo
    assert groups.filter("item_id = 'hot'").count() >= 20_000 // CHUNK
    assert chunk_size(CHUNK + 1) == 2 * CHUNK


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_windows_over_rows_are_chunked(skewed):
    frames = {
        "baseline": baseline_forecast(skewed, 3, "min", 60),
        "split": last_steps(skewed, 3, "min"),
        "regularize": regularize(skewed, "min"),
    }
    for name, frame in frames.items():
        for window in re.findall(r"windowspecdefinition\(([^)]*?), step#", plan(frame)):
            assert "chunk#" in window, (name, window)


def test_forecast_opens_rows_after_aggregating(skewed):
    text = plan(future_index(skewed, 5, "min"))
    assert text.index("Generate explode") < text.index("Aggregate [item_id")


def test_results_on_a_hot_item(skewed):
    states = {r.item_id: r.n for r in smoothing_states(skewed, "min").collect()}
    assert states["hot"] == 20_000 and len(states) == 401
    rows = baseline_forecast(skewed, 2, "min", 60, ["naive", "mean"])
    assert rows.count() == 401 * 2 * 2


def test_scan_reads_only_what_is_needed(spark, sf_dir):
    from tidecast.catalog import all_queries

    text = all_queries()["tab_align"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert schema.count(":") == 3


def test_backtest_reads_the_series_twice_at_most(spark, sf_dir):
    from tidecast.catalog import all_queries

    text = plan(all_queries()["fc_leaderboard"](spark, sf_dir))
    assert text.count("Relation [") <= 2
    assert plan(baseline_forecast(spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(
        "event_type AS item_id", "ts AS timestamp", "value AS target"), 3, "D", 7)).count("Relation [") == 1


def test_backtest_in_one_pass_is_the_backtest_by_joins(spark):
    n = F.col("id")
    series = spark.range(3000).select(
        F.concat(F.lit("i"), F.pmod(n, F.lit(7)).cast("string")).alias("item_id"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.floor(n / 7) * F.expr("INTERVAL '1' DAY")).alias("timestamp"),
        F.when(F.pmod(n, F.lit(11)) > 0, F.sin(n.cast("double")) * 10 + n / 100).alias("target"),
    ).where("pmod(id, 13) > 1").union(spark.createDataFrame(
        [("short", "2024-01-01", 1.0), ("nulls", "2024-01-16", None), ("nulls", "2024-01-20", None), ("nulls", "2024-01-21", 2.0)],
        "i string, t string, y double").selectExpr("i", "cast(t as timestamp_ntz)", "y"))
    marked = last_steps(series, 5, "D")
    history, held = holdout_split(series, 5, "D")
    joined = score_forecasts(baseline_forecast(history, 5, "D", 7), held, ["MAE", "RMSE", "WQL"], [0.1, 0.9])
    once = score_rows(backtest_rows(marked, 5, "D", 7), ["MAE", "RMSE", "WQL"], [0.1, 0.9])
    got, want = ({r.model: [r.mae, r.rmse, r.wql] for r in x.collect()} for x in (once, joined))
    assert set(got) == set(BASELINES)
    for model in BASELINES:
        assert got[model] == pytest.approx(want[model])
    rows = backtest_rows(marked, 5, "D", 7, ["seasonal_naive"], scale=True)
    assert rows.where("item_id = 'short'").isEmpty() and rows.where("item_id = 'nulls' AND mean IS NULL").count() == 2
    assert backtest_rows(marked.limit(0), 5, "D", 7).isEmpty()
