import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidecast.operators import smoothing
from tidecast.operators.smoothing import HOLT_GRID, SES_GRID, smoothing_states


def brute_force(steps, y, kind):
    """Smallest squared error over the grid, start state by least squares on the errors."""
    grid = [(a, 0.0) for a in SES_GRID] if kind == "ses" else [(a, a * s) for a, s in HOLT_GRID]
    best = None
    for alpha, beta in grid:

        def run(level, trend):
            errors = []
            for i, value in enumerate(y):
                if i and kind == "holt":
                    level += trend * (steps[i] - steps[i - 1] - 1)
                guess = level + trend
                errors.append(value - guess)
                level, trend = guess + alpha * errors[-1], trend + beta * errors[-1]
            return np.array(errors), np.array([level, trend])

        base, final = run(0.0, 0.0)
        starts = np.eye(2)[: 1 if kind == "ses" else 2]
        design = np.stack([base - run(*s)[0] for s in starts], axis=1)
        x = np.linalg.lstsq(design, base, rcond=1e-10)[0]
        start = np.zeros(2)
        start[: len(x)] = x
        errors, state = run(*start)
        sse = float((errors**2).sum())
        if best is None or round(sse, 6) < round(best[0], 6):
            best = (sse, alpha, beta, *state)
    return best


@pytest.mark.parametrize("kind", ["ses", "holt"])
@pytest.mark.parametrize("chunk", [4096, 8])
def test_matches_the_plain_recurrence(spark, monkeypatch, kind, chunk):
    monkeypatch.setattr(smoothing, "chunk_index", lambda step, size=chunk: ((step - F.pmod(step, F.lit(size))) / size).cast("bigint"))
    rng = np.random.default_rng(3)
    frames, expected = [], {}
    for i, n in enumerate([40, 3, 25, 33, 90]):
        steps = np.sort(rng.choice(np.arange(19700, 19700 + n + 10), n, replace=False))
        y = 50 + 0.5 * np.arange(n) + rng.normal(0, 3, n).cumsum()
        stamps = pd.to_datetime(steps, unit="D", origin="1970-01-01")
        frames.append(pd.DataFrame({"item_id": f"i{i}", "timestamp": stamps, "target": y}))
        expected[f"i{i}"] = brute_force(steps, y, kind)
    data = pd.concat(frames, ignore_index=True).sample(frac=1, random_state=1)
    series = spark.createDataFrame(data).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    got = {r.item_id: r for r in smoothing_states(series, "D", kind).collect()}
    assert set(got) == set(expected)
    for item, (sse, alpha, beta, level, trend) in expected.items():
        row = got[item]
        assert row.sse == pytest.approx(sse, rel=1e-6, abs=1e-5)
        assert (row.alpha, row.beta) == pytest.approx((alpha, beta))
        assert row.level == pytest.approx(level, rel=1e-6)
        assert row.trend == pytest.approx(trend, rel=1e-5, abs=1e-6)


def test_batches_may_cut_chunks_and_items(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        days = spark.range(60).select(
            (F.col("id") % 2).cast("string").alias("item_id"),
            (F.lit("2024-01-01").cast("timestamp_ntz") + F.floor(F.col("id") / 2) * F.expr("INTERVAL '1' DAY")).alias("timestamp"),
            (F.col("id") * 1.5 + F.pmod(F.col("id"), F.lit(5))).alias("target"),
        )
        small = {r.item_id: r for r in smoothing_states(days, "D", "holt").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    whole = {r.item_id: r for r in smoothing_states(days, "D", "holt").collect()}
    for item in whole:
        assert small[item].level == pytest.approx(whole[item].level)
        assert small[item].n == whole[item].n == 30


def test_duplicates_are_refused(spark):
    twice = spark.sql("select 'a' item_id, timestamp_ntz'2024-01-01' timestamp, 1.0D target from range(2)")
    with pytest.raises(Exception, match="duplicate timestamp"):
        smoothing_states(twice, "D").collect()
