"""Gaps by rank and quantiles of large groups: exact, and nothing large in one place."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidecast.functions.quantiles import _bracketed, group_quantiles
from tidecast.operators.series import infer_freq, item_frequency, stamp_gaps


def series(spark, rows):
    frame = spark.createDataFrame(rows, "item_id string, us long")
    stamp = F.lit("2024-01-01").cast("timestamp_ntz") + F.col("us") * F.expr("INTERVAL '0.000001' SECOND")
    return frame.select("item_id", stamp.alias("timestamp"), F.lit(1.0).alias("target"))


def brute(rows):
    out = {}
    for item in {i for i, _ in rows}:
        us = sorted(u for i, u in rows if i == item)
        for a, b in zip(us, us[1:]):
            out[item, b - a] = out.get((item, b - a), 0) + 1
    return out


def test_gaps_of_bursts_and_many_slices(spark):
    """A burst of most of the rows within a second of an item that spans a year."""
    rng = random.Random(2)
    day = 86_400_000_000
    rows = [("burst", 200 * day + i * 5) for i in range(20_000)] + [("burst", i * day) for i in range(365)]
    rows += [(f"i{j}", rng.randrange(10**12)) for j in range(40) for _ in range(rng.randrange(1, 60))] + [("twice", 7), ("twice", 7), (None, 3), (None, 9)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        gaps = stamp_gaps(series(spark, rows).repartition(5))
        got = {(r.item_id, r.gap_us): r.n for r in gaps.collect()}
        points = series(spark, rows).repartitionByRange(23, "item_id", "timestamp")
        largest = points.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got == brute(rows)
    assert largest < 0.2 * len(rows)  # no slice holds the burst
    plan = gaps._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 1 and "Join" not in plan


def test_items_without_a_code_disagree(spark):
    day = 86_400_000_000
    daily = [("d", i * day) for i in range(9)]
    odd = [("odd", i * 1_500) for i in range(9)]
    assert infer_freq(series(spark, [*daily, ("single", 5)])) == "D"
    assert {r.item_id: r.freq for r in item_frequency(series(spark, daily + odd)).collect()} == {"d": "D", "odd": None}
    with pytest.raises(ValueError, match="irregular"):
        infer_freq(series(spark, daily + odd))
    with pytest.raises(ValueError, match="irregular"):
        infer_freq(series(spark, odd))


@pytest.mark.parametrize(("accuracy", "few"), [(10_000, 1 << 20), (400, 50), (200, 1)])
def test_quantiles_of_groups(spark, accuracy, few):
    rng = random.Random(11)
    groups = {
        "distinct": [rng.uniform(-5, 5) for _ in range(6000)],
        "scales": [rng.choice([1e-300, 1e300, 1.0]) * rng.random() for _ in range(3000)],
        "ties": [float(rng.randrange(3)) for _ in range(4000)],
        "one": [4.0], "two": [1.0, 2.0], None: [3.0, 1.0, 2.0], "same": [8.0] * 2500,
    }
    rows = [(g, v, 1) for g, vs in groups.items() for v in vs] + [("one", None, 1), ("nothing", None, 1)]
    levels = [0.001, 0.25, 0.5, 0.77, 0.999]
    frame = spark.createDataFrame(rows, "v string, x double, n int").repartition(7)
    got = {r.v: list(r[1:]) for r in group_quantiles(frame, ["v"], "x", levels, accuracy, few).collect()}
    assert got.keys() == {*groups, "nothing"} and got["nothing"] == [None] * 5
    for g, vs in groups.items():
        assert got[g] == pytest.approx(np.quantile(vs, levels).tolist(), rel=1e-12), g


def test_quantiles_of_a_whole_or_empty_table(spark):
    frame = spark.range(101).select(F.col("id").cast("double").alias("x"))
    assert [tuple(r) for r in group_quantiles(frame, [], "x", [0.1, 0.5], 100, 5).collect()] == [(10.0, 50.0)]
    assert group_quantiles(frame.withColumn("k", F.lit(1)).limit(0), ["k"], "x", [0.5]).count() == 0


def test_brackets_are_made_once(spark, capsys):
    """A sketch may differ from run to run, so neither the rows left nor the ranks among them run it again."""
    left = spark.range(1000).select(F.lit("a").alias("g0"), F.lit(-1).alias("of"), F.col("id").cast("double").alias("v"))
    wanted = spark.createDataFrame([("a", 0, 499.5, 499, 0, 1000)], "g0 string, level int, place double, low long, skip long, n long")
    rows, after = _bracketed(left, wanted, ["g0"], 1000)
    rows.explain("extended")
    after.explain("extended")
    assert "percentile_approx" not in capsys.readouterr().out.lower()
    kept, rank = sorted(r.v for r in rows.collect()), after.first()
    assert len(kept) == rank.n and kept[rank.low - rank.skip : rank.low - rank.skip + 2] == [499.0, 500.0]
