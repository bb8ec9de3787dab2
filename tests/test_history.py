"""The stored rolling history: one current version, ties by an order, repeated micro-batches."""

import os
import random

from pyspark.sql import functions as F

from tidecast.streaming.history import _merge, read_history, run_history
from tidecast.streaming.queries import RateLimits, read_stream

SCHEMA = "item_id string, t long, target double, seq long"


def frame(spark, rows):
    stamp = F.lit("2024-01-01").cast("timestamp_ntz") + F.col("t") * F.expr("INTERVAL '1' HOUR")
    return spark.createDataFrame(rows, SCHEMA).select("item_id", stamp.alias("timestamp"), "target", "seq")


def current(spark, output):
    return sorted((r.item_id, r.timestamp.day * 24 + r.timestamp.hour - 24, r.target) for r in read_history(spark, output).collect())


def test_one_version_whatever_the_batches(spark, tmp_path):
    rng = random.Random(6)
    rows = [(f"i{rng.randrange(9)}", rng.randrange(40), float(k), rng.randrange(1000)) for k in range(300)]
    rows = [(i, t, y, s * 1000 + k) for k, (i, t, y, s) in enumerate(rows)]  # no two alike
    best = {}
    for i, t, y, s in rows:
        if s > best.get((i, t), (-1, 0))[0]:
            best[i, t] = (s, y)
    want = sorted((i, t, y) for (i, t), (_, y) in best.items() if sum(j == i and u > t for j, u in best) < 5)
    random.Random(1).shuffle(rows)
    for part in range(6):
        frame(spark, rows[part::6]).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = read_stream(spark, f"{tmp_path}/in", frame(spark, rows[:1]).schema, limits=RateLimits(max_files=1))
    run_history(stream, 5, "h", f"{tmp_path}/out", f"{tmp_path}/state", order="seq", buckets=4)
    assert current(spark, f"{tmp_path}/out") == want
    assert read_history(spark, f"{tmp_path}/out").count() == len(want)
    assert len(os.listdir(f"{tmp_path}/out/versions")) <= 4  # two lists, and their check sums
    held = sum(len([b for b in os.listdir(f"{tmp_path}/out/data/{v}") if b.startswith("bucket=")]) for v in os.listdir(f"{tmp_path}/out/data"))
    assert held <= 2 * 4  # the current version of each of four parts and at most the one before


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    out = f"{tmp_path}/out"
    assert read_history(spark, out).count() == 0
    batch = lambda rows: frame(spark, [(i, t, y, 0) for i, t, y in rows]).drop("seq")
    _merge(batch([("a", 1, 1.0), ("b", 1, 2.0)]), 0, out, 2)
    for _ in range(2):
        _merge(batch([("a", 1, 1.0), ("a", 2, 3.0), ("c", 5, 4.0)]), 1, out, 2)
        assert current(spark, out) == [("a", 1, 1.0), ("a", 2, 3.0), ("b", 1, 2.0), ("c", 5, 4.0)]
    _merge(batch([]), 2, out, 2)
    assert len(current(spark, out)) == 4


def test_merging_takes_no_step_per_item(spark, tmp_path, monkeypatch):
    """Ranks hold across micro-batches, and no Python worker is asked: thousands of items are merged natively."""
    from tidecast.streaming import history

    def refuse(*_):
        raise AssertionError("rows went through Python")

    monkeypatch.setattr(history, "rolling_history", refuse)
    first = [(f"i{k}", t, float(t), 9) for k in range(3000) for t in range(3)]
    then = [(f"i{k}", t, -1.0, 5 if t < 3 else 1) for k in range(3000) for t in range(1, 4)] + [(None, 1, 1.0, 1)]
    frame(spark, first).coalesce(1).write.parquet(f"{tmp_path}/in")
    for rows in (None, then):
        if rows:
            frame(spark, rows).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = read_stream(spark, f"{tmp_path}/in", frame(spark, first[:1]).schema, limits=RateLimits(max_files=1))
        run_history(stream, 3, "h", f"{tmp_path}/out", f"{tmp_path}/state", order="seq", buckets=2)
    want = sorted((f"i{k}", t, y) for k in range(3000) for t, y in ((1, 1.0), (2, 2.0), (3, -1.0)))
    assert current(spark, f"{tmp_path}/out") == want


def test_history_in_state(spark, tmp_path):
    """``rolling_history`` by itself: each updated item's latest rows, the highest rank first."""
    from tidecast.streaming.history import STATE_STORE, rolling_history

    seen = {}
    frame(spark, [("a", 1, 1.0, 2), ("a", 1, 9.0, 1), ("a", 2, 2.0, 1), ("a", 3, 3.0, 1), ("b", 1, 4.0, 1)]).coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = read_stream(spark, f"{tmp_path}/in", SCHEMA.replace("t long", "timestamp timestamp_ntz"))

    def handle(batch, _):
        for r in batch.collect():
            seen.setdefault(r.item_id, []).append(r.target)

    spark.conf.set(*STATE_STORE)
    try:
        writer = rolling_history(stream, 3, "seq").writeStream.outputMode("update").trigger(availableNow=True)
        writer.option("checkpointLocation", f"{tmp_path}/state").foreachBatch(handle).start().awaitTermination()
    finally:
        spark.conf.unset(STATE_STORE[0])
    assert {k: sorted(v) for k, v in seen.items()} == {"a": [1.0, 2.0, 3.0], "b": [4.0]}
