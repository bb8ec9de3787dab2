import pytest
from pyspark.sql import functions as F

from tidecast.plans.tabular import TabularEstimator
from tidecast.streaming.queries import RateLimits, find, read_stream, run_available, start, stop
from tidecast.streaming.scoring import (
    forecast_requests,
    forecast_stream,
    predict_proba_stream,
    predict_stream,
    read_forecasts,
    with_side_inputs,
)


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(200).select(
        "id", (F.col("id") % 7).cast("double").alias("x"), F.when(F.col("id") % 7 > 3, "up").otherwise("down").alias("y")
    )


@pytest.fixture(scope="module")
def model(rows):
    return TabularEstimator("y", ignore_columns=["id"]).fit(rows, hyperparameters=["tree"])


def test_stream_equals_batch_and_resumes(spark, rows, model, tmp_path):
    source, output, state = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state"
    rows.drop("y").filter("id < 100").repartition(3).write.parquet(source)
    stream = read_stream(spark, source, "id bigint, x double", limits=RateLimits(max_files=1))
    run_available(predict_proba_stream(model, stream, ["id"]), "scores", output, state)
    assert spark.read.parquet(output).count() == 100
    rows.drop("y").filter("id >= 100").write.mode("append").parquet(source)
    run_available(predict_proba_stream(model, stream, ["id"]), "scores", output, state)
    got = sorted(map(tuple, spark.read.parquet(output).collect()))
    assert got == sorted(map(tuple, model.score(rows, keys=["id"]).collect()))
    assert sorted(predict_stream(model, stream, ["id"]).columns) == ["id", "y"]


def test_named_queries_start_and_stop(spark, rows, model, tmp_path):
    source = f"{tmp_path}/in"
    rows.drop("y").write.json(source)
    stream = read_stream(spark, source, "id bigint, x double", "application/jsonl")
    query = start(predict_stream(model, stream, ["id"]), "endpoint", f"{tmp_path}/out", f"{tmp_path}/state", "text/csv")
    assert find(spark, "endpoint") is not None
    query.processAllAvailable()
    assert stop(spark, "endpoint") and not stop(spark, "endpoint")
    assert spark.read.csv(f"{tmp_path}/out", header=True).count() == 200


def test_rate_limits():
    assert RateLimits(max_bytes="6m").options() == {"maxBytesPerTrigger": "6m"}
    with pytest.raises(ValueError):
        RateLimits(1, "6m").options()


BODIES = [
    ("a", '{"inputs": [{"item_id": "x", "target": [1, 2, 3]}, {"item_id": "x", "target": [9]}], "parameters": {"prediction_length": 2}}'),
    ("b", '{"inputs": [{"item_id": "x", "start": "2024-01-31", "target": [5, 6]}], "parameters": {"freq": "MS", "quantile_levels": [0.9, 0.5]}}'),
]


def test_forecast_stream_equals_batch(spark, tmp_path):
    bodies = spark.createDataFrame(BODIES, "request_id string, body string")
    batch = forecast_requests(bodies, "naive", [0.5])
    rows = {(r.request_id, r.pos, r.item_id, str(r.timestamp), r["mean"]) for r in batch.collect()}
    assert rows == {
        ("a", 0, "x", "2020-01-04 00:00:00", 3.0),
        ("a", 0, "x", "2020-01-05 00:00:00", 3.0),
        ("a", 1, "x", "2020-01-02 00:00:00", 9.0),
        ("a", 1, "x", "2020-01-03 00:00:00", 9.0),
        ("b", 0, "x", "2024-04-01 00:00:00", 6.0),
    }
    assert {"0.5", "0.9"} <= set(batch.columns)
    bodies.repartition(2).write.json(f"{tmp_path}/in")
    stream = read_stream(spark, f"{tmp_path}/in", "request_id string, body string", "application/jsonl", RateLimits(1))
    query = forecast_stream(stream, "f", f"{tmp_path}/out", f"{tmp_path}/state", "naive", [0.5], available_now=True)
    query.awaitTermination()
    got = read_forecasts(spark, f"{tmp_path}/out").collect()
    assert {(r.request_id, r.pos, r.item_id, str(r.timestamp), r["mean"]) for r in got} == rows


def test_side_inputs(spark, tmp_path):
    series = spark.sql("select 'a' item_id, timestamp_ntz'2024-01-01' timestamp, 1D target union all select 'b', timestamp_ntz'2024-01-01', 2D")
    series.write.parquet(f"{tmp_path}/in")
    static = spark.sql("select 'a' item_id, 'big' size")
    known = spark.sql("select 'b' item_id, timestamp_ntz'2024-01-01' timestamp, 7D promo")
    stream = with_side_inputs(read_stream(spark, f"{tmp_path}/in", series.schema), static, known)
    run_available(stream, "side", f"{tmp_path}/out", f"{tmp_path}/state")
    got = {r.item_id: (r["size"], r.promo) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {"a": ("big", None), "b": (None, 7.0)}


def test_rolling_history(spark, tmp_path):
    from tidecast.streaming.history import read_history, run_history

    def rows(low, high):
        return spark.range(low, high).select(
            F.concat(F.lit("i"), (F.col("id") % 3).cast("string")).alias("item_id"),
            (F.lit("2024-01-01").cast("timestamp_ntz") + F.col("id") * F.expr("INTERVAL '1' HOUR")).alias("timestamp"),
            F.col("id").cast("double").alias("target"),
        )

    def update():
        stream = read_stream(spark, f"{tmp_path}/in", rows(0, 1).schema)
        run_history(stream, 4, "history", f"{tmp_path}/out", f"{tmp_path}/state")
        return sorted((r.item_id, r.target) for r in read_history(spark, f"{tmp_path}/out").collect())

    rows(0, 30).write.parquet(f"{tmp_path}/in")
    assert update() == sorted((f"i{i % 3}", float(i)) for i in range(18, 30))
    rows(30, 32).write.mode("append").parquet(f"{tmp_path}/in")
    assert update() == sorted([(f"i{i % 3}", float(i)) for i in range(21, 32)] + [("i2", 20.0)])
