"""Forecast requests: row-valued options, fitted models, refusals, long tables."""

import json
import random
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from tidecast.functions.frequency import Frequency, named_frequency, season_named
from tidecast.functions.quantiles import z_column
from tidecast.operators.baseline import BASELINES, baseline_forecast
from tidecast.plans.forecast import ForecastEstimator, ForecastModel
from tidecast.sources.nested import parse_bodies, series_from_requests
from tidecast.streaming.queries import read_stream
from tidecast.streaming.requests import (
    answer_requests,
    answer_with,
    forecast_requests,
    forecast_stream,
    forecast_tables,
    judge_for,
    read_refused,
    refused,
)


def bodies(spark, rows):
    return spark.createDataFrame([(i, b if isinstance(b, (str, type(None))) else json.dumps(b)) for i, b in rows], "request_id string, body string")


def request(target, freq="D", horizon=2, levels=(0.1, 0.9), **item):
    return {"inputs": [{"target": target, **item}], "parameters": {"freq": freq, "prediction_length": horizon, "quantile_levels": list(levels)}}


def test_levels_as_values(spark):
    levels = [1e-12, 1e-7, 0.001, 0.025, 0.074, 0.3, 0.5, 0.6, 0.925, 0.99, 1 - 1e-9]
    got = spark.createDataFrame([(q,) for q in [*levels, 0.0, 1.0]], "q double").select("q", z_column(F.col("q")).alias("z")).collect()
    for q, z in got:
        assert z is None if q in (0, 1) else z == pytest.approx(NormalDist().inv_cdf(q), rel=1e-13, abs=1e-13)


def test_frequencies_as_values(spark):
    texts = ["D", "2D", "7D", "H", "6h", "W", "W-TUE", "2W-TUE", "B", "M", "3MS", "QE", "30min", "s", "A"]
    rows = spark.createDataFrame([(t,) for t in [*texts, "x", "0D", "W-ABC", ""]], "t string")
    got = {r.t: (r.f, r.s) for r in rows.select("t", named_frequency(F.col("t")).alias("f"), season_named(F.col("t")).alias("s")).collect()}
    assert {t: got[t] for t in texts} == {t: (str(Frequency.parse(t)), Frequency.parse(t).season) for t in texts}
    assert all(got[t][0] is None for t in ("x", "0D", "W-ABC", ""))


@pytest.mark.parametrize("model", BASELINES)
def test_same_as_series_forecasts(spark, model):
    """Every closed form against the forecaster of long series, per frequency, gaps included."""
    rng = random.Random(3)
    lists = [[rng.choice([None, rng.uniform(0, 9), rng.uniform(0, 9)]) for _ in range(n)] + [2.5, None][: n % 3 and 2] for n in (1, 5, 40, 130)]
    asked = [(f"{freq}{i}", request(t, freq, start=start)) for freq, start in (("D", "2024-02-27"), ("h", "2024-01-01T05:00:00"), ("W-MON", "2024-01-01"), ("MS", "2023-11-01")) for i, t in enumerate(lists)]
    table = bodies(spark, asked)
    got = {(r.request_id, r.timestamp): (r["mean"], r["quantiles"]) for r in answer_requests(judge_for(model, table), model).collect()}
    assert len(got) == 2 * len(asked)
    for freq in ("D", "h", "W-MON", "MS"):
        items = parse_bodies(table).where(F.col("freq") == freq)
        series = series_from_requests(items).select(F.col("request_id").alias("item_id"), "timestamp", "target")
        for r in baseline_forecast(series, 2, freq, Frequency.parse(freq).season, [model]).collect():
            mean, quantiles = got[r.item_id, r.timestamp]
            assert mean == (r["mean"] if r["mean"] is None else pytest.approx(r["mean"], rel=1e-9))
            if mean is not None:
                spread = NormalDist().inv_cdf(0.9) * (r.sigma or 0)
                assert quantiles == {"0.1": pytest.approx(mean - spread, rel=1e-9), "0.9": pytest.approx(mean + spread, rel=1e-9)}


def test_plan_does_not_grow_with_requests(spark):
    def plan(n):
        rows = [(f"r{i}", request([1, 2, i], ["D", "h", "MS"][i % 3], 1 + i % 4, [0.001 * (i + 1)])) for i in range(n)]
        frame = answer_requests(judge_for("naive", bodies(spark, rows).repartition(2)))
        assert frame.count() == sum(1 + i % 4 for i in range(n))
        return len(frame._jdf.queryExecution().optimizedPlan().toString())

    assert abs(plan(60) - plan(2)) < 500


def test_odd_requests(spark):
    same = request([1, 2, 3], item_id="x")
    rows = [("a", same), ("a", same), ("a", request([9], item_id="x")), (None, request([4.0, 5.0])), ("e", request([])), ("n", request([None, None]))]
    got = sorted(((r.request_id, r.item_id, str(r.timestamp)[:10], r["mean"]) for r in forecast_requests(bodies(spark, rows), "naive").collect()), key=repr)
    assert got == sorted(
        [("a", "x", "2020-01-04", 3.0), ("a", "x", "2020-01-05", 3.0), ("a", "x", "2020-01-02", 9.0), ("a", "x", "2020-01-03", 9.0),
         (None, "0", "2020-01-03", 5.0), (None, "0", "2020-01-04", 5.0), ("e", "0", "2020-01-01", None), ("e", "0", "2020-01-02", None),
         ("n", "0", "2020-01-03", None), ("n", "0", "2020-01-04", None)], key=repr,
    )
    assert forecast_requests(bodies(spark, rows).limit(0), "naive").count() == 0


FAULTY = {
    "broken": ('{"inputs": [{"target": [1', "not the JSON"),
    "nothing": (None, "not the JSON"),
    "no inputs": ({"parameters": {}}, "needs `inputs`"),
    "no target": ({"inputs": [{"target": [1]}, {"item_id": "q"}]}, "no `target`"),
    "text": ({"inputs": [{"target": "many"}]}, "not the JSON"),
    "freq": (request([1], "fortnight"), "unknown frequency"),
    "start": (request([1], start="soon"), "no timestamp"),
    "horizon": (request([1], horizon=0), "at least 1"),
    "level": (request([1], levels=[0.5, 1.0]), "between 0 and 1"),
    "some": ({"inputs": [{"target": [1], "future_covariates": {"p": [1]}}, {"target": [1]}]}, "either all items or none"),
    "short": (request([1], future_covariates={"p": [1]}), "one value per horizon step"),
    "large": (request([1.25] * 400), "more than 1000 bytes"),
}


def test_every_fault_is_told_apart(spark):
    table = bodies(spark, [*((k, b) for k, (b, _) in FAULTY.items()), ("good", request([1, 2]))])
    judged = judge_for("naive", table, max_bytes=1000)
    found = {r.request_id: r.error for r in refused(judged).collect()}
    assert found.keys() == FAULTY.keys()
    assert all(FAULTY[k][1] in error for k, error in found.items())
    assert {r.request_id for r in answer_requests(judged, "naive").collect()} == {"good"}
    with pytest.raises(Exception, match="request freq: unknown frequency"):
        forecast_requests(table.where("request_id = 'freq'"), "naive").collect()


@pytest.fixture(scope="module")
def promo(spark):
    """(series, known, static) with a covariate, a text static feature and a numeric one."""
    rng = random.Random(8)
    rows, future = [], []
    for item, size in (("a", 1.0), ("b", 3.0), ("c", 7.0)):
        for t in range(63):
            on = float(rng.random() < 0.4)
            row = (item, t, 10 * size + 4 * on + t % 7, on if t % 11 else None)
            (rows if t < 60 else future).append(row)
    frame = lambda x: spark.createDataFrame(x, "item_id string, t int, target double, promo double").select(
        "item_id", (F.lit("2024-01-01").cast("timestamp_ntz") + F.col("t") * F.expr("INTERVAL '1' DAY")).alias("timestamp"), "target", "promo"
    )
    static = spark.createDataFrame([("a", "x", 1.0), ("b", "y", 3.0), ("c", "x", 7.0)], "item_id string, kind string, size double")
    return frame(rows), frame(future).drop("target").fillna(0.0), static


@pytest.fixture(scope="module")
def regression(promo):
    series, _, static = promo
    options = {"lag_regression": {"lags": [3, 7], "hash_size": 16, "reg_param": 0.1}}
    return ForecastEstimator(prediction_length=3, freq="D", quantile_levels=[0.2, 0.8], known_covariates_names=["promo"]).fit(
        series, static_features=static, hyperparameters=options
    )


def rows_of(frame):
    return sorted(tuple(round(v, 8) if isinstance(v, float) else v for v in r) for r in frame.collect())


def test_saved_regression_predicts_the_same(spark, promo, regression, tmp_path):
    """Means, lags and hash size come back, so null covariates count as before."""
    series, known, static = promo
    regression.save(spark, f"{tmp_path}/m")
    again = ForecastModel.load(spark, f"{tmp_path}/m")
    assert again.regression.state() == regression.regression.state()
    assert again.regression.means.keys() == {"promo", "size"} and again.regression.text == ["kind"]
    before = rows_of(regression.predict(series, known, static))
    assert len(before) == 9
    assert rows_of(again.predict(series, known, static)) == before


def bodies_of(promo):
    series, known, static = promo
    packed = series.groupBy("item_id").agg(F.sort_array(F.collect_list(F.struct("timestamp", "target", "promo"))).alias("r"))
    ahead = known.groupBy("item_id").agg(F.sort_array(F.collect_list(F.struct("timestamp", "promo"))).alias("f"))
    item = F.struct(
        "item_id",
        F.lit("2024-01-01").alias("start"),
        F.transform("r", lambda r: r["target"]).alias("target"),
        F.struct(F.transform("r", lambda r: r["promo"]).alias("promo")).alias("past_covariates"),
        F.struct(F.transform("f", lambda r: r["promo"]).alias("promo")).alias("future_covariates"),
        F.struct("kind", "size").alias("static_features"),
    )
    body = F.to_json(F.struct(F.array(item).alias("inputs")))
    return packed.join(ahead, "item_id").join(static, "item_id").select(F.concat(F.lit("r-"), "item_id").alias("request_id"), body.alias("body"))


def test_fitted_model_answers_bodies(spark, promo, regression, tmp_path):
    """Past and future covariates and static features from bodies: the same as from tables."""
    expected = rows_of(regression.predict(*promo))
    asked = bodies_of(promo)
    answers = answer_with(regression, judge_for(regression, asked))
    got = rows_of(answers.select("item_id", "timestamp", "mean", F.col("quantiles")["0.2"], F.col("quantiles")["0.8"]))
    assert got == expected
    assert {r.request_id for r in answers.collect()} == {"r-a", "r-b", "r-c"}

    bare = [("bare", request([1.0] * 9, horizon=5)), ("hourly", request([1.0] * 9, "h", future_covariates={"promo": [1, 1, 1]}))]
    bare.append(("short", request([1.0] * 9, future_covariates={"promo": [1, 1]})))
    asked.union(bodies(spark, bare)).write.json(f"{tmp_path}/in")
    stream = read_stream(spark, f"{tmp_path}/in", "request_id string, body string", "application/jsonl")
    forecast_stream(
        stream, "fitted", f"{tmp_path}/out", f"{tmp_path}/state", regression, available_now=True, errors=f"{tmp_path}/bad"
    ).awaitTermination()
    assert rows_of(spark.read.parquet(f"{tmp_path}/out").select("item_id", "timestamp", "mean", F.col("quantiles")["0.2"], F.col("quantiles")["0.8"])) == expected
    errors = {r.request_id: r.error for r in read_refused(spark, f"{tmp_path}/bad").collect()}
    assert errors == {
        "bare": "the model needs future values of promo",
        "hourly": "the model's frequency is D",
        "short": "promo must have one value per horizon step",
    }


def test_long_tables_of_several_requests(spark, promo, regression):
    """Equal item ids in different requests are different series; columns go by the requests' names."""
    series, known, static = promo
    two = spark.createDataFrame([("p",), ("q",)], "request_id string")
    renamed = {"item_id": "shop", "timestamp": "day"}
    rows, ahead, shops = (t.withColumnsRenamed(renamed).crossJoin(two) for t in (series, known, static))
    got = forecast_tables(regression, rows, ahead, shops, id_column="shop", timestamp_column="day")
    expected = rows_of(regression.predict(series, known, static))
    for r in ("p", "q"):
        mine = got.where(F.col("request_id") == r)
        assert rows_of(mine.select("item_id", "timestamp", "mean", F.col("quantiles")["0.2"], F.col("quantiles")["0.8"])) == expected
    with pytest.raises(ValueError, match="the requests lack day"):
        forecast_tables(regression, series.crossJoin(two), timestamp_column="day")


def test_files_are_requests(spark, tmp_path):
    spark.range(4).select("id").repartition(2).write.parquet(f"{tmp_path}/in")
    stream = read_stream(spark, f"{tmp_path}/in", "id long", file_column="request_id")
    query = stream.writeStream.format("memory").queryName("files").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("files").select("request_id").distinct().count() == 2


def test_what_never_changes_gets_no_weight(spark):
    """Training in one month only: the month's position must not move forecasts of the next one."""
    rows = [("a", t, float(10 + t % 7), 1.0) for t in range(28)] + [("b", t, float(30 + t % 7), 1.0) for t in range(28)]
    series = spark.createDataFrame(rows, "item_id string, t int, target double, flag double").select(
        "item_id", (F.lit("2024-01-04").cast("timestamp_ntz") + F.col("t") * F.expr("INTERVAL '1' DAY")).alias("timestamp"), "target", "flag"
    )
    estimator = ForecastEstimator(prediction_length=7, freq="D", known_covariates_names=["flag"])
    model = estimator.fit(series, hyperparameters={"lag_regression": {"lags": [7]}})
    assert model.regression.model.stages[0].getInputCols() == ["lag_7", "season_sin", "season_cos"]
    known = series.select("item_id", (F.col("timestamp") + F.expr("INTERVAL '28' DAY")).alias("timestamp"), F.lit(0.0).alias("flag"))
    got = {(r.item_id, r.timestamp.day): r["mean"] for r in model.predict(series, known).collect()}
    assert all(v == pytest.approx((10 if i == "a" else 30) + (d - 1 + 28) % 7, abs=1e-3) for (i, d), v in got.items())


def test_long_requests_are_bounded(spark):
    """The size of a request, which lies within one file, doesn't grow with the number of suppliers."""
    from tidecast.catalog import requests

    sizes = spark.range(5000).select(requests._request_of(F.col("id").cast("string")).alias("r")).groupBy("r").count().collect()
    assert len(sizes) >= 3 * 5000 // requests.REQUEST_ITEMS and max(r["count"] for r in sizes) <= requests.REQUEST_ITEMS
