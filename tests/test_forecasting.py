import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidecast.operators import chunks
from tidecast.operators.baseline import baseline_forecast, item_statistics
from tidecast.operators.leaderboard import greedy_weights
from tidecast.operators.series import (
    check_forecast,
    future_index,
    holdout_split,
    infer_freq,
    missing_covariates,
    regularize,
)
from tidecast.plans.forecast import ForecastEstimator, ForecastModel, check_duplicates, forecast
from tidecast.plans.registry import merge_settings, preset
from tidecast.sources.nested import (
    covariates_from_nested_json,
    forecast_to_nested_json,
    response_bodies,
    series_from_nested_json,
)

H = 4


@pytest.fixture(scope="module")
def frame():
    """Five items of 30 days: a slow wave plus noise."""
    noise = np.random.default_rng(42)
    days = pd.date_range("2024-01-01", periods=30)
    parts = [
        pd.DataFrame(
            {"item_id": str(i), "timestamp": days, "target": np.sin(np.arange(30) / 5) + noise.normal(0, 0.1, 30)}
        )
        for i in range(5)
    ]
    return pd.concat(parts, ignore_index=True)


@pytest.fixture(scope="module")
def series(spark, frame):
    return spark.createDataFrame(frame).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")).cache()


def complete(table, series, horizon=H):
    assert {"item_id", "timestamp", "mean"} <= set(table.columns)
    assert check_forecast(table, series, horizon).count() == 0


@pytest.mark.parametrize("model", ["naive", "seasonal_naive", "mean", "drift", "trend", "ses", "holt", "lag_regression"])
def test_every_model_gives_a_whole_forecast(series, model):
    table = forecast(series, H, freq="D", model=model, quantile_levels=[0.9, 0.1, 0.5])
    assert table.columns == ["item_id", "timestamp", "mean", "0.1", "0.5", "0.9"]
    complete(table, series)
    for r in table.collect():
        assert r["0.1"] <= r["0.5"] <= r["0.9"] and r["0.5"] == pytest.approx(r["mean"])
        assert r.timestamp.isoformat() >= "2024-01-31"


def test_default_levels_names_and_frequency(spark, series):
    named = series.withColumnsRenamed({"item_id": "store", "timestamp": "day", "target": "sales"})
    table = forecast(named, 2, "sales", "store", "day", keep_names=True)
    assert table.columns == ["store", "day", "mean", *(f"0.{i}" for i in range(1, 10))]
    assert table.count() == 10


def test_short_and_lonely_items(spark):
    rows = spark.sql(
        "select * from values ('one', timestamp_ntz'2024-01-01', 5D), ('two', timestamp_ntz'2024-01-01', 1D), "
        "('two', timestamp_ntz'2024-01-02', 3D) t(item_id, timestamp, target)"
    )
    for model in ("naive", "seasonal_naive", "mean", "drift", "trend", "ses", "holt"):
        table = forecast(rows, 3, freq="D", model=model, quantile_levels=[0.5])
        complete(table, rows, 3)
        assert {r["mean"] for r in table.collect() if r.item_id == "one"} == {5.0}, model


def test_chunks_do_not_change_results(spark, monkeypatch):
    steps = np.arange(400)
    keep = np.random.default_rng(5).random(400) < 0.8
    stamps = pd.Timestamp("2023-12-01") + pd.to_timedelta(steps[keep], unit="h")
    data = pd.DataFrame({"item_id": "a", "timestamp": stamps, "target": np.sin(steps[keep]) * 10 + steps[keep]})
    series = spark.createDataFrame(data).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))

    def run():
        stats = item_statistics(series, "h", 24, scale=True).drop("by_phase").first().asDict()
        filled = regularize(series, "h", "ffill").orderBy("timestamp").toPandas()
        return stats, filled

    whole, filled = run()
    monkeypatch.setattr(chunks, "CHUNK", 32)
    monkeypatch.setattr("tidecast.operators.series.CHUNK", 32)
    monkeypatch.setattr(
        "tidecast.operators.series.chunk_index",
        lambda step, size=32: ((step - F.pmod(step, F.lit(size))) / size).cast("bigint"),
    )
    small, refilled = run()
    numbers = {k: v for k, v in whole.items() if isinstance(v, (int, float))}
    assert {k: small[k] for k in numbers} == pytest.approx(numbers)
    pd.testing.assert_frame_equal(filled, refilled)
    expected = data.set_index("timestamp").target.asfreq("h").ffill()
    assert filled.target.tolist() == pytest.approx(expected.tolist())
    lagged = data.set_index("timestamp").target
    seasonal = (lagged - lagged.asfreq("h").shift(24).reindex(lagged.index)).dropna()
    assert whole["ss_dm"] == pytest.approx((seasonal**2).sum()) and whole["nm"] == len(seasonal)


def test_duplicates_are_refused(series):
    twice = series.unionByName(series.filter("item_id = '0'"))
    with pytest.raises(ValueError, match="duplicate"):
        check_duplicates(twice)
    for run in (lambda: baseline_forecast(twice, H, "D", 7, ["naive"]), lambda: regularize(twice, "D")):
        with pytest.raises(Exception, match="duplicate timestamp for item 0"):
            run().collect()


def test_frequency_is_inferred_or_refused(spark, series):
    assert infer_freq(series) == "D"
    for freq in ("15min", "h", "2D", "W-WED", "MS", "ME", "QS", "B"):
        stamps = pd.date_range("2024-01-03", periods=20, freq=freq)
        table = spark.createDataFrame(pd.DataFrame({"item_id": "a", "timestamp": stamps, "target": 1.0}))
        table = table.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
        assert infer_freq(table) == freq
        mixed = table.unionByName(series)
        with pytest.raises(ValueError, match="pass freq"):
            infer_freq(mixed)


def test_selection_and_named_candidates(spark, series, tmp_path):
    estimator = ForecastEstimator(prediction_length=H, freq="D", eval_metric="MASE", quantile_levels=[0.1, 0.9])
    estimator.register("always_one", lambda s, h, f, m: baseline_forecast(s, h, f, m, ["naive"]).withColumn("mean", F.lit(1.0)))
    names = ["naive", "drift", "ses", "lag_regression", "always_one", "ensemble"]
    model = estimator.fit(series, hyperparameters=names)
    board = [tuple(r) for r in model.leaderboard(spark).select("model", "score_val").collect()]
    assert {n for n, _ in board} == set(names)
    assert board == sorted(board, key=lambda r: (-r[1], r[0])) and model.best == board[0][0]
    complete(model.predict(series), series)
    complete(model.predict(series, model="lag_regression"), series)
    with pytest.raises(ValueError, match="already fitted"):
        estimator.fit(series)
    with pytest.raises(TypeError, match="quantile_levels"):
        model.predict(series, quantile_levels=[0.5])
    with pytest.raises(ValueError, match="probabilities"):
        model.predict_proba(series)
    with pytest.raises(ValueError, match="not a candidate"):
        model.predict(series, model="trend")
    model.best = "always_one"
    with pytest.raises(ValueError, match="cannot be saved"):
        model.save(spark, f"{tmp_path}/m")
    for model.best in ("naive", "lag_regression"):
        model.save(spark, f"{tmp_path}/m")
        again = ForecastModel.load(spark, f"{tmp_path}/m").predict(series)
        left = model.predict(series).orderBy("item_id", "timestamp").toPandas()
        pd.testing.assert_frame_equal(left, again.orderBy("item_id", "timestamp").toPandas())


def test_tuning_data_and_time_limit(series):
    other = series.withColumn("target", F.col("target") * 2)
    model = ForecastEstimator(prediction_length=H, freq="D", eval_metric="MAE").fit(
        series, other, hyperparameters=["naive", "ses", "holt"], time_limit=0
    )
    assert [s[0] for s in model.scores] == ["naive"]


def test_known_covariates(series):
    promo = series.withColumn("promo", (F.dayofmonth("timestamp") % 3).cast("double"))
    known = future_index(series, H, "D").withColumn("promo", F.lit(1.0))
    static = series.select("item_id").distinct().withColumn("category", F.concat(F.lit("cat_"), F.col("item_id")))
    estimator = ForecastEstimator(prediction_length=H, freq="D", known_covariates_names=["promo"])
    model = estimator.fit(promo, static_features=static, hyperparameters={"lag_regression": {"lags": [4, 7]}})
    complete(model.predict(promo, known, static), series)
    with pytest.raises(ValueError, match="pass known_covariates"):
        model.predict(promo, static_features=static)
    short = known.filter(F.col("timestamp") < "2024-02-03")
    assert missing_covariates(future_index(series, H, "D"), short).count() == 5
    with pytest.raises(ValueError, match="do not cover"):
        model.predict(promo, short, static)
    with pytest.raises(ValueError, match="static features"):
        model.predict(promo, known)
    with pytest.raises(ValueError, match="lacks"):
        ForecastEstimator(known_covariates_names=["price"]).fit(promo)
    # Models that cannot use covariates ignore them.
    complete(forecast(promo, H, freq="D", model="naive", known_covariates=known, static_features=static), series)
    with pytest.raises(ValueError, match="would use unknown values"):
        forecast(series, H, freq="D", model="lag_regression", hyperparameters={"lags": [2]})


def test_holdout(series):
    history, held = holdout_split(series, H, "D")
    assert history.count() == 5 * 26 and held.count() == 5 * H
    assert held.selectExpr("min(timestamp)").first()[0].isoformat() == "2024-01-27T00:00:00"


def test_greedy_weights_lower_the_error():
    products = {("a", "a"): 4.0, ("b", "b"): 4.0, ("a", "b"): -2.0, ("b", "a"): -2.0, ("c", "c"): 9.0}
    products |= {(x, "c"): 3.0 for x in "ab"} | {("c", x): 3.0 for x in "ab"}
    weights = greedy_weights(products, ["a", "b", "c"])
    assert weights == {"a": 0.5, "b": 0.5}


def test_settings_layers():
    assert merge_settings("linear", {"maxIter": 5}, {"maxIter": 7, "elasticNetParam": 1.0}) == {
        "regParam": 0.0,
        "maxIter": 7,
        "elasticNetParam": 1.0,
    }
    with pytest.raises(ValueError, match="unknown preset"):
        preset({"a": ("x",)}, "b", "a")


# -- nested requests -----------------------------------------------------------------------------


def bodies(spark, *texts):
    return spark.createDataFrame([(f"r{i}", t) for i, t in enumerate(texts)], "request_id string, body string")


def test_request_defaults(spark):
    out = series_from_nested_json(
        bodies(
            spark,
            '{"inputs": [{"target": [1, 2]}, {"item_id": 7, "start": "2024-01-31T05:00:00", "target": [3, null]}]}',
            '{"inputs": [{"start": "2024-01-31", "target": [1, 2, 3]}], "parameters": {"freq": "MS"}}',
        )
    )
    got = [(r.request_id, r.item_id, r.timestamp.isoformat(), r.target) for r in out.orderBy("request_id", "pos", "timestamp").collect()]
    assert got == [
        ("r0", "0", "2020-01-01T00:00:00", 1.0),
        ("r0", "0", "2020-01-02T00:00:00", 2.0),
        ("r0", "7", "2024-01-31T05:00:00", 3.0),
        ("r0", "7", "2024-02-01T05:00:00", None),
        ("r1", "0", "2024-02-01T00:00:00", 1.0),
        ("r1", "0", "2024-03-01T00:00:00", 2.0),
        ("r1", "0", "2024-04-01T00:00:00", 3.0),
    ]


def test_request_covariates(spark):
    good = (
        '{"inputs": [{"item_id": "a", "start": "2024-01-01", "target": [1, 2], "past_covariates": {"p": [5, 6]},'
        ' "future_covariates": {"p": [7, 8, 9]}}], "parameters": {"prediction_length": 3}}'
    )
    plain = '{"inputs": [{"target": [1]}]}'
    past = series_from_nested_json(bodies(spark, good), ["p"]).orderBy("timestamp").collect()
    assert [r.p for r in past] == [5.0, 6.0]
    future = covariates_from_nested_json(bodies(spark, good, plain), ["p"]).orderBy("timestamp").collect()
    assert [(r.timestamp.day, r.p) for r in future] == [(3, 7.0), (4, 8.0), (5, 9.0)]
    lacking = '{"inputs": [{"item_id": "a", "target": [1], "future_covariates": {"p": [1]}}, {"item_id": "b", "target": [1]}]}'
    short = '{"inputs": [{"item_id": "c", "target": [1], "future_covariates": {"p": []}}]}'
    with pytest.raises(Exception, match="no `future_covariates` for item b"):
        covariates_from_nested_json(bodies(spark, lacking), ["p"]).collect()
    with pytest.raises(Exception, match="one value per horizon step for item c"):
        covariates_from_nested_json(bodies(spark, short), ["p"]).collect()


@pytest.mark.parametrize(
    "body, message",
    [
        ("{", "MALFORMED|malformed"),
        ('{"parameters": {}}', "needs `inputs`"),
        ('{"inputs": [{"item_id": "a"}]}', "no `target`"),
        ('{"inputs": [{"target": [1]}], "parameters": {"freq": "fortnight"}}', "unknown frequency"),
    ],
)
def test_bad_requests(spark, body, message):
    with pytest.raises(Exception, match=message):
        series_from_nested_json(bodies(spark, body)).collect()


def test_nested_answers(series):
    table = forecast(series, 2, freq="D", model="naive", quantile_levels=[0.5])
    row = forecast_to_nested_json(table).orderBy("item_id").first()
    assert row.item_id == "0" and '"start":"2024-01-31T00:00:00"' in row.prediction and '"0.5":[' in row.prediction
    whole = response_bodies(table.withColumns({"request_id": F.lit("r"), "pos": F.col("item_id").cast("int")}))
    assert whole.count() == 1 and whole.first().body.startswith('{"predictions":[{"mean":[')


def test_forecasts_follow_the_last_timestamp(spark):
    """Trailing nulls, NaN and an item without any value: every item gets every step."""
    from tidecast.operators.columns import canonicalize
    from tidecast.operators.lagreg import LagRegression
    from tidecast.operators.leaderboard import weighted_ensemble
    from tidecast.operators.series import future_index
    from tidecast.operators.smoothing import smoothing_forecast

    rows = [("a", d, float(d) if d < 29 else None, None if d % 5 == 0 else 1.0) for d in range(1, 31)]
    rows += [("b", d, float("nan") if d == 30 else 5.0, 2.0) for d in range(1, 31)] + [("c", d, None, None) for d in range(1, 31)]
    df = spark.createDataFrame(rows, "item_id string, d int, target double, promo double")
    df = canonicalize(df.withColumn("timestamp", F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(d)")).drop("d"))
    want = {tuple(r) for r in future_index(df, 7, "D").collect()}
    known = future_index(df, 7, "D").withColumn("promo", F.lit(None).cast("double"))
    model = LagRegression(7, "D", 7, covariates=["promo"])
    made = [baseline_forecast(df, 7, "D", 7), smoothing_forecast(df, 7, "D"), smoothing_forecast(df, 7, "D", "holt")]
    made.append(model.fit(df).predict(df, known))
    for frame in made:
        for (name,) in frame.select("model").distinct().collect():
            got = frame.filter(F.col("model") == name).collect()
            assert {(r.item_id, r.timestamp) for r in got} == want and len(got) == len(want), name
            assert all((r.mean is None) == (r.item_id == "c") for r in got), name
    drift = {r.h: r.mean for r in made[0].filter("model = 'drift' AND item_id = 'a'").collect()}
    assert drift[1] == pytest.approx(31.0)
    both = made[0].filter("model = 'naive' AND item_id = 'b'").withColumn("sigma", F.lit(2.0))
    both = both.union(both.withColumns({"model": F.lit("other"), "sigma": F.lit(None).cast("double")}))
    assert {r.sigma for r in weighted_ensemble(both, {"naive": 0.5, "other": 0.5}).collect()} == {2.0}
