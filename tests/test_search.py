"""Search ranges, successive halving and deadlines."""

import time

import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.sql import functions as F

from tidecast.plans.deadline import Deadline, OutOfTime
from tidecast.plans.forecast import ForecastEstimator
from tidecast.plans.search import Choice, IntRange, RealRange, halve, rungs, trials
from tidecast.plans.tabular import TabularEstimator


def test_ranges():
    us = [i / 1000 for i in range(1000)]
    assert {IntRange(2, 5).at(u) for u in us} == {2, 3, 4, 5}
    spread = [IntRange(1, 1000, log=True).at(u) for u in us]
    assert {1, 10, 100} <= {*spread} and 990 <= max(spread) <= 1000
    assert all(1e-4 <= RealRange(1e-4, 1.0, log=True).at(u) <= 1.0 for u in us)
    assert sum(RealRange(1e-4, 1.0, log=True).at(u) < 1e-2 for u in us) == pytest.approx(500, abs=2)
    assert [Choice("a", "b").at(u) for u in (0.0, 0.49, 0.5, 0.99)] == ["a", "a", "b", "b"]
    for bad in (lambda: IntRange(3, 2), lambda: RealRange(0, 1, log=True), Choice):
        with pytest.raises(ValueError):
            bad()


def test_trials_are_seeded_and_nested():
    space = {"depth": IntRange(1, 50), "rate": RealRange(0.0, 1.0), "kind": ["x", "y"], "fixed": 3}
    few, many = trials(space, {"num_trials": 3, "seed": 1}), trials(space, {"num_trials": 8, "seed": 1})
    assert many[:3] == few and len(many) == 8 and all(t["fixed"] == 3 and t["kind"] in "xy" for t in many)
    assert trials(space, {"num_trials": 3, "seed": 2}) != few
    assert len(trials({"depth": IntRange(1, 2)}, {"num_trials": 30})) == 2  # repeats are left out
    assert [t["a"] for t in trials({"a": [1, 2, 3]}, {"num_trials": 2})] == [1, 2]


def test_halving_keeps_the_best():
    assert rungs(1) == [(1, 10000)] and [n for n, _ in rungs(10, 3)] == [10, 4, 2, 1]
    left, log = halve(list("abcdefghi"), lambda name, share: {"c": 2.0, "h": 3.0}.get(name, 1.0 if share > 2000 else None))
    assert left == ["h"]
    assert [name for name, share, _ in log if share == 3333] == ["a", "c", "h"]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(400).select("id", (F.col("id") % 7).cast("double").alias("x"), F.when(F.col("id") % 7 > 3, "up").otherwise("down").alias("y"))


def test_search_in_a_fit(rows):
    model = TabularEstimator("y", ignore_columns=["id"]).fit(
        rows, hyperparameters={"tree": {"maxDepth": IntRange(1, 3)}}, hyperparameter_tune_kwargs={"num_trials": 2}, keys=["id"]
    )
    assert [n for n, *_ in model.scores] == ["tree/1", "tree/2"][: len(model.scores)]
    halved = TabularEstimator("y", ignore_columns=["id"]).fit(
        rows, hyperparameters={"tree": {"minInstancesPerNode": [10**6, 1, 10**7]}, "linear": {}},
        hyperparameter_tune_kwargs={"scheduler": "halving"}, keys=["id"],
    )
    assert {n for n, *_ in halved.scores} == {"tree/2", "linear"} and len(halved.trials) == 3
    with pytest.raises(ValueError, match="unknown scheduler"):
        TabularEstimator("y").fit(rows, hyperparameter_tune_kwargs={"scheduler": "other"})


class Slow(DecisionTreeClassifier):
    """A fit whose job would take ten minutes."""

    def _fit(self, dataset):
        dataset.rdd.foreachPartition(lambda _: time.sleep(600))
        return super()._fit(dataset)


def test_a_running_fit_is_cut_short(spark, rows):
    def slow(series, *_):
        busy = F.udf(lambda x: time.sleep(600) or x, "double")
        return series.select("item_id", "timestamp", F.lit(1).alias("h"), busy("target").alias("mean"), F.lit(1.0).alias("sigma"))

    began = time.monotonic()
    model = TabularEstimator("y", ignore_columns=["id"]).register("slow", Slow()).fit(
        rows, hyperparameters=["tree", "slow"], keys=["id"], time_limit=8
    )
    assert [n for n, *_ in model.scores] == ["tree"] and model.best == "tree"
    assert time.monotonic() - began < 60

    series = spark.range(60).select(F.lit("a").alias("item_id"), F.expr("timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, int(id))").alias("timestamp"), F.col("id").cast("double").alias("target"))
    began = time.monotonic()
    model = ForecastEstimator(prediction_length=3, freq="D").register("slow", slow).fit(series, hyperparameters=["naive", "slow"], time_limit=6)
    assert model.best == "naive" and [n for n, *_ in model.scores] == ["naive"]
    assert time.monotonic() - began < 60


def test_deadlines(spark):
    with Deadline(spark, None).enforced():
        assert spark.range(5).count() == 5
    with Deadline(spark, 60).enforced():
        assert spark.range(5).count() == 5
    with pytest.raises(ValueError), Deadline(spark, 60).enforced():
        raise ValueError("its own")
    with pytest.raises(OutOfTime), Deadline(spark, -1.0).enforced():
        pass
    assert spark.range(5).count() == 5  # later jobs carry no tag
