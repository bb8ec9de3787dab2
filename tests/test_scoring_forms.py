"""Scoring forms that must agree: compiled and matrix Bayes, whole and cut-down features."""

import numpy as np
from pyspark.ml.classification import LogisticRegression, OneVsRest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tidecast.operators import bayes
from tidecast.operators.bayes import GaussianBayes
from tidecast.operators.features import FEATURES
from tidecast.plans.tabular import TabularEstimator, TabularModel


def test_bayes_forms_agree(spark, monkeypatch):
    rows = spark.range(600).select(
        "id", (F.col("id") % 5).cast("string").alias("y"), F.sin("id").alias("a"), F.when(F.col("id") % 7 > 0, F.cos(F.col("id") * 2)).alias("b"),
        F.when(F.col("id") % 5 != 3, F.col("id") % 5 * 1.0).alias("c"),
    )
    model = GaussianBayes.fit(rows, "y", ["a", "b", "c"])
    compiled = model.predict_proba(rows, ["id"]).orderBy("id").collect()
    monkeypatch.setattr(bayes, "PLAIN", 0)
    by_matrix = model.predict_proba(rows.repartition(3), ["id"]).orderBy("id").collect()
    assert [r.y for r in compiled] == [r.y for r in by_matrix]
    assert np.allclose([r[2:] for r in compiled], [r[2:] for r in by_matrix], atol=1e-12)
    assert model.predict_proba(rows.limit(0), ["id"]).count() == 0


def test_many_classes_have_a_small_plan(spark):
    rows = spark.range(4000).select("id", (F.col("id") % 1000).cast("string").alias("y"), *[(F.sin(F.col("id") % 1000 * (i + 1)) + F.rand(i) / 100).alias(f"x{i}") for i in range(10)])
    scored = GaussianBayes.fit(rows, "y", [f"x{i}" for i in range(10)]).predict_proba(rows, ["id"])
    right = scored.join(rows.select("id", F.col("y").alias("truth")), "id").where("y = truth").count()
    assert right > 3900


def test_empty_buckets_are_left_out(spark, tmp_path):
    """A tree on a hashed column sees the filled buckets only; unseen values score as none of them."""
    rows = spark.range(300).select(
        "id", F.concat(F.lit("v"), (F.col("id") % 6).cast("string")).alias("kind"), F.when(F.col("id") % 6 < 3, "low").otherwise("high").alias("y")
    )
    model = TabularEstimator("y", ignore_columns=["id"]).fit(rows, hyperparameters=["tree", "linear"], keys=["id"])
    size = model.features.stages[-1].getIndices()
    assert 3 <= len(size) <= 6
    scored = model.score(rows, keys=["id"])
    assert scored.join(rows.select("id", F.col("y").alias("truth")), "id").where("y <> truth").count() == 0
    unseen = spark.createDataFrame([(1, "new"), (2, None)], "id long, kind string")
    assert model.score(unseen, keys=["id"]).count() == 2
    model.save(spark, f"{tmp_path}/m")
    again = TabularModel.load(spark, f"{tmp_path}/m")
    assert sorted(map(tuple, again.score(rows, keys=["id"]).collect())) == sorted(map(tuple, scored.collect()))
    assert FEATURES in again.features.stages[-1].getOutputCol()


def test_scoring_after_an_observation(spark):
    """Fits with a training summary score in a session in which something has been observed."""
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 3}
    rows = spark.range(300).select("id", (F.col("id") % 6).alias("x"), F.when(F.col("id") % 6 < 3, "low").otherwise("high").alias("y"))
    estimator = TabularEstimator("y", eval_metric="roc_auc", ignore_columns=["id"]).register("rest", OneVsRest(classifier=LogisticRegression()))
    model = estimator.fit(rows, hyperparameters={"linear": {}, "forest": {"numTrees": 2}, "rest": {}}, keys=["id"])
    for name in ("linear", "forest", "rest"):
        scored = model.predict(rows, keys=["id"], model=name)
        assert scored.join(rows.withColumnRenamed("y", "truth"), "id").where("y <> truth").count() == 0
