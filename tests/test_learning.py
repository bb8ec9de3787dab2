import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import LinearSVC
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from tidecast.functions import metrics
from tidecast.operators.bayes import GaussianBayes
from tidecast.operators.features import plan_features
from tidecast.operators.proba import class_list
from tidecast.operators.scoring import score_items, score_with
from tidecast.operators.splits import fold_of, holdout_rows, sample_n
from tidecast.plans.multimodal import MultiModalEstimator, MultiModalModel
from tidecast.plans.tabular import TabularEstimator, TabularModel, problem_type


@pytest.fixture(scope="module")
def people(spark):
    rng = np.random.default_rng(0)
    n = 600
    age, hours = rng.integers(18, 80, n), rng.integers(10, 60, n)
    work = rng.choice(["private", "public", "none"], n)
    high = (age + hours + np.where(work == "private", 15, 0) + rng.normal(0, 8, n)) > 85
    data = pd.DataFrame({"id": range(n), "age": age, "hours": hours, "work": work, "class": np.where(high, ">50K", "<=50K")})
    return spark.createDataFrame(data).cache()


@pytest.mark.parametrize(
    "label, given, expected",
    [("class", None, "classification"), ("age", None, "regression"), ("class", "binary", "classification"), ("hours", "regression", "regression")],
)
def test_problem_type(people, label, given, expected):
    assert problem_type(people, label, given) == expected


def test_fit_predict_proba(people):
    train, test = holdout_rows(people, ["id"], percent=30)
    estimator = TabularEstimator("class", eval_metric="roc_auc", ignore_columns=["id"])
    prediction, proba = estimator.fit_predict_proba(
        train, test.drop("class"), keys=["id"], hyperparameters={"linear": {}, "tree": {"maxDepth": 3}}
    )
    assert prediction.columns == ["id", "class"] and proba.columns == ["id", "<=50K", ">50K"]
    both = test.select("id", F.col("class").alias("truth")).join(prediction, "id").join(proba, "id").toPandas()
    assert len(both) == test.count()
    assert (both.truth == both["class"]).mean() > 0.75
    assert np.allclose(both["<=50K"] + both[">50K"], 1)
    assert (both["class"] == np.where(both["<=50K"] >= both[">50K"], "<=50K", ">50K")).all()
    alone = TabularEstimator("class", ignore_columns=["id"]).fit_predict_proba(
        train, test, include_predict=False, keys=["id"], hyperparameters=["tree"]
    )
    assert alone.columns == ["id", "<=50K", ">50K"]


def test_rules(people):
    with pytest.raises(ValueError, match="test data is required"):
        TabularEstimator("class").fit_predict(people, None)
    with pytest.raises(ValueError, match="test_data lacks age"):
        TabularEstimator("class").fit_predict(people, people.drop("age"))
    with pytest.raises(ValueError, match="roc_auc needs two classes"):
        TabularEstimator("work", eval_metric="roc_auc").fit(people)
    with pytest.raises(ValueError, match="unknown classification candidate"):
        TabularEstimator("class").fit(people, hyperparameters=["magic"])
    estimator = TabularEstimator("class", ignore_columns=["id"])
    model = estimator.fit(people, hyperparameters=["tree"])
    with pytest.raises(ValueError, match="already fitted"):
        estimator.fit(people)
    with pytest.raises(ValueError, match="lacks hours"):
        model.predict(people.drop("hours"))
    assert model.predict(people).columns == ["row_id", "class"]
    assert model.predict(people.withColumn("extra", F.lit(1)), keys=["id"]).count() == 600


def test_regression_mirrors(people, spark, tmp_path):
    model = TabularEstimator("age", problem_type="regression", ignore_columns=["id"]).fit(
        people, hyperparameters=["linear", "tree"], keys=["id"], num_bag_folds=2
    )
    prediction, proba = model.predict_proba(people, keys=["id"])
    assert prediction.columns == proba.columns == ["id", "age"]
    assert sorted(prediction.collect()) == sorted(proba.collect())
    model.save(spark, f"{tmp_path}/m")
    again = TabularModel.load(spark, f"{tmp_path}/m")
    left, right = (m.predict(people, keys=["id"]).orderBy("id").toPandas() for m in (model, again))
    pd.testing.assert_frame_equal(left, right)
    assert {n: len(m) for n, m in again.members.items()} == {"linear": 2, "tree": 2}


def test_leaderboard_search_custom_and_limits(spark, people):
    estimator = TabularEstimator("class", ignore_columns=["id"])
    estimator.register("svm", LinearSVC(maxIter=10))
    model = estimator.fit(
        people,
        hyperparameters={"tree": {"maxDepth": [1, 2, 4]}, "svm": {}, "linear": {}},
        hyperparameter_tune_kwargs={"num_trials": 2},
        keys=["id"],
        parallelism=2,
    )
    board = model.leaderboard(spark).collect()
    assert sorted(r.model for r in board) == ["linear", "svm", "tree/1", "tree/2"]
    assert board[0].model == model.best and board[0].score_val >= board[-1].score_val
    assert model.score(people, keys=["id"], model="svm").columns == ["id", "class", "<=50K_proba", ">50K_proba"]
    quick = TabularEstimator("class", ignore_columns=["id"]).fit(people, presets="high_quality", time_limit=0, keys=["id"])
    assert [s[0] for s in quick.scores] == ["linear"]
    tuned = TabularEstimator("class", ignore_columns=["id"]).fit(people, people, hyperparameters=["tree", "linear"])
    assert all(s[1] > 0.7 for s in tuned.scores)


def test_column_kinds(spark):
    df = spark.range(300).select(
        F.col("id").cast("double").alias("x"),
        F.lit("2024-01-01").cast("date").alias("day"),
        F.concat(F.lit("c"), F.pmod("id", F.lit(3))).alias("few"),
        F.concat(F.lit("v"), F.col("id")).alias("many"),
        F.lit("one two three four five six").alias("words"),
        F.array(F.lit(1.0), F.lit(2.0)).alias("vector"),
    )
    plan = plan_features(df, df.columns, text_columns=["words"], categorical_columns=["few"])
    assert (plan.numeric, plan.dates, plan.categories) == (["x"], ["day"], ["few"])
    assert (plan.hashed, plan.text, plan.vectors) == (["many"], ["words"], ["vector"])
    assert plan_features(df, df.columns).hashed == plan_features(df.limit(1), df.columns).hashed == ["few", "many", "words"]
    with pytest.raises(ValueError, match="needs a featurizer"):
        plan_features(df.withColumn("b", F.lit(b"x")), ["b"])


def test_nulls_and_unseen_categories(people):
    model = TabularEstimator("class", ignore_columns=["id"]).fit(people, hyperparameters=["linear"])
    odd = people.withColumn("work", F.lit("new")).withColumn("age", F.lit(None).cast("long"))
    assert model.predict(odd, keys=["id"]).dropna().count() == 600


def test_splits_and_samples(spark):
    df = spark.range(5000).withColumn("x", F.col("id") * 2)
    train, held = holdout_rows(df, ["id"])
    assert train.count() + held.count() == 5000 and 350 < held.count() < 650
    folds = {r[0]: r[1] for r in df.groupBy(fold_of(["id"], 4).alias("f")).count().collect()}
    assert sorted(folds) == [0, 1, 2, 3] and min(folds.values()) > 1000
    for n in (0, 1, 777, 6000):
        picked = sample_n(df, n, ["id"], seed=3)
        assert picked.count() == min(n, 5000)
        again = sample_n(df.repartition(7), n, ["id"], seed=3)
        assert picked.exceptAll(again).count() == 0


def test_many_classes(spark):
    df = spark.range(6000).select("id", (F.col("id") % 1200).alias("y"), (F.col("id") % 1200).cast("double").alias("x"))
    assert problem_type(df, "y") == "regression" and len(class_list(df, "y")) == 1200
    model = GaussianBayes.fit(df, "y", ["x"], smoothing=1e-4)
    hit = model.predict_proba(df.withColumnRenamed("y", "truth"), keys=["id", "truth"]).where("y = truth").count()
    assert hit >= 5900


def test_bagged_sets_and_boosted_classes(people):
    three = people.withColumn("level", F.when(F.col("hours") > 45, "c").when(F.col("hours") > 25, "b").otherwise("a"))
    estimator = TabularEstimator("level", ignore_columns=["id", "class"])
    model = estimator.fit(three, hyperparameters={"tree": {"maxDepth": 3}}, num_bag_folds=2, num_bag_sets=2, keys=["id"], parallelism=2)
    assert len(model.members["tree"]) == 4 and model.scores[0][1] > 0.9
    boosted = TabularEstimator("level", ignore_columns=["id", "class"]).fit(
        three, hyperparameters={"boosted": {"maxIter": 2, "maxDepth": 3}}, keys=["id"]
    )
    assert boosted.predict(three, keys=["id"]).join(three.select("id", F.col("level").alias("t")), "id").where("level = t").count() > 550


def test_metrics_agree_with_spark(people):
    scored = people.select((F.col("class") == ">50K").cast("double").alias("y"), F.col("age").cast("double").alias("s"))
    guess = (F.col("s") > 50).cast("double")
    ours = scored.agg(metrics.accuracy(F.col("y"), guess)).first()[0]
    evaluator = MulticlassClassificationEvaluator(labelCol="y", predictionCol="p", metricName="accuracy")
    assert ours == pytest.approx(evaluator.evaluate(scored.withColumn("p", guess)))
    data = scored.toPandas()
    pos, neg = data.s[data.y == 1].to_numpy(), data.s[data.y == 0].to_numpy()
    area = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    assert metrics.roc_auc(scored, F.col("y"), 1.0, F.col("s")) == pytest.approx(area)


def test_gaussian_bayes_single_class_and_nulls(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None)], "c string, x double")
    out = GaussianBayes.fit(df, "c", ["x"]).predict_proba(df).collect()
    assert [(r.c, r.a_proba) for r in out] == [("a", 1.0), ("a", 1.0)]


def test_user_scorers(spark, people):
    def load():
        return {"cut": 50}

    def score(model, rows):
        return pd.DataFrame({"id": rows["id"], "old": rows["age"] > model["cut"]})

    out = score_with(people, load, score, "id bigint, old boolean", ["id", "age"])
    assert out.filter("old").count() == people.filter("age > 50").count()
    series = spark.range(400).select(
        F.when(F.col("id") < 300, "hot").otherwise("cold").alias("item_id"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.col("id") * F.expr("INTERVAL '1' HOUR")).alias("timestamp"),
        F.col("id").cast("double").alias("target"),
    )

    def spread(_, rows):
        assert rows["timestamp"].is_monotonic_increasing
        return pd.DataFrame({"item_id": [rows["item_id"][0]], "n": [len(rows)], "low": [rows["target"].min()]})

    out = score_items(series, dict, spread, "item_id string, n bigint, low double", 24, "h")
    assert sorted(map(tuple, out.collect())) == [("cold", 24, 376.0), ("hot", 24, 276.0)]


def test_mixed_inputs(spark, tmp_path):
    folder = tmp_path / "pictures"
    folder.mkdir()
    rows = []
    for i in range(40):
        dark = i % 2 == 0
        (folder / f"{i}.png").write_bytes(bytes([i % 16 if dark else 240 + i % 16]) * (20 + i))
        rows.append((i, "short words here" if dark else "other text entirely", str(folder / f"{i}.png"), "dark" if dark else "light"))
    df = spark.createDataFrame(rows, "id int, text string, image string, label string")
    estimator = MultiModalEstimator("label", "acc", image_column="image", text_columns=["text"], ignore_columns=["id"])
    model = estimator.fit(df, images=str(folder), hyperparameters=["tree"])
    out = model.predict(df, keys=["id"], images=str(folder)).join(df.select("id", F.col("label").alias("truth")), "id")
    assert out.filter("label = truth").count() == 40
    with pytest.raises(ValueError, match="not images alone"):
        model.predict_images(str(folder))
    only = MultiModalEstimator("label", image_column="image").fit(
        df.select("image", "label"), images=str(folder), hyperparameters=["tree"]
    )
    found = only.predict_images(str(folder)).collect()
    assert len(found) == 40 and all((int(r.path.split("/")[-1][:-4]) % 2 == 0) == (r.label == "dark") for r in found)
    only.save(spark, f"{tmp_path}/m")
    assert MultiModalModel.load(spark, f"{tmp_path}/m").predict_images(str(folder / "1.png")).first().label == "light"
    with pytest.raises(NotImplementedError):
        only_estimator = MultiModalEstimator("label")
        only_estimator.fit_predict(df, df)


def test_sample_of_repeated_keys(spark, monkeypatch):
    monkeypatch.setattr("tidecast.operators.splits._SORTED_ROWS", 10)
    rows = spark.range(4000).select(F.when(F.col("id") < 3000, F.lit(7)).otherwise(F.col("id")).alias("k"), F.floor(F.col("id") / 1500).alias("v"), "id")
    hot = rows.select("k", "v", F.create_map("k", "v").alias("m"))
    for n in (1, 40, 1700, 3333, 4000):
        for df in (rows, hot):
            picked = sample_n(df, n, ["k"], seed=5)
            assert picked.columns == df.columns and picked.count() == n
            again = sample_n(df.repartition(5), n, ["k"], seed=5)
            assert picked.drop("m").exceptAll(again.drop("m")).isEmpty()
            assert picked.drop("m").exceptAll(df.drop("m")).isEmpty()
            # a key is whole, absent, or the last one taken
            parts = picked.groupBy("k").count().join(df.groupBy("k").agg(F.count("*").alias("all")), "k").where("count < all")
            assert parts.count() <= 1
