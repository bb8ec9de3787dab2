"""Tabular learning: candidates on one feature pipeline, a leaderboard, and scoring plans."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from contextlib import nullcontext
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.base import Estimator
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    NaiveBayes,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.functions import metrics
from tidecast.functions.hashing import key_bucket
from tidecast.operators.columns import align_columns, col, feature_columns, validate_tabular
from tidecast.operators.features import (
    CATEGORY_BUCKETS,
    FEATURES,
    LABEL,
    TEXT_BUCKETS,
    WIDE,
    FeaturePlan,
    apply_featurizer,
    occurring_places,
    plan_features,
    prepare,
    with_slicer,
)
from tidecast.operators.leaderboard import rank_models
from tidecast.operators.proba import best_place, class_list, proba_name
from tidecast.operators.splits import fold_of, holdout_rows
from tidecast.plans.deadline import Deadline, OutOfTime
from tidecast.plans.registry import TABULAR_PRESETS, merge_settings, preset
from tidecast.plans.search import ETA, SHARES, halve, is_space, trials
from tidecast.session import scratch_path
from tidecast.sources.sinks import LEADERBOARD, write_predictions
from tidecast.sources.store import read_json, remove, write_json
from tidecast.sources.tables import as_frame, read_table

CLASSIFICATION, REGRESSION = "classification", "regression"
PLACE = "_place"  # of a row in the nested shares of successive halving

_CLASSIFIERS = {
    "linear": LogisticRegression,
    "tree": DecisionTreeClassifier,
    "forest": RandomForestClassifier,
    "boosted": GBTClassifier,
    "bayes": lambda **kw: NaiveBayes(modelType="gaussian", **kw),
}
_REGRESSORS = {
    "linear": LinearRegression,
    "tree": DecisionTreeRegressor,
    "forest": RandomForestRegressor,
    "boosted": GBTRegressor,
}
CLASSIFICATION_METRICS = ("accuracy", "acc", "log_loss", "roc_auc")
REGRESSION_METRICS = ("rmse", "mse", "mae", "r2")


def problem_type(df: DataFrame, label: str, given: str | None = None) -> str:
    """Text and boolean labels are classes, numbers are not; a given type wins.

    Only the schema decides, so more rows never change the task. Name the type for numbered classes.
    """
    if given is not None:
        given = {"binary": CLASSIFICATION, "multiclass": CLASSIFICATION}.get(given, given)
        if given not in (CLASSIFICATION, REGRESSION):
            raise ValueError(f"unknown problem type {given!r}")
        return given
    classes = isinstance(df.schema[label].dataType, (T.StringType, T.BooleanType))
    return CLASSIFICATION if classes else REGRESSION


class TabularEstimator:
    """Fit candidates on a table.

    ``text_columns``, ``vector_columns`` and ``categorical_columns`` override what is read
    off the schema; other strings are hashed whole into ``category_buckets``, and terms of text
    into ``text_buckets``, per column; ``featurizers`` maps a binary (image) column to a function from its
    column to an array of doubles.
    """

    def __init__(
        self,
        label: str,
        eval_metric: str | None = None,
        problem_type: str | None = None,
        text_columns: Sequence[str] = (),
        vector_columns: Sequence[str] = (),
        categorical_columns: Sequence[str] = (),
        featurizers: Mapping[str, Callable[[Column], Column]] | None = None,
        ignore_columns: Sequence[str] = (),
        hyperparameters: Mapping[str, Mapping[str, Any]] | None = None,
        text_buckets: int = TEXT_BUCKETS,
        category_buckets: int = CATEGORY_BUCKETS,
    ):
        self.label, self.eval_metric, self.problem = label, eval_metric, problem_type
        self.text_columns, self.vector_columns = list(text_columns), list(vector_columns)
        self.categorical_columns = list(categorical_columns)
        self.featurizers = dict(featurizers or {})
        self.ignore_columns = list(ignore_columns)
        self.buckets = {"text_buckets": text_buckets, "category_buckets": category_buckets}
        self.hyperparameters = dict(hyperparameters or {})
        self.custom: dict[str, Estimator] = {}
        self.fitted = False

    def register(self, name: str, estimator: Estimator) -> "TabularEstimator":
        """Add a candidate of the user's own: any Spark ML estimator over a features vector."""
        self.custom[name] = estimator
        return self

    # -- candidates -----------------------------------------------------------------------

    def _candidates(self, requested, presets, search, problem, classes) -> list[tuple[str, Estimator]]:
        layers = requested if isinstance(requested, Mapping) else {}
        names = list(requested) if requested else [*preset(TABULAR_PRESETS, presets, "medium_quality"), *self.custom]
        out: list[tuple[str, Estimator]] = []
        for name in names:
            settings = merge_settings(name, self.hyperparameters.get(name), layers.get(name))
            if not any(isinstance(v, (list, tuple)) or is_space(v) for v in settings.values()):
                out.append((name, self._estimator(name, settings, problem, classes)))
                continue
            for i, chosen in enumerate(trials(settings, search)):
                out.append((f"{name}/{i + 1}", self._estimator(name, chosen, problem, classes)))
        return out

    def _estimator(self, name, settings, problem, classes) -> Estimator:
        if name in self.custom:
            made = self.custom[name].copy({})
            return made.setParams(featuresCol=FEATURES, labelCol=LABEL)
        table = _CLASSIFIERS if problem == CLASSIFICATION else _REGRESSORS
        if name not in table:
            raise ValueError(f"unknown {problem} candidate {name!r}; known: {sorted([*table, *self.custom])}")
        if name == "boosted" and problem == CLASSIFICATION and len(classes) > 2:
            # these trees separate two classes: one model for each class against the others
            return OneVsRest(featuresCol=FEATURES, labelCol=LABEL, classifier=table[name](**settings))
        return table[name](featuresCol=FEATURES, labelCol=LABEL, **settings)

    # -- fitting ----------------------------------------------------------------------------

    def fit(
        self,
        train_data: "DataFrame | str",
        tuning_data: "DataFrame | str | None" = None,
        hyperparameters: "Mapping[str, Mapping[str, Any]] | Sequence[str] | None" = None,
        presets: str | None = None,
        time_limit: float | None = None,
        hyperparameter_tune_kwargs: Mapping[str, Any] | None = None,
        num_bag_folds: int = 0,
        num_bag_sets: int = 1,
        keys: Sequence[str] | None = None,
        parallelism: int = 1,
        partitions: int | None = None,
    ) -> "TabularModel":
        """Fit every candidate and keep the best on held-out rows.

        Rows are held out by key hash (``keys``, default: the whole row) unless tuning data
        is given. A single candidate without tuning data is fitted on all rows. With
        ``num_bag_folds`` each candidate is a bag of one model per fold and set, scored on
        the rows each model did not see.

        A setting may be a list or a range (``search``), which makes a candidate several trials:
        ``hyperparameter_tune_kwargs`` has ``num_trials``, a ``seed`` for ranges and, for successive
        halving, ``scheduler="halving"`` and ``eta``: trials start on a small share of the rows, and
        the best part goes on to a larger one that contains it (by key hash). When ``time_limit``
        (seconds) is over, the running fits are cancelled and what has been fitted is kept; only the
        first candidate is never cut short, so that there is a model.
        ``parallelism`` is how many candidates, or folds of one, are fitted at a time;
        ``partitions`` deals the rows anew before fitting, for tables of few large files.
        """
        if self.fitted:
            raise ValueError("this estimator is already fitted; make a new one")
        if train_data is None:
            raise ValueError("training data is required")
        if num_bag_folds == 1 or num_bag_folds < 0 or num_bag_sets < 1:
            raise ValueError("bagging needs at least two folds and one set")
        started = time.monotonic()
        train, tuning = as_frame(train_data), as_frame(tuning_data)
        validate_tabular(train, tuning, self.label)
        problem = problem_type(train, self.label, self.problem)
        train = train.filter(col(self.label).isNotNull())
        classes = class_list(train, self.label) if problem == CLASSIFICATION else []
        columns = [c for c in feature_columns(train, self.label) if c not in self.ignore_columns]
        search = hyperparameter_tune_kwargs or {}
        candidates = self._candidates(hyperparameters, presets, search, problem, classes)
        halving = search.get("scheduler") == "halving"
        if search.get("scheduler") not in (None, "halving"):
            raise ValueError(f"unknown scheduler {search['scheduler']!r}; known: halving")
        if halving and num_bag_folds:
            raise ValueError("successive halving doesn't go with bagging")
        metric = self._metric(problem, classes)

        model = TabularModel(self.label, problem, classes, metric, train.select(*map(col, columns)).schema)
        model.featurizers = {c: f for c, f in self.featurizers.items() if c in columns}
        if num_bag_folds or tuning is not None or len(candidates) == 1:
            fit_rows, check_rows = train, tuning
        else:
            fit_rows, check_rows = holdout_rows(train, keys, seed=1)
        if partitions is not None:
            fit_rows = fit_rows.repartition(partitions)
        vectors = [*self.vector_columns, *model.featurizers]
        featured = model._featurize(fit_rows)
        model.plan = plan_features(featured, columns, self.text_columns, vectors, self.categorical_columns, **self.buckets)

        extra = [self._label_column(problem, classes).alias(LABEL)]
        fold_keys = list(keys or fit_rows.columns)
        for s in range(num_bag_sets if num_bag_folds else 0):
            extra.append(fold_of(fold_keys, num_bag_folds, s).alias(f"fold{s}"))
        if halving:
            extra.append(key_bucket(fold_keys, SHARES, seed=2).alias(PLACE))
        prepared = prepare(featured, model.plan, extra)
        model.features = model.plan.pipeline().fit(prepared)
        kept = [LABEL, FEATURES, *(f"fold{s}" for s in range(num_bag_sets if num_bag_folds else 0)), *([PLACE] if halving else [])]
        data = model.features.transform(prepared).select(*kept).persist(StorageLevel.MEMORY_AND_DISK)
        slicer = occurring_places(data) if model.plan.hashes() else None
        if slicer is not None:
            wide, model.features = data, with_slicer(model.features, slicer)
            data = slicer.transform(wide.withColumnRenamed(FEATURES, WIDE)).drop(WIDE).persist(StorageLevel.MEMORY_AND_DISK)
        check = None
        if check_rows is not None:
            held = prepare(model._featurize(check_rows.filter(col(self.label).isNotNull())), model.plan, extra[:1])
            check = model.features.transform(held).select(LABEL, FEATURES)
            if len(candidates) > 1:
                check = check.persist(StorageLevel.MEMORY_AND_DISK)

        deadline = Deadline(data.sparkSession, time_limit, started)

        def run(job: tuple[str, Estimator]):
            name, estimator = job
            began = time.monotonic()
            try:
                with nullcontext() if name == first else deadline.enforced():
                    if num_bag_folds:
                        members, scored = self._bag(estimator, data, num_bag_folds, num_bag_sets, model, parallelism)
                    else:
                        members = [_fitted(estimator, data)]
                        scored = model._raw_output(check, members) if check is not None else None
                    score = None if scored is None else model._score(scored, metric)
            except OutOfTime:
                return None
            model.members[name] = members
            return name, score, time.monotonic() - began

        def on_share(estimator: Estimator, share: int) -> float | None:
            try:
                with deadline.enforced():
                    fitted = [_fitted(estimator, data.filter(F.col(PLACE) < share))]
                    return model._score(model._raw_output(check, fitted), metric)
            except OutOfTime:
                return None

        try:
            if halving and check is not None:
                candidates = self._halved(candidates, on_share, search.get("eta", ETA), model)
            first = candidates[0][0]
            if parallelism > 1:
                with ThreadPool(parallelism) as pool:
                    results = pool.map(inheritable_thread_target(data.sparkSession)(run), candidates)
            else:
                results = [run(c) for c in candidates]
        finally:
            data.unpersist()
            if slicer is not None:
                wide.unpersist()
            if check is not None:
                check.unpersist()
        model.scores = [r for r in results if r is not None]
        model.best = min(model.scores, key=lambda r: (-(r[1] if r[1] is not None else float("-inf")), r[0]))[0]
        self.fitted = True
        return model

    def _halved(self, candidates, on_share, eta: int, model: "TabularModel") -> list[tuple[str, Estimator]]:
        """Candidates with each family of trials cut down to its last rung."""
        estimators = dict(candidates)
        families: dict[str, list[str]] = {}
        for name in estimators:
            families.setdefault(name.rpartition("/")[0] or name, []).append(name)
        kept = []
        for names in families.values():
            left, log = halve(names, lambda name, share: on_share(estimators[name], share), eta)
            model.trials += log
            kept += left
        return [(name, estimators[name]) for name in kept]

    def _bag(self, estimator, data, folds, sets, model, parallelism=1):
        """One model per (set, fold), and each row with the mean of those that did not see it."""

        def fit(job):
            s, k = job
            return _fitted(estimator, data.filter(F.col(f"fold{s}") != k))

        jobs = [(s, k) for s in range(sets) for k in range(folds)]
        if parallelism > 1:
            with ThreadPool(parallelism) as pool:
                members = pool.map(inheritable_thread_target(data.sparkSession)(fit), jobs)
        else:
            members = [fit(j) for j in jobs]
        unseen = lambda outputs: [
            F.element_at(F.array(*outputs[s * folds : (s + 1) * folds]), (F.col(f"fold{s}") + 1).cast("int"))
            for s in range(sets)
        ]
        return members, model._raw_output(data, members, unseen)

    def _metric(self, problem: str, classes: list) -> str:
        if self.eval_metric is None:
            return "accuracy" if problem == CLASSIFICATION else "rmse"
        name = self.eval_metric.lower()
        known = CLASSIFICATION_METRICS if problem == CLASSIFICATION else REGRESSION_METRICS
        if name not in known:
            raise ValueError(f"unknown {problem} metric {name!r}; known: {known}")
        if name == "roc_auc" and len(classes) != 2:
            raise ValueError("roc_auc needs two classes")
        return name

    def _label_column(self, problem: str, classes: list) -> Column:
        if problem == REGRESSION:
            return col(self.label).cast("double")
        place = F.array_position(F.lit(classes), col(self.label)) - 1
        return F.when(place >= 0, place).cast("double")

    def fit_predict(self, train_data, test_data, predictions_path: str | None = None, keys=None, **fit_args):
        """Fit, then predict the test rows in the same application."""
        out = self._fit_for(train_data, test_data, keys, fit_args).predict(test_data, keys=keys)
        return _written(out, predictions_path)

    def fit_predict_proba(
        self, train_data, test_data, include_predict: bool = True, predictions_path: str | None = None, keys=None, **fit_args
    ):
        """(prediction, probabilities), or the probabilities alone."""
        model = self._fit_for(train_data, test_data, keys, fit_args)
        scored = model.score(test_data, keys=keys)
        if predictions_path is not None:  # scored once: both results are read back from what was written
            write_predictions(scored, predictions_path)
            scored = read_table(predictions_path, scored.schema, scored.sparkSession)
        return model.frames(scored, keys, include_predict)

    def _fit_for(self, train_data, test_data, keys, fit_args) -> "TabularModel":
        if test_data is None:
            raise ValueError("test data is required to fit and predict in one go")
        train, test = as_frame(train_data), as_frame(test_data)
        used = [c for c in train.columns if c not in self.ignore_columns]
        validate_tabular(train.select(*map(col, used)), test, self.label)
        return self.fit(train, **fit_args)


def _fitted(estimator: Estimator, data: DataFrame) -> PipelineModel:
    """The fitted candidate without its training summary.

    The summary of a two-class fit holds the session, which tasks can't be sent once anything in it
    has been observed (``DataFrame.observe``). A model that was saved and loaded has no summary.
    """
    model = Pipeline(stages=[estimator]).fit(data)
    stage = model.stages[-1]
    if not any(getattr(m, "hasSummary", False) for m in (stage, *getattr(stage, "models", ()))):
        return model
    path = scratch_path(data.sparkSession, "fitted")
    try:
        model.write().save(path)
        return PipelineModel.load(path)
    finally:
        remove(data.sparkSession, path)


def _written(df: DataFrame, path: str | None) -> DataFrame:
    if path is not None:
        write_predictions(df, path)
    return df


class TabularModel:
    def __init__(self, label: str, problem: str, classes: list, metric: str, schema: T.StructType):
        self.label, self.problem, self.classes, self.metric, self.schema = label, problem, classes, metric, schema
        self.featurizers: dict[str, Callable[[Column], Column]] = {}
        self.plan: FeaturePlan | None = None
        self.features: PipelineModel | None = None
        self.members: dict[str, list[PipelineModel]] = {}
        self.scores: list[tuple[str, float | None, float]] = []
        self.trials: list[tuple[str, int, float | None]] = []  # of successive halving: name, share of 10,000, score
        self.best: str | None = None

    # -- internals --------------------------------------------------------------------------

    def _featurize(self, df: DataFrame) -> DataFrame:
        for column, featurizer in self.featurizers.items():
            df = apply_featurizer(df, column, featurizer)
        return df

    def _raw_output(self, data: DataFrame, members: Sequence[PipelineModel], choose=None) -> DataFrame:
        """``data`` with ``output``: mean class probabilities, or the mean prediction.

        ``choose`` picks which members' outputs count for a row (default: all).
        """
        outputs = []
        for i, member in enumerate(members):
            data = member.transform(data)
            if self.problem == REGRESSION:
                out = F.col("prediction")
            elif "probability" in data.columns:
                out = vector_to_array(F.col("probability"))
            else:  # a classifier without probabilities votes for one class
                places = F.sequence(F.lit(0), F.lit(len(self.classes) - 1))
                out = F.transform(places, lambda j: F.when(F.col("prediction") == j, 1.0).otherwise(0.0))
            data = data.withColumn(f"_out{i}", out).drop("prediction", "probability", "rawPrediction")
            outputs.append(F.col(f"_out{i}"))
        counted = choose(outputs) if choose is not None else outputs
        mean = counted[0]
        for other in counted[1:]:
            mean = mean + other if self.problem == REGRESSION else F.zip_with(mean, other, lambda a, b: a + b)
        if len(counted) > 1:
            n = len(counted)
            mean = mean / n if self.problem == REGRESSION else F.transform(mean, lambda x: x / n)
        return data.withColumn("output", mean).drop(*[f"_out{i}" for i in range(len(outputs))])

    def _score(self, scored: DataFrame, metric: str) -> float:
        """Score of raw output against ``label_index``; higher is better. Runs a job."""
        label, out = F.col(LABEL), F.col("output")
        if self.problem == REGRESSION:
            error = label - out
            row = scored.agg(
                F.avg(error * error).alias("mse"), F.avg(F.abs(error)).alias("mae"), F.var_pop(label).alias("var")
            ).first()
            if metric == "r2":
                return 1.0 - row.mse / row["var"] if row["var"] else 0.0
            return -{"mse": row.mse, "rmse": row.mse**0.5, "mae": row.mae}[metric]
        if metric == "roc_auc":
            return metrics.roc_auc(scored, label, 1.0, out[1])
        if metric == "log_loss":
            chosen = F.element_at(out, label.cast("int") + 1)
            return -scored.agg(metrics.log_loss(F.lit(1), [1], [chosen])).first()[0]
        return scored.agg(metrics.accuracy(label, best_place(out) - 1)).first()[0]

    # -- scoring ------------------------------------------------------------------------------

    def score(self, data: "DataFrame | str", keys: Sequence[str] | None = None, model: str | None = None) -> DataFrame:
        """Prediction frame: keys, the prediction named after the label, ``<class>_proba`` columns.

        Without ``keys`` a ``row_id`` is added before anything else happens to the rows.
        Works on streaming frames too (give keys there).
        """
        name = model or self.best
        if name is None:
            raise ValueError("nothing has been fitted yet")
        if name not in self.members:
            raise ValueError(f"no candidate {name!r}; have {sorted(self.members)}")
        df = as_frame(data)
        if keys is None:
            df, keys = df.withColumn("row_id", F.monotonically_increasing_id()), ["row_id"]
        align_columns(df, self.schema.fieldNames())  # names the missing columns before any job
        carried = [col(k).alias(f"_key{i}") for i, k in enumerate(keys)]
        prepared = prepare(self._featurize(df), self.plan, carried)
        scored = self._raw_output(self.features.transform(prepared), self.members[name])
        back = [F.col(f"_key{i}").alias(k) for i, k in enumerate(keys)]
        if self.problem == REGRESSION:
            return scored.select(*back, F.col("output").alias(self.label))
        flat = scored.select(*back, "output")
        return flat.select(
            *map(col, keys),
            F.element_at(F.lit(self.classes), best_place(F.col("output"))).alias(self.label),
            *[F.col("output")[i].alias(proba_name(c)) for i, c in enumerate(self.classes)],
        )

    def predict(self, data, keys: Sequence[str] | None = None, model: str | None = None) -> DataFrame:
        """One prediction per row, in a column named after the label."""
        scored = self.score(data, keys, model)
        return scored.select(*map(col, [*(keys if keys is not None else ["row_id"]), self.label]))

    def predict_proba(self, data, include_predict: bool = True, keys: Sequence[str] | None = None, model: str | None = None):
        """(prediction, probabilities) or probabilities; a regression mirrors its prediction.

        Both frames come from one scoring plan. Probability columns carry the class names.
        """
        return self.frames(self.score(data, keys, model), keys, include_predict)

    def frames(self, scored: DataFrame, keys: Sequence[str] | None = None, include_predict: bool = True):
        """The results of ``predict_proba`` from a prediction frame."""
        kept = list(keys) if keys is not None else ["row_id"]
        prediction = scored.select(*map(col, [*kept, self.label]))
        if self.problem == REGRESSION:
            return (prediction, prediction) if include_predict else prediction
        renamed = [col(proba_name(c)).alias(str(c)) for c in self.classes]
        proba = scored.select(*map(col, kept), *renamed)
        return (prediction, proba) if include_predict else proba

    def leaderboard(self, spark) -> DataFrame:
        rows = [(n, None if s is None else float(s), self.metric, float(t)) for n, s, t in self.scores]
        return rank_models(spark.createDataFrame(rows, LEADERBOARD))

    # -- persistence ----------------------------------------------------------------------------

    def save(self, spark, path: str) -> None:
        if self.best is None:
            raise ValueError("nothing has been fitted yet")
        names = list(self.members)
        document = {
            "kind": "tabular",
            "label": self.label,
            "problem": self.problem,
            "classes": self.classes,
            "metric": self.metric,
            "schema": self.schema.json(),
            "plan": self.plan.to_dict(),
            "members": {n: len(self.members[n]) for n in names},
            "order": names,
            "scores": self.scores,
            "best": self.best,
            "featurizers": sorted(self.featurizers),
        }
        write_json(spark, f"{path}/metadata.json", document)
        self.features.write().overwrite().save(f"{path}/features")
        for i, name in enumerate(names):
            for j, member in enumerate(self.members[name]):
                member.write().overwrite().save(f"{path}/members/{i}-{j}")

    @staticmethod
    def load(spark, path: str, featurizers: Mapping[str, Callable[[Column], Column]] | None = None) -> "TabularModel":
        """Load a saved model; featurizers are code and must be passed again."""
        document = read_json(spark, f"{path}/metadata.json")
        if document.get("kind") != "tabular":
            raise ValueError(f"no tabular model at {path}")
        import json

        schema = T.StructType.fromJson(json.loads(document["schema"]))
        model = TabularModel(document["label"], document["problem"], document["classes"], document["metric"], schema)
        lacking = sorted(set(document["featurizers"]) - set(featurizers or {}))
        if lacking:
            raise ValueError(f"this model needs featurizers for {lacking}")
        model.featurizers = {c: featurizers[c] for c in document["featurizers"]}
        model.plan = FeaturePlan(**document["plan"])
        model.features = PipelineModel.load(f"{path}/features")
        for i, name in enumerate(document["order"]):
            count = document["members"][name]
            model.members[name] = [PipelineModel.load(f"{path}/members/{i}-{j}") for j in range(count)]
        model.scores = [tuple(s) for s in document["scores"]]
        model.best = document["best"]
        return model
