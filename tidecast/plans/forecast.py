"""Forecasting: a one-call forecast, and an estimator that selects among candidates."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from contextlib import nullcontext
from typing import Any

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.functions.frequency import Frequency
from tidecast.functions.metrics import FORECAST_METRICS
from tidecast.functions.quantiles import sorted_levels
from tidecast.operators import baseline
from tidecast.operators.columns import (
    ITEM,
    STAMP,
    TARGET,
    canonicalize,
    col,
    restore_names,
    validate_known_covariates,
    validate_series,
)
from tidecast.operators.lagreg import HASH_SIZE, LagRegression
from tidecast.operators.leaderboard import (
    SCALED,
    error_products,
    greedy_weights,
    rank_models,
    score_forecasts,
    score_rows,
    weighted_ensemble,
)
from tidecast.operators.series import (
    duplicate_stamps,
    future_index,
    join_static,
    last_steps,
    missing_covariates,
    resolve_freq,
    season_length,
)
from tidecast.operators.smoothing import SMOOTHERS, smoothing_forecast
from tidecast.plans.deadline import Deadline, OutOfTime
from tidecast.plans.registry import FORECAST_PRESETS, FORECASTERS, merge_settings, preset
from tidecast.sources.sinks import write_predictions
from tidecast.sources.store import read_json, write_json
from tidecast.sources.tables import as_frame

# A user's own forecaster: (series, horizon, freq, season) -> (item_id, timestamp, h, mean, sigma).
Forecaster = Callable[[DataFrame, int, Frequency, int], DataFrame]

USES_COVARIATES = {"lag_regression"}


def forecast(
    history: "DataFrame | str",
    prediction_length: int = 1,
    target: str = TARGET,
    id_column: str = ITEM,
    timestamp_column: str = STAMP,
    quantile_levels: Sequence[float] | None = None,
    known_covariates: "DataFrame | str | None" = None,
    static_features: "DataFrame | str | None" = None,
    model: str = "seasonal_naive",
    freq: str | None = None,
    hyperparameters: Mapping[str, Any] | None = None,
    predictions_path: str | None = None,
    keep_names: bool = False,
) -> DataFrame:
    """Forecast every item beyond its end with one model and no selection step.

    Models that cannot use covariates or static features ignore them. The result has
    ``item_id``, ``timestamp``, ``mean`` and one column per quantile level; ``keep_names``
    gives the two keys their input names.
    """
    estimator = ForecastEstimator(
        target=target,
        prediction_length=prediction_length,
        freq=freq,
        quantile_levels=quantile_levels,
        id_column=id_column,
        timestamp_column=timestamp_column,
    )
    out = estimator.fit_predict(
        history,
        known_covariates=known_covariates,
        static_features=static_features,
        hyperparameters={model: dict(hyperparameters or {})},
        predictions_path=predictions_path,
    )
    return restore_names(out, id_column, timestamp_column) if keep_names else out


class ForecastEstimator:
    def __init__(
        self,
        target: str = TARGET,
        prediction_length: int = 1,
        freq: str | None = None,
        eval_metric: str = "WQL",
        quantile_levels: Sequence[float] | None = None,
        known_covariates_names: Sequence[str] | None = None,
        id_column: str = ITEM,
        timestamp_column: str = STAMP,
        season: int | None = None,
        hyperparameters: Mapping[str, Mapping[str, Any]] | None = None,
    ):
        if prediction_length < 1:
            raise ValueError("prediction_length must be at least 1")
        if eval_metric.upper() not in FORECAST_METRICS:
            raise ValueError(f"unknown eval_metric {eval_metric!r}; known: {FORECAST_METRICS}")
        self.target, self.prediction_length, self.freq = target, prediction_length, freq
        self.eval_metric = eval_metric.upper()
        self.quantile_levels = sorted_levels(quantile_levels)
        self.known_covariates_names = known_covariates_names
        self.id_column, self.timestamp_column = id_column, timestamp_column
        self.season = season
        self.hyperparameters = dict(hyperparameters or {})
        self.custom: dict[str, Forecaster] = {}
        self.fitted = False

    def register(self, name: str, forecaster: Forecaster) -> "ForecastEstimator":
        """Add a candidate of the user's own."""
        self.custom[name] = forecaster
        return self

    def _names(self, requested, presets) -> tuple[list[str], dict[str, dict[str, Any]]]:
        layers = requested if isinstance(requested, Mapping) else {}
        names = list(requested) if requested else [*preset(FORECAST_PRESETS, presets, "medium_quality"), *self.custom]
        unknown = [n for n in names if n not in (*FORECASTERS, "ensemble", *self.custom)]
        if unknown:
            raise ValueError(f"unknown forecasters {unknown}; known: {FORECASTERS}")
        settings = {n: merge_settings(n, self.hyperparameters.get(n), layers.get(n)) for n in names}
        return names, settings

    def fit(
        self,
        train_data: "DataFrame | str",
        tuning_data: "DataFrame | str | None" = None,
        static_features: "DataFrame | str | None" = None,
        hyperparameters: "Mapping[str, Mapping[str, Any]] | Sequence[str] | None" = None,
        presets: str | None = None,
        time_limit: float | None = None,
        leaderboard: bool = True,
    ) -> "ForecastModel":
        """Backtest the candidates on the last steps of each item and keep the best.

        ``hyperparameters`` names the candidates (a mapping also sets their options). With a
        single candidate no backtest runs. When ``time_limit`` (seconds) is over, the running
        backtest is cancelled and the candidates scored so far decide; the first group of
        candidates is never cut short.
        """
        if self.fitted:
            raise ValueError("this estimator is already fitted; make a new one")
        started = time.monotonic()
        train, tuning = as_frame(train_data), as_frame(tuning_data)
        validate_series(train, tuning, self.id_column, self.timestamp_column, self.target)
        names = validate_known_covariates(None, self.known_covariates_names, train, self.id_column, self.timestamp_column)
        candidates, settings = self._names(hyperparameters, presets)
        static = as_frame(static_features)
        static_names = [c for c in static.columns if c != self.id_column] if static is not None else []
        model = ForecastModel(self, candidates, settings, names, static_names)
        series = model.prepare(train, static)
        model.freq = resolve_freq(series, self.freq)
        model.season = season_length(model.freq, self.season or settings.get("seasonal_naive", {}).get("season"))
        if len(candidates) > 1:
            check = model.prepare(tuning, static) if tuning is not None else series
            marked = last_steps(check, self.prediction_length, model.freq).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                model._select(marked, time_limit, started)
            finally:
                marked.unpersist()
        else:
            model.best = candidates[0]
        if "lag_regression" in candidates:
            model.regression = model._regression(self.prediction_length).fit(series)
        self.fitted = True
        return model

    def fit_predict(
        self,
        train_data: "DataFrame | str",
        tuning_data: "DataFrame | str | None" = None,
        known_covariates: "DataFrame | str | None" = None,
        static_features: "DataFrame | str | None" = None,
        hyperparameters: "Mapping[str, Mapping[str, Any]] | Sequence[str] | None" = None,
        presets: str | None = None,
        time_limit: float | None = None,
        predictions_path: str | None = None,
    ) -> DataFrame:
        """Fit, then forecast beyond the end of the same history; optionally write the result."""
        train, known = as_frame(train_data), as_frame(known_covariates)
        if known is not None:
            # Names are inferred before validating, so undeclared covariates are checked too.
            uses = self.known_covariates_names is not None or "lag_regression" in (hyperparameters or ())
            names = validate_known_covariates(
                known, self.known_covariates_names, train if uses else None, self.id_column, self.timestamp_column
            )
            if uses:
                self.known_covariates_names = names
        model = self.fit(train, tuning_data, static_features, hyperparameters, presets, time_limit)
        out = model.predict(train, known, static_features)
        if predictions_path is not None:
            write_predictions(out, predictions_path)
        return out


class ForecastModel:
    """A fitted forecaster. Horizon, quantiles and column names are frozen at fit."""

    def __init__(self, estimator: ForecastEstimator, candidates, settings, known_names, static_names):
        self.target = estimator.target
        self.horizon = estimator.prediction_length
        self.levels = estimator.quantile_levels
        self.eval_metric = estimator.eval_metric
        self.id_column, self.timestamp_column = estimator.id_column, estimator.timestamp_column
        self.candidates, self.settings = list(candidates), settings
        self.known_names, self.static_names = list(known_names), list(static_names)
        self.custom = dict(estimator.custom)
        self.freq: Frequency | None = None
        self.season = 1
        self.best: str | None = None
        self.weights: dict[str, float] = {}
        self.scores: list[tuple[str, float, float]] = []
        self.regression: LagRegression | None = None

    # -- tables -------------------------------------------------------------------------

    def prepare(self, df: DataFrame, static: DataFrame | None) -> DataFrame:
        """Canonical series with only the columns the candidates can use."""
        series = canonicalize(df, self.id_column, self.timestamp_column, self.target)
        wanted = [ITEM, STAMP, TARGET]
        if self._uses_extras():
            wanted += self.known_names
        series = series.select(*map(col, wanted))
        if self._uses_extras() and self.static_names:
            series = join_static(series, static, self.id_column)
        return series

    def _uses_extras(self) -> bool:
        return bool(USES_COVARIATES & set(self.candidates))

    def _regression(self, horizon: int) -> LagRegression:
        options = self.settings.get("lag_regression", {})
        return LagRegression(
            horizon,
            self.freq,
            self.season,
            lags=options.get("lags"),
            calendar=options.get("calendar", True),
            covariates=self.known_names,
            static=self.static_names,
            reg_param=options.get("reg_param", 0.0),
            hash_size=options.get("hash_size", HASH_SIZE),
        )

    # -- selection ----------------------------------------------------------------------

    def _groups(self) -> list[list[str]]:
        """Candidates scored together: the baselines share one pass, others run one by one."""
        shared = [c for c in self.candidates if c in baseline.BASELINES]
        single = [[c] for c in self.candidates if c not in shared and c != "ensemble"]
        return ([shared] if shared else []) + single

    def _raw(self, names: Sequence[str], series: DataFrame, known: DataFrame | None, regression) -> DataFrame:
        """Rows (item_id, timestamp, h, model, mean, sigma) of some candidates."""
        if all(n in baseline.BASELINES for n in names):
            return baseline.baseline_forecast(series, self.horizon, self.freq, self.season, names)
        (name,) = names
        if name in SMOOTHERS:
            return smoothing_forecast(series, self.horizon, self.freq, name)
        if name == "lag_regression":
            return regression.predict(series, known)
        rows = self.custom[name](series, self.horizon, self.freq, self.season)
        return rows.select(ITEM, STAMP, "h", F.lit(name).alias("model"), "mean", "sigma")

    def _select(self, marked: DataFrame, time_limit: float | None, started: float) -> None:
        history = marked.filter(~F.col("held_out")).drop("step", "held_out")
        held = marked.filter("held_out")
        known = held.select(ITEM, STAMP, *map(col, self.known_names)) if self._uses_extras() else None
        metric, levels = self.eval_metric, self.levels if self.eval_metric == "WQL" else ()
        scaled = metric in SCALED
        if scaled and any(not self._one_pass(g) for g in self._groups()):
            # Worked out once for all candidates: a few values beside each held-out row.
            scale = baseline.item_statistics(history, self.freq, self.season, (), scale=True)
            held = held.join(scale.select(ITEM, *SCALED.values()), ITEM, "left").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self._select_among(marked, history, held, known, metric, levels, time_limit, started)
        finally:
            held.unpersist()

    def _one_pass(self, group: Sequence[str]) -> bool:
        """Whether statistics and held-out values of all of ``group`` leave the series together."""
        return "ensemble" not in self.candidates and all(n in baseline.BASELINES for n in group)

    def _select_among(self, marked, history, held, known, metric, levels, time_limit, started) -> None:
        frames: list[DataFrame] = []
        deadline = Deadline(marked.sparkSession, time_limit, started)
        for group in self._groups():
            began = time.monotonic()
            try:
                with deadline.enforced() if frames else nullcontext():
                    if self._one_pass(group):
                        rows = baseline.backtest_rows(marked, self.horizon, self.freq, self.season, group, metric in SCALED)
                        self._keep(score_rows(rows, [metric], levels), metric, began)
                        frames.append(rows)
                        continue
                    fitted = self._regression(self.horizon).fit(history) if group == ["lag_regression"] else None
                    rows = self._raw(group, history, known, fitted)
                    self._keep(score_forecasts(rows, held, [metric], levels), metric, began)
            except OutOfTime:
                break
            frames.append(rows)
        done = [name for name, _, _ in self.scores]
        if "ensemble" in self.candidates and len(done) > 1:
            began = time.monotonic()
            rows = frames[0]
            for frame in frames[1:]:
                rows = rows.unionByName(frame)
            self.weights = greedy_weights(error_products(rows, held, done), done)
            together = weighted_ensemble(rows, self.weights)
            self._keep(score_forecasts(together, held, [metric], levels), metric, began)
        ranked = [s for s in self.scores if s[1] is not None]
        if not ranked:
            raise ValueError("no item has more steps than the horizon, so nothing can be backtested")
        self.best = min(ranked, key=lambda s: (-s[1], s[0]))[0]

    def _keep(self, errors: DataFrame, metric: str, began: float) -> None:
        errors = errors.collect()
        spent = time.monotonic() - began
        for row in errors:
            value = row[metric.lower()]
            self.scores.append((row.model, None if value is None else -float(value), spent))

    def leaderboard(self, spark) -> DataFrame:
        """Candidates, best first (scores are negated errors)."""
        rows = [(m, s, self.eval_metric, t) for m, s, t in self.scores] or [(self.best, None, self.eval_metric, None)]
        return rank_models(spark.createDataFrame(rows, "model string, score_val double, eval_metric string, fit_time double"))

    # -- prediction ---------------------------------------------------------------------

    def predict(
        self,
        data: "DataFrame | str",
        known_covariates: "DataFrame | str | None" = None,
        static_features: "DataFrame | str | None" = None,
        model: str | None = None,
        **options,
    ) -> DataFrame:
        """Forecast beyond the end of ``data`` with the best (or the named) candidate."""
        if options:
            raise TypeError(f"{sorted(options)} were fixed when the model was fitted")
        name = model or self.best
        if name != self.best and name not in self.candidates:
            raise ValueError(f"{name!r} is not a candidate of this model: {self.candidates}")
        df, known, static = as_frame(data), as_frame(known_covariates), as_frame(static_features)
        validate_series(df, None, self.id_column, self.timestamp_column, self.target)
        members = list(self.weights) if name == "ensemble" else [name]
        if self.static_names and static is None and "lag_regression" in members:
            raise ValueError("static features were used at fit and are needed to predict")
        series = self.prepare(df, static)
        keyed = self._known(series, known, members)
        if "lag_regression" in members and self.regression is None:
            raise ValueError("the regression was not kept because it was not the best candidate")
        shared = [m for m in members if m in baseline.BASELINES]
        groups = ([shared] if shared else []) + [[m] for m in members if m not in shared]
        rows = None
        for group in groups:
            part = self._raw(group, series, keyed, self.regression)
            rows = part if rows is None else rows.unionByName(part)
        if name == "ensemble":
            rows = weighted_ensemble(rows, self.weights)
        return baseline.as_forecast_table(rows, self.levels)

    def _known(self, series, known, members):
        if not self.known_names:
            return None
        if known is None:
            raise ValueError(f"this model was fitted with known covariates {self.known_names}; pass known_covariates")
        validate_known_covariates(known, self.known_names, None, self.id_column, self.timestamp_column)
        if "lag_regression" not in members:
            return None
        wanted = known.select(self.id_column, self.timestamp_column, *map(col, self.known_names))
        future = future_index(series, self.horizon, self.freq)
        gaps = missing_covariates(future, wanted, self.id_column, self.timestamp_column).limit(5).collect()
        if gaps:
            shown = ", ".join(f"{g.item_id}@{g.timestamp}" for g in gaps)
            raise ValueError(f"known covariates do not cover the horizon, e.g. {shown}")
        return canonicalize(wanted, self.id_column, self.timestamp_column, None)

    def predict_proba(self, *args, **kwargs):
        raise ValueError("forecasters have no class probabilities")

    # -- persistence --------------------------------------------------------------------

    def save(self, spark, path: str) -> None:
        if {self.best, *(self.weights if self.best == "ensemble" else ())} & set(self.custom):
            raise ValueError("a model whose best candidate is a user function cannot be saved")
        document = {
            "kind": "forecast",
            "target": self.target,
            "horizon": self.horizon,
            "levels": self.levels,
            "eval_metric": self.eval_metric,
            "id_column": self.id_column,
            "timestamp_column": self.timestamp_column,
            "candidates": self.candidates,
            "settings": self.settings,
            "known_names": self.known_names,
            "static_names": self.static_names,
            "freq": str(self.freq),
            "season": self.season,
            "best": self.best,
            "weights": self.weights,
            "scores": self.scores,
            "regression": None if self.regression is None else self.regression.state(),
        }
        write_json(spark, f"{path}/metadata.json", document)
        if self.regression is not None:
            self.regression.model.write().overwrite().save(f"{path}/regression")

    @staticmethod
    def load(spark, path: str) -> "ForecastModel":
        document = read_json(spark, f"{path}/metadata.json")
        if document.get("kind") != "forecast":
            raise ValueError(f"no forecast model at {path}")
        estimator = ForecastEstimator(
            document["target"],
            document["horizon"],
            document["freq"],
            document["eval_metric"],
            document["levels"],
            id_column=document["id_column"],
            timestamp_column=document["timestamp_column"],
        )
        model = ForecastModel(
            estimator, document["candidates"], document["settings"], document["known_names"], document["static_names"]
        )
        model.freq, model.season = Frequency.parse(document["freq"]), document["season"]
        model.best, model.weights = document["best"], document["weights"]
        model.scores = [tuple(s) for s in document["scores"]]
        if document["regression"]:
            fitted = PipelineModel.load(f"{path}/regression")
            model.regression = model._regression(model.horizon).restore(document["regression"], fitted)
        return model


def check_duplicates(series: DataFrame) -> None:
    """Raise when any (item, timestamp) occurs twice. Runs a job."""
    found = duplicate_stamps(series).limit(5).collect()
    if found:
        raise ValueError(f"duplicate timestamps: {[(r[ITEM], str(r[STAMP])) for r in found]}")
