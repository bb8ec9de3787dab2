"""One regression over all items on lagged targets, calendar, covariates and static features.

The forecast is *direct*: every lag is at least the horizon, so features of all future steps
come from observed values and no forecast feeds another one. Lags are exact calendar steps,
computed chunk by chunk with a halo.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import FeatureHasher, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.functions.frequency import Frequency
from tidecast.operators.chunks import refuse_duplicates, value_at_lag, with_halo
from tidecast.operators.columns import ITEM, STAMP, TARGET, col
from tidecast.operators.series import future_rows, join_known, with_step

HASH_SIZE = 256  # buckets of all text covariates together, unless ``hash_size`` says otherwise


def default_lags(horizon: int, season: int) -> list[int]:
    """The first three usable lags and the first two usable whole seasons."""
    whole = math.ceil(horizon / season) * season
    return sorted({horizon, horizon + 1, horizon + 2, whole, whole + season})


def calendar_columns(season: int) -> dict[str, object]:
    """Season position and month of the year as points on a circle."""
    angles = {"month": F.month(STAMP) * (2 * math.pi / 12)}
    if season > 1:
        angles["season"] = F.pmod("step", F.lit(season)) * (2 * math.pi / season)
    return {f"{name}_{fn.__name__}": fn(angle) for name, angle in angles.items() for fn in (F.sin, F.cos)}


def lag_features(
    rows: DataFrame, freq, season: int, lags: Sequence[int], calendar: bool = True, extra: Sequence[str] = ()
) -> DataFrame:
    """Rows with ``lag_<k>`` columns, calendar columns and the ``extra`` columns."""
    halo = max(lags)
    spread = with_halo(with_step(rows, freq), halo)
    lagged = spread.select(
        ITEM,
        STAMP,
        "step",
        "in_halo",
        refuse_duplicates(F.col(TARGET)).alias(TARGET),
        *[value_at_lag(F.col(TARGET), k).alias(f"lag_{k}") for k in lags],
        *[col(c) for c in extra],
    ).filter(~F.col("in_halo"))
    if calendar:
        lagged = lagged.withColumns(calendar_columns(season))
    return lagged.drop("in_halo")


class LagRegression:
    def __init__(
        self,
        horizon: int,
        freq,
        season: int,
        lags: Sequence[int] | None = None,
        calendar: bool = True,
        covariates: Sequence[str] = (),
        static: Sequence[str] = (),
        reg_param: float = 0.0,
        hash_size: int = HASH_SIZE,
    ):
        self.horizon, self.freq, self.season = horizon, Frequency.parse(freq), season
        self.lags = sorted(lags or default_lags(horizon, season))
        if self.lags[0] < horizon:
            raise ValueError(f"lags shorter than the horizon {horizon} would use unknown values: {self.lags}")
        self.calendar, self.reg_param, self.hash_size = calendar, reg_param, hash_size
        self.covariates, self.static = list(covariates), list(static)
        self.model: PipelineModel | None = None
        self.means: dict[str, float] = {}
        self.text: list[str] = []

    def state(self) -> dict:
        """What fitting has found besides the pipeline, and the options that ``predict`` goes by."""
        return {
            "means": self.means,
            "text": self.text,
            "lags": self.lags,
            "calendar": self.calendar,
            "hash_size": self.hash_size,
        }

    def restore(self, state: dict, model: PipelineModel) -> "LagRegression":
        self.means = {name: float(value) for name, value in state["means"].items()}
        self.text, self.lags = list(state["text"]), list(state["lags"])
        self.calendar, self.hash_size, self.model = state["calendar"], state["hash_size"], model
        return self

    @property
    def extra(self) -> list[str]:
        return [*self.covariates, *self.static]

    def _features(self, rows: DataFrame) -> DataFrame:
        return lag_features(rows, self.freq, self.season, self.lags, self.calendar, self.extra)

    def _imputed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumns({c: F.coalesce(col(c).cast("double"), F.lit(float(m))) for c, m in self.means.items()})

    def fit(self, series: DataFrame) -> "LagRegression":
        """Runs the regression job over every row whose lags are all known."""
        data = self._features(series).dropna(subset=[TARGET, *(f"lag_{k}" for k in self.lags)])
        kinds = dict(data.dtypes)
        self.text = text = [c for c in self.extra if kinds[c] in ("string", "boolean")]
        numeric = [f"lag_{k}" for k in self.lags]
        numeric += list(calendar_columns(self.season)) if self.calendar else []
        numeric += [c for c in self.extra if c not in text]
        stages: list = []
        given = [c for c in self.extra if c not in text]
        wavering = [c for c in numeric if not c.startswith("lag_") or c in given]
        if wavering:
            # A missing covariate counts as its mean; means of nothing as zero. What never changes in
            # training tells nothing, and a solver may give it any weight, which would show as soon as
            # it does change: a month's position when the forecast leaves the month.
            found = data.agg(*[f(col(c)).alias(f"{n}{i}") for i, c in enumerate(wavering) for n, f in (("m", F.avg), ("a", F.min), ("z", F.max))]).first()
            self.means = {c: found[f"m{i}"] or 0.0 for i, c in enumerate(wavering) if c in given}
            constant = {c for i, c in enumerate(wavering) if found[f"a{i}"] == found[f"z{i}"]}
            numeric = [c for c in numeric if c not in constant]
        data = self._imputed(data)
        if text:
            stages.append(FeatureHasher(inputCols=text, outputCol="hashed", numFeatures=self.hash_size))
        inputs = numeric + (["hashed"] if text else [])
        stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="error"))
        stages.append(
            LinearRegression(labelCol=TARGET, featuresCol="features", predictionCol="mean", regParam=self.reg_param)
        )
        self.model = Pipeline(stages=stages).fit(data)
        return self

    def predict(self, series: DataFrame, known: DataFrame | None = None) -> DataFrame:
        """(item_id, timestamp, h, model, mean, sigma); sigma from the residuals of each item.

        ``series`` carries the static columns; ``known`` the future covariates.
        """
        ends = with_step(series, self.freq).groupBy(ITEM).agg(
            F.max(STAMP).alias("last_timestamp"),
            F.max_by(TARGET, F.when(F.col(TARGET).isNotNull(), F.col("step"))).alias("y_last"),
            *[F.any_value(col(c)).alias(c) for c in self.static],
        )
        future = future_rows(ends, self.horizon, self.freq).drop("last_timestamp")
        if self.covariates:
            future = join_known(future, known.select(ITEM, STAMP, *map(col, self.covariates)))
        history = series.select(ITEM, STAMP, TARGET, *map(col, self.extra))
        both = history.unionByName(future.withColumn(TARGET, F.lit(None).cast("double")), allowMissingColumns=True)
        rows = lag_features(both, self.freq, self.season, self.lags, self.calendar, [*self.extra, "h", "y_last"])
        lags = [f"lag_{k}" for k in self.lags]
        # Future steps of a history too short for a lag use the latest value in its place.
        # An item without any value keeps its steps and gets null forecasts.
        rows = rows.withColumns({c: F.coalesce(F.col(c), F.col("y_last")) for c in lags})
        unknown = F.greatest(*[F.col(c).isNull() for c in lags], F.lit(False))
        rows = rows.withColumn("unknown", unknown).filter(F.col("h").isNotNull() | ~F.col("unknown"))
        scored = self.model.transform(self._imputed(rows.fillna(0.0, subset=lags)))
        scored = scored.withColumn("mean", F.when(~F.col("unknown"), F.col("mean")))
        error = F.when(F.col("h").isNull(), F.col(TARGET) - F.col("mean"))
        sigma = scored.groupBy(ITEM).agg(F.sqrt(F.avg(error * error)).alias("sigma"))
        return (
            scored.filter(F.col("h").isNotNull())
            .join(sigma, ITEM, "left")
            .select(ITEM, STAMP, "h", F.lit("lag_regression").alias("model"), "mean", "sigma")
        )
