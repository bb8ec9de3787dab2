"""Scoring candidates against each other."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.functions.metrics import forecast_metric
from tidecast.functions.quantiles import normal_quantiles
from tidecast.operators.columns import ITEM, STAMP, TARGET

SCALED = {"MASE": "scale_abs", "RMSSE": "scale_sq"}


def score_forecasts(
    forecasts: DataFrame,
    actuals: DataFrame,
    metrics: Sequence[str],
    levels: Sequence[float] = (),
    by: Sequence[str] = ("model",),
) -> DataFrame:
    """Errors of forecast rows (item_id, timestamp, model, mean, sigma, scales?) per ``by``.

    The scales of scaled errors may also come with the actual values.
    """
    scales = [c for c in SCALED.values() if c in actuals.columns and c not in forecasts.columns]
    seen = actuals.select(ITEM, STAMP, F.col(TARGET).alias("actual"), *scales)
    return score_rows(forecasts.join(seen, [ITEM, STAMP]), metrics, levels, by)


def score_rows(
    joined: DataFrame, metrics: Sequence[str], levels: Sequence[float] = (), by: Sequence[str] = ("model",)
) -> DataFrame:
    """Errors of rows (model, mean, sigma, actual, scales?) per ``by``; rows without an actual value don't count."""
    joined = joined.filter(F.col("actual").isNotNull())
    if levels:
        joined = joined.select("*", *normal_quantiles(F.col("mean"), F.col("sigma"), levels))
    aggregates = []
    for name in metrics:
        scale = F.col(SCALED[name.upper()]) if name.upper() in SCALED else None
        aggregates.append(forecast_metric(name, F.col("actual"), F.col("mean"), levels, scale).alias(name.lower()))
    return joined.groupBy(*by).agg(*aggregates)


def rank_models(board: DataFrame, score: str = "score_val") -> DataFrame:
    """Leaderboard order: best (highest) score first, ties by name; one row per model."""
    return board.orderBy(F.col(score).desc_nulls_last(), "model")


def best_model(board: DataFrame, score: str = "score_val") -> DataFrame:
    """One row (model, score_val): the best candidate, ties to the first name."""
    return board.filter(F.col(score).isNotNull()).orderBy(F.col(score).desc(), "model").limit(1).select("model", score)


def error_products(forecasts: DataFrame, actuals: DataFrame, models: Sequence[str]) -> dict[tuple[str, str], float]:
    """Mean product of the errors of each pair of candidates. Runs one aggregate job."""
    joined = forecasts.join(actuals.select(ITEM, STAMP, F.col(TARGET).alias("actual")), [ITEM, STAMP])
    error = F.col("mean") - F.col("actual")
    wide = joined.groupBy(ITEM, STAMP).agg(*[F.max(F.when(F.col("model") == m, error)).alias(m) for m in models])
    pairs = [(a, b) for i, a in enumerate(models) for b in models[i:]]
    row = wide.dropna(subset=list(models)).agg(
        *[F.avg(F.col(a) * F.col(b)).alias(f"{i}") for i, (a, b) in enumerate(pairs)]
    ).first()
    out: dict[tuple[str, str], float] = {}
    for i, (a, b) in enumerate(pairs):
        out[a, b] = out[b, a] = row[i] if row[i] is not None else 0.0
    return out


def greedy_weights(products: Mapping[tuple[str, str], float], models: Sequence[str], rounds: int = 20) -> dict[str, float]:
    """Ensemble weights by repeatedly adding the candidate that lowers squared error most.

    Squared error decides whatever metric ranks the candidates, because it is the one that needs
    only the products of their errors.
    """
    counts = dict.fromkeys(models, 0)

    def loss(trial: Mapping[str, int]) -> float:
        total = sum(trial.values())
        return sum(trial[a] * trial[b] * products[a, b] for a in models for b in models) / total**2

    for _ in range(rounds):
        best = min(models, key=lambda m: (loss(counts | {m: counts[m] + 1}), models.index(m)))
        counts[best] += 1
    return {m: n / rounds for m, n in counts.items() if n}


def weighted_ensemble(forecasts: DataFrame, weights: Mapping[str, float], name: str = "ensemble") -> DataFrame:
    """Weighted mean of candidates per (item, timestamp); spreads combine with the same weights."""
    weight = F.coalesce(*[F.when(F.col("model") == m, F.lit(float(w))) for m, w in weights.items()])
    used = forecasts.filter(F.col("model").isin(list(weights))).withColumn("w", weight)
    return used.groupBy(ITEM, STAMP, "h").agg(
        F.lit(name).alias("model"),
        *[  # a candidate without a value leaves the others their weights
            (F.sum(F.col("w") * F.col(c)) / F.sum(F.when(F.col(c).isNotNull(), F.col("w")))).alias(c)
            for c in ("mean", "sigma")
        ],
    )
