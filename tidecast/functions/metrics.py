"""Forecast and classification metrics as plain aggregate expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.functions.quantiles import level_name
from tidecast.operators.columns import col


def pinball(actual: Column, predicted: Column, q: float) -> Column:
    gap = actual - predicted
    return F.greatest(F.lit(q) * gap, F.lit(q - 1.0) * gap)


def forecast_metric(
    name: str,
    actual: Column,
    mean: Column,
    levels: Sequence[float] = (),
    scale: Column | None = None,
) -> Column:
    """Aggregate giving the error ``name``; lower is better.

    ``scale`` is the item's in-sample mean absolute (MASE) or mean squared (RMSSE) seasonal
    difference; rows of items without a positive scale do not count.
    """
    name = name.upper()
    error = actual - mean
    if name == "MAE":
        return F.avg(F.abs(error))
    if name == "MSE":
        return F.avg(error * error)
    if name == "RMSE":
        return F.sqrt(F.avg(error * error))
    if name == "MAPE":
        return F.avg(F.when(actual != 0, F.abs(error / actual)))
    if name == "SMAPE":
        size = F.abs(actual) + F.abs(mean)
        return F.avg(F.when(size != 0, 2 * F.abs(error) / size))
    if name == "WAPE":
        return F.sum(F.abs(error)) / F.sum(F.abs(actual))
    if name == "MASE":
        return F.avg(F.when(scale > 0, F.abs(error) / scale))
    if name == "RMSSE":
        return F.sqrt(F.avg(F.when(scale > 0, error * error / scale)))
    if name == "WQL":
        if not levels:
            raise ValueError("WQL needs quantile levels")
        loss = sum((pinball(actual, col(level_name(q)), q) for q in levels), F.lit(0.0))
        return 2 * F.sum(loss) / (F.lit(len(levels)) * F.sum(F.abs(actual)))
    raise ValueError(f"unknown forecast metric {name!r}")


FORECAST_METRICS = ("MAE", "MSE", "RMSE", "MAPE", "SMAPE", "WAPE", "MASE", "RMSSE", "WQL")


def accuracy(label: Column, predicted: Column) -> Column:
    return F.avg((label == predicted).cast("double"))


def log_loss(label: Column, classes: Sequence[object], probabilities: Sequence[Column]) -> Column:
    """Mean negative log probability of the true class."""
    chosen = F.coalesce(*[F.when(label == F.lit(c), p) for c, p in zip(classes, probabilities)])
    return -F.avg(F.log(F.greatest(chosen, F.lit(1e-15))))


def roc_auc(df: DataFrame, label: Column, positive: object, score: Column) -> float:
    """Exact area under the ROC curve. Runs a job; the sort is range-partitioned."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    scored = df.select((label == F.lit(positive)).cast("double").alias("label"), score.cast("double").alias("score"))
    evaluator = BinaryClassificationEvaluator(
        labelCol="label", rawPredictionCol="score", metricName="areaUnderROC", numBins=0
    )
    return float(evaluator.evaluate(scored))
