"""Prediction frames: first the prediction, then one ``<class>_proba`` column per class."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.operators.columns import PROBA, align_columns, col


def proba_name(value: object) -> str:
    return f"{value}{PROBA}"


def split_pred_proba(
    df: DataFrame, keys: Sequence[str] = (), classes: Sequence[object] | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """(prediction, probabilities named by class); no probabilities when there is one column.

    Exactly one suffix is removed, so a class may itself be called ``x_proba``. With the
    stored ``classes`` no name is parsed at all.
    """
    columns = [c for c in df.columns if c not in keys]
    prediction = df.select(*map(col, keys), col(columns[0]))
    if len(columns) == 1:
        return prediction, None
    names = [str(c) for c in classes] if classes is not None else [c.removesuffix(PROBA) for c in columns[1:]]
    renamed = [col(c).alias(n) for c, n in zip(columns[1:], names)]
    return prediction, df.select(*map(col, keys), *renamed)


def class_list(df: DataFrame, label: str) -> list:
    """Classes in label order. Runs a job; the driver gets one value per class."""
    return [r[0] for r in distinct_classes(df, label).collect()]


def distinct_classes(df: DataFrame, label: str) -> DataFrame:
    return df.select(col(label)).filter(col(label).isNotNull()).distinct().orderBy(col(label))


def best_place(probabilities: Column) -> Column:
    """Place (from 1) of the largest value of an array; ties go to the first."""
    return F.array_position(probabilities, F.array_max(probabilities)).cast("int")


def best_class(probabilities: Sequence[Column], classes: Sequence[object]) -> Column:
    """Most probable class; ties go to the first class in stored order."""
    return F.element_at(F.lit(list(classes)), best_place(F.array(*probabilities)))


def predict_from_proba(df: DataFrame, label: str, classes: Sequence[object], keys: Sequence[str] = ()) -> DataFrame:
    """Prediction column from the ``<class>_proba`` columns."""
    columns = [col(proba_name(c)) for c in classes]
    return df.select(*map(col, keys), best_class(columns, classes).alias(label))


def mirror_regression(df: DataFrame, label: str, keys: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """A regression has no probabilities: both results are the prediction."""
    plain = align_columns(df, [*keys, label])
    return plain, plain


def concat_columns(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Columns side by side, matched by key (Spark rows have no position to match by)."""
    return left.join(right, list(keys))


def join_predictions(test: DataFrame, predictions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Test rows with their predictions."""
    return test.join(predictions, list(keys), "left")


def average_models(predictions: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Mean of stacked fold outputs per key."""
    return predictions.groupBy(*keys).agg(*[F.avg(col(c)).alias(c) for c in columns])
