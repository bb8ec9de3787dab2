"""Tables that mix numbers, categories, text, vectors and images.

Everything but images is the tabular plan. An image column holds paths; each distinct file
is turned into a short vector where it is read, and only the vector is joined to the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.functions.paths import normal_path
from tidecast.operators.columns import col
from tidecast.plans.tabular import TabularEstimator, TabularModel
from tidecast.session import bounded_batches
from tidecast.sources.images import find_image_column, read_images
from tidecast.sources.tables import as_frame

BINS = 16
PART = 1 << 20


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def byte_profile(content: pd.Series) -> pd.Series:
    """Log length and share of bytes per value range: a featurizer that needs no decoder."""
    out = []
    for value in content:
        data = np.frombuffer(value or b"", dtype=np.uint8)
        counts = np.zeros(BINS)
        for at in range(0, len(data), PART):  # counting takes eight bytes for one
            counts += np.bincount(data[at : at + PART] >> 4, minlength=BINS)
        shares = counts / max(len(data), 1)
        out.append(np.concatenate([[np.log1p(len(data))], shares]))
    return pd.Series(out)


def attach_image_features(
    df: DataFrame, image_column: str, images: DataFrame, featurizer: Callable[[Column], Column]
) -> DataFrame:
    """Replace paths in ``image_column`` by feature arrays; a path without file is an error.

    Files are featurized where they are read, so contents are never shuffled; only the short
    vectors meet the rows, and a path many rows share is split by the adaptive skew join.
    """
    if image_column not in df.columns:
        raise ValueError("Please specify a valid image column name")
    vectors = images.select(F.col("path").alias("_path"), featurizer(F.col("content")).alias("_vector"))
    joined = df.withColumn("_path", normal_path(col(image_column))).join(vectors, "_path", "left")
    missing = F.raise_error(F.concat(F.lit("no image at "), F.col("_path"))).cast("array<double>")
    vector = F.when(F.col("_vector").isNull(), missing).otherwise(F.col("_vector"))
    return joined.select(*[vector.alias(c) if c == image_column else col(c) for c in df.columns])


class MultiModalEstimator:
    """Fit on any mix of column kinds; the image column is named or found by its schema tag."""

    def __init__(
        self,
        label: str,
        eval_metric: str | None = None,
        image_column: str | None = None,
        featurizer: Callable[[Column], Column] = byte_profile,
        **options,
    ):
        self.label, self.eval_metric, self.image_column = label, eval_metric, image_column
        self.featurizer, self.options = featurizer, options

    def fit(
        self,
        train_data: "DataFrame | str",
        tuning_data: "DataFrame | str | None" = None,
        images: "DataFrame | str | None" = None,
        **fit_args,
    ) -> "MultiModalModel":
        train, tuning = as_frame(train_data), as_frame(tuning_data)
        bounded_batches(train.sparkSession)
        column = self.image_column or find_image_column(train)
        options = dict(self.options)
        vectors = list(options.pop("vector_columns", []))
        if column is not None:
            files = _files(images)
            if files is not None:
                train = attach_image_features(train, column, files, self.featurizer)
                tuning = attach_image_features(tuning, column, files, self.featurizer) if tuning is not None else None
            else:  # the column already holds the bytes
                train = train.withColumn(column, self.featurizer(col(column)))
                tuning = tuning.withColumn(column, self.featurizer(col(column))) if tuning is not None else None
            vectors.append(column)
        estimator = TabularEstimator(self.label, self.eval_metric, vector_columns=vectors, **options)
        return MultiModalModel(estimator.fit(train, tuning, **fit_args), column, self.featurizer)

    def fit_predict(self, *args, **kwargs):
        raise NotImplementedError("fit_predict is not offered for mixed inputs; fit, then predict")


def _files(images: "DataFrame | str | None") -> DataFrame | None:
    return read_images(images) if isinstance(images, str) else images


class MultiModalModel:
    def __init__(self, model: TabularModel, image_column: str | None, featurizer: Callable[[Column], Column]):
        self.model, self.image_column, self.featurizer = model, image_column, featurizer

    def _with_vectors(self, data: "DataFrame | str", images: "DataFrame | str | None") -> DataFrame:
        df = as_frame(data)
        if self.image_column is None:
            return df
        bounded_batches(df.sparkSession)
        files = _files(images)
        if files is not None:
            return attach_image_features(df, self.image_column, files, self.featurizer)
        return df.withColumn(self.image_column, self.featurizer(col(self.image_column)))

    def score(self, data, keys: Sequence[str] | None = None, images=None, model: str | None = None) -> DataFrame:
        return self.model.score(self._with_vectors(data, images), keys, model)

    def predict(self, data, keys: Sequence[str] | None = None, images=None, model: str | None = None) -> DataFrame:
        return self.model.predict(self._with_vectors(data, images), keys, model)

    def predict_proba(self, data, include_predict: bool = True, keys=None, images=None, model: str | None = None):
        return self.model.predict_proba(self._with_vectors(data, images), include_predict, keys, model)

    def predict_images(self, path: str, glob: str | None = None, spark: SparkSession | None = None) -> DataFrame:
        """Prediction frame of a directory of images or a single one, one row per file."""
        needed = self.model.schema.fieldNames()
        if needed != [self.image_column]:
            raise ValueError(f"this model needs the columns {needed}, not images alone")
        files = read_images(path, glob, spark).withColumnRenamed("content", self.image_column)
        return self.score(files, keys=["path"])

    def leaderboard(self, spark) -> DataFrame:
        return self.model.leaderboard(spark)

    def save(self, spark, path: str) -> None:
        from tidecast.sources.store import write_json

        self.model.save(spark, path)
        write_json(spark, f"{path}/images.json", {"image_column": self.image_column})

    @staticmethod
    def load(spark, path: str, featurizer: Callable[[Column], Column] = byte_profile) -> "MultiModalModel":
        from tidecast.sources.store import read_json

        column = read_json(spark, f"{path}/images.json")["image_column"]
        return MultiModalModel(TabularModel.load(spark, path), column, featurizer)
