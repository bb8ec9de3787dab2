"""Feature plan of a tabular model: which column is treated how, and the Spark ML stages.

Only types and declarations decide: declared categories are indexed, declared text is hashed
term by term, and any other string is hashed whole, each column into buckets of its own. The
number of rows or of distinct values never changes a model's features.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    FeatureHasher,
    HashingTF,
    Imputer,
    OneHotEncoder,
    StringIndexer,
    Tokenizer,
    VectorAssembler,
    VectorSlicer,
)
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.operators.columns import col, missing_columns

CATEGORY_BUCKETS = 1 << 10  # per hashed column, unless given
TEXT_BUCKETS = 1 << 13  # per text column, unless given

FEATURES, LABEL = "features", "label_index"
WIDE = "features_wide"  # the assembled vector, where only some of its places are used
SPARSE = 4  # a vector is cut down when at most one of so many places is ever filled


@dataclass
class FeaturePlan:
    columns: list[str]
    numeric: list[str] = field(default_factory=list)
    dates: list[str] = field(default_factory=list)
    categories: list[str] = field(default_factory=list)
    hashed: list[str] = field(default_factory=list)
    text: list[str] = field(default_factory=list)
    vectors: list[str] = field(default_factory=list)
    text_buckets: int = TEXT_BUCKETS
    category_buckets: int = CATEGORY_BUCKETS

    def to_dict(self) -> dict:
        return asdict(self)

    def hashes(self) -> bool:
        return bool(self.hashed or self.text)

    # -- row-local preparation, the same at fit, in batches and on streams ----------------

    def _date_parts(self) -> list[str]:
        return [f"{c}__{part}" for c in self.dates for part in ("day", "month", "weekday")]

    def prepared(self) -> list[Column]:
        out = [col(c).cast("double").alias(c) for c in self.numeric]
        for c in self.dates:
            out += [
                F.unix_date(F.to_date(col(c))).cast("double").alias(f"{c}__day"),
                F.month(col(c)).cast("double").alias(f"{c}__month"),
                F.weekday(col(c)).cast("double").alias(f"{c}__weekday"),
            ]
        out += [F.coalesce(col(c).cast("string"), F.lit("")).alias(c) for c in (*self.categories, *self.hashed, *self.text)]
        out += [array_to_vector(col(c).cast("array<double>")).alias(c) for c in self.vectors]
        return out

    def stages(self) -> list:
        stages, inputs = [], []
        numbers = [*self.numeric, *self._date_parts()]
        if numbers:
            filled = [f"{c}__filled" for c in numbers]
            stages.append(Imputer(inputCols=numbers, outputCols=filled))
            inputs += filled
        if self.categories:
            indexed = [f"{c}__index" for c in self.categories]
            encoded = [f"{c}__onehot" for c in self.categories]
            stages.append(StringIndexer(inputCols=self.categories, outputCols=indexed, handleInvalid="keep"))
            stages.append(OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=False))
            inputs += encoded
        for c in self.hashed:
            stages.append(FeatureHasher(inputCols=[c], outputCol=f"{c}__hashed", numFeatures=self.category_buckets))
            inputs.append(f"{c}__hashed")
        for c in self.text:
            # No inverse document frequencies: they rescale columns, which neither trees nor
            # standardised linear models react to, and would cost a pass over all text.
            stages += [
                Tokenizer(inputCol=c, outputCol=f"{c}__words"),
                HashingTF(inputCol=f"{c}__words", outputCol=f"{c}__terms", numFeatures=self.text_buckets),
            ]
            inputs.append(f"{c}__terms")
        inputs += self.vectors
        stages.append(VectorAssembler(inputCols=inputs, outputCol=FEATURES))
        return stages

    def pipeline(self) -> Pipeline:
        return Pipeline(stages=self.stages())


def plan_features(
    df: DataFrame,
    columns: Sequence[str],
    text_columns: Sequence[str] = (),
    vector_columns: Sequence[str] = (),
    categorical_columns: Sequence[str] = (),
    text_buckets: int = TEXT_BUCKETS,
    category_buckets: int = CATEGORY_BUCKETS,
) -> FeaturePlan:
    """Sort columns into kinds by declaration, then by type."""
    plan = FeaturePlan(list(columns), text_buckets=text_buckets, category_buckets=category_buckets)
    for name in columns:
        kind = df.schema[name].dataType
        if name in text_columns:
            plan.text.append(name)
        elif name in vector_columns or isinstance(kind, T.ArrayType):
            plan.vectors.append(name)
        elif name in categorical_columns:
            plan.categories.append(name)
        elif isinstance(kind, (T.NumericType, T.BooleanType)):
            plan.numeric.append(name)
        elif isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            plan.dates.append(name)
        elif isinstance(kind, T.StringType):
            plan.hashed.append(name)
        else:
            raise ValueError(f"column {name!r} of type {kind.simpleString()} needs a featurizer")
    return plan


def occurring_places(data: DataFrame) -> VectorSlicer | None:
    """A stage that keeps the places of ``features`` that some row fills; None when most are filled.

    Hashed columns leave most buckets empty. An empty one is zero in every row, so no model can use
    it, but trees hold a number per row and place. Runs one job; the driver gets a count per place.
    """
    counted = data.select(Summarizer.metrics("numNonZeros").summary(F.col(FEATURES)).alias("s")).first()
    if counted.s is None:
        return None
    counts = counted.s.numNonZeros.toArray()
    filled = [int(i) for i in counts.nonzero()[0]] or [0]
    if len(filled) * SPARSE > len(counts):
        return None
    return VectorSlicer(inputCol=WIDE, outputCol=FEATURES, indices=filled)


def with_slicer(features: PipelineModel, slicer: VectorSlicer) -> PipelineModel:
    """The fitted stages with the vector cut down at the end."""
    *before, assembler = features.stages
    return PipelineModel([*before, assembler.copy().setOutputCol(WIDE), slicer])


def apply_featurizer(df: DataFrame, column: str, featurizer: Callable[[Column], Column]) -> DataFrame:
    """Replace a binary column by the array of doubles a featurizer makes of it."""
    return df.withColumn(column, featurizer(col(column)))


def prepare(df: DataFrame, plan: FeaturePlan, extra: Sequence[Column] = ()) -> DataFrame:
    """The plan's inputs in their numeric, text or vector form, after the ``extra`` columns."""
    missing = missing_columns(df.columns, plan.columns)
    if missing:
        raise ValueError(f"the input lacks {', '.join(missing)}")
    return df.select(*extra, *plan.prepared())
