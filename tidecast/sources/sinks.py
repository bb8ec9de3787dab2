"""Writing predictions, forecasts and leaderboards, and reading them back."""

from __future__ import annotations

import time
import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.operators.columns import col, stringify_columns
from tidecast.sources.tables import CSV_WRITE, read_csv

# Answer types, by content type.
ANSWER_FORMATS = {"application/x-parquet": "parquet", "application/json": "json", "text/csv": "csv"}


def resolve_output_path(path: str) -> str:
    """``scheme://bucket`` alone gets a fresh time-stamped folder; a longer path is kept."""
    path = path.rstrip("/")
    scheme, mark, body = path.partition("://")
    if mark and "/" not in body:
        return f"{path}/run-{time.strftime('%Y%m%d-%H%M%S', time.gmtime())}"
    return path


def warn_if_present(spark: SparkSession, path: str) -> bool:
    """Warn that writing to ``path`` replaces what is there."""
    try:
        present = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).limit(1).count() > 0
    except Exception:  # nothing there, or not listable: this is advice only
        return False
    if present:
        warnings.warn(f"{path} already contains files that will be overwritten", stacklevel=2)
    return present


def default_predictions_path(output: str, job: str) -> str:
    return f"{output.rstrip('/')}/{job}/predictions.csv"


def write_predictions(df: DataFrame, path: str) -> str:
    """Write to a full URL or absolute path that ends in ``.csv`` or ``.parquet``."""
    whole = "://" in path or path.startswith(("/", "file:/"))
    if not whole or not path.endswith((".csv", ".parquet")):
        raise ValueError(f"cannot write to {path!r}: name a .csv or .parquet target by a full URL or an absolute path")
    writer = df.write.mode("overwrite")
    writer.options(**CSV_WRITE).csv(path) if path.endswith(".csv") else writer.parquet(path)
    return path


def answer_format(accept: str) -> str:
    for content_type, fmt in ANSWER_FORMATS.items():
        if content_type in accept.lower():
            return fmt
    raise ValueError(f"answers as {accept} are not supported; known: {', '.join(ANSWER_FORMATS)}")


def render(df: DataFrame, accept: str, path: str) -> str:
    """Write an answer in the accepted format; column names become text."""
    fmt = answer_format(accept)
    writer = stringify_columns(df).write.mode("overwrite").format(fmt)
    (writer.options(**CSV_WRITE) if fmt == "csv" else writer).save(path)
    return path


def render_records(df: DataFrame) -> DataFrame:
    """One JSON record per row, in a column ``record``."""
    return df.select(F.to_json(F.struct(*map(col, df.columns)), {"ignoreNullFields": "false"}).alias("record"))


def read_predictions(
    path: str, accept: str, schema: "T.StructType | str", spark: SparkSession | None = None
) -> DataFrame:
    """Results of an earlier run, with the types they were written with."""
    session = spark or SparkSession.active()
    fmt = answer_format(accept)
    return read_csv(path, schema, spark=session) if fmt == "csv" else session.read.format(fmt).schema(schema).load(path)


LEADERBOARD = "model string, score_val double, eval_metric string, fit_time double"


def write_leaderboard(board: DataFrame, path: str) -> str:
    board.coalesce(1).write.mode("overwrite").csv(path, header=True)
    return path


def read_leaderboard(path: str, spark: SparkSession | None = None) -> DataFrame:
    """A missing leaderboard is an error, never an empty table."""
    return (spark or SparkSession.active()).read.csv(path, header=True, schema=LEADERBOARD)
