"""Starting, stopping and resuming scoring streams over files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidecast.sources.sinks import answer_format

BATCH_BYTES = 6 * 1024 * 1024  # fixed value: what the service being replaced takes in one batch


@dataclass(frozen=True)
class RateLimits:
    """How much of the backlog one micro-batch may take."""

    max_files: int | None = None
    max_bytes: str | None = None

    @staticmethod
    def one_batch() -> "RateLimits":
        """A micro-batch of about the size the service being replaced takes in one batch."""
        return RateLimits(max_bytes=str(BATCH_BYTES))

    def options(self) -> dict[str, str]:
        if self.max_files is not None and self.max_bytes is not None:
            raise ValueError("limit a micro-batch by files or by bytes, not both")
        if self.max_files is not None:
            return {"maxFilesPerTrigger": str(self.max_files)}
        return {"maxBytesPerTrigger": self.max_bytes} if self.max_bytes is not None else {}


def read_stream(
    spark: SparkSession,
    path: str,
    schema: "T.StructType | str",
    content_type: str = "application/x-parquet",
    limits: RateLimits = RateLimits(),
    glob: str | None = None,
    file_column: str | None = None,
) -> DataFrame:
    """Stream of request rows from files that appear below ``path``.

    ``file_column`` adds the file a row came from, where each file is a request.
    """
    fmt = {"application/jsonl": "json"}.get(content_type) or answer_format(content_type)
    reader = spark.readStream.format(fmt).schema(schema).options(**limits.options())
    if fmt == "csv":
        reader = reader.option("header", True).option("escape", '"')
    if content_type == "application/json":
        reader = reader.option("multiLine", True)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    rows = reader.load(_pattern(path))
    return rows if file_column is None else rows.select("*", F.col("_metadata.file_path").alias(file_column))


def _pattern(path: str) -> str:
    """A file stream wants a folder or a pattern, so a single file becomes a pattern of itself."""
    name = path.rstrip("/")
    return f"{name[:-1]}[{name[-1]}]" if name.endswith((".parquet", ".csv", ".json", ".jsonl")) else path


def start(
    stream: DataFrame, name: str, output: str, checkpoint: str, accept: str = "application/x-parquet", available_now: bool = False
) -> StreamingQuery:
    """Start (or, with the same checkpoint, resume) a named stream that appends to ``output``."""
    fmt = answer_format(accept)
    writer = stream.writeStream.queryName(name).outputMode("append").format(fmt).option("checkpointLocation", checkpoint)
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(output)


def find(spark: SparkSession, name: str) -> StreamingQuery | None:
    """Attach to a running stream by name."""
    return next((q for q in spark.streams.active if q.name == name), None)


def stop(spark: SparkSession, name: str) -> bool:
    query = find(spark, name)
    if query is None:
        return False
    query.stop()
    return True


def run_available(
    stream: DataFrame, name: str, output: str, checkpoint: str, accept: str = "application/x-parquet"
) -> None:
    """Process what is there, then end: nothing keeps running in between."""
    start(stream, name, output, checkpoint, accept, available_now=True).awaitTermination()
