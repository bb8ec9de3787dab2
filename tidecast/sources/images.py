"""Image files as binary columns, and the path arithmetic that goes with them."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark import Accumulator
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.functions.paths import common_parts, normal_path
from tidecast.operators.columns import col
from tidecast.sources.files import store_of

# Column roles that mark an image column, in the order they are looked for.
IMAGE_ROLES = ("image_path", "image", "image_bytearray")
HELD = 64 << 20  # bytes of contents in a batch of rows
FOLDER_FILES = 1000  # files that a task writes into one folder
WRITTEN = "path string, length long"


def read_images(path: str, glob: str | None = None, spark: SparkSession | None = None) -> DataFrame:
    """One row per file of a directory (at any depth) or of a single file: path, length, content."""
    reader = (spark or SparkSession.active()).read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(normal_path(F.col("path")).alias("path"), "length", "content")


def attach_image_bytes(df: DataFrame, image_column: str, images: DataFrame) -> DataFrame:
    """Replace the path in ``image_column`` by the file's content; a path without file is an error.

    Only files that ``df`` names are read into the join. Spark broadcasts the content when it
    is measurably small; otherwise hot paths are split by the adaptive skew join.
    """
    _check_column(df, image_column)
    files = images.select(F.col("path").alias("_path"), F.col("content").alias("_content"))
    joined = df.withColumn("_path", normal_path(col(image_column))).join(files, "_path", "left")
    missing = F.raise_error(F.concat(F.lit("no image at "), F.col("_path"))).cast("binary")
    bytes_ = F.when(F.col("_path").isNotNull() & F.col("_content").isNull(), missing).otherwise(F.col("_content"))
    return joined.select(*[bytes_.alias(c) if c == image_column else col(c) for c in df.columns])


def _check_column(df: DataFrame, image_column: str) -> None:
    if image_column not in df.columns:
        raise ValueError(f"{image_column!r} is no valid image column; the table has {', '.join(df.columns)}")


def list_images(path: str, glob: str | None = None, spark: SparkSession | None = None) -> DataFrame:
    """(path, length) of the files ``read_images`` would read; no content is opened."""
    return read_images(path, glob, spark).select("path", "length")


def attach_named_files(df: DataFrame, image_column: str, bytes_read: Accumulator | None = None) -> DataFrame:
    """Replace the path in ``image_column`` by the file's content, opening only files that rows name.

    Nothing is listed, joined or shuffled: each task sorts its own rows by path, opens every path
    once, and hands on batches of at most HELD bytes. A null path stays null; a path without file is
    an error; repeated rows stay. ``bytes_read`` counts what was read. Paths of a store that only
    Spark's readers open need ``attach_image_bytes``.
    """
    _check_column(df, image_column)
    place = df.columns.index(image_column)
    fields = [T.StructField(f.name, T.BinaryType() if f.name == image_column else f.dataType) for f in df.schema.fields]

    def load(batches: Iterator) -> Iterator:
        import pyarrow as pa

        opened, content = None, None
        for batch in batches:
            rest = batch.columns
            paths, at, held = batch.column(place).to_pylist(), 0, []
            size = 0
            for i, path in enumerate(paths):
                if path is not None and path != opened:
                    store, name = store_of(path)
                    with store.open_input_stream(name) as file:
                        opened, content = path, file.read()
                    if bytes_read is not None:
                        bytes_read.add(len(content))
                held.append(None if path is None else content)
                size += 0 if path is None else len(content)
                if size >= HELD or i + 1 == len(paths):
                    columns = [pa.array(held, pa.binary()) if j == place else c.slice(at, len(held)) for j, c in enumerate(rest)]
                    yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)
                    at, held, size = i + 1, [], 0

    named = df.withColumn(image_column, normal_path(col(image_column)))
    return named.sortWithinPartitions(col(image_column)).mapInArrow(load, T.StructType(fields))


def write_files(df: DataFrame, content: str, folder: str) -> DataFrame:
    """(path, length) of new files below ``folder``, one for the content of every row (null: empty).

    Tasks write them in place; Spark's writers open, rename and list single files at a much higher
    price. A repeated task writes files of its own, and those of a failed one are named by no row.
    Runs the job and keeps the rows beside the files.
    """
    spark = df.sparkSession

    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        store, root = store_of(folder)
        prefix = folder.rstrip("/")
        task, n = TaskContext.get().taskAttemptId(), 0
        for batch in batches:
            paths, lengths = [], []
            for value in batch.column(0):
                data = value.as_py() or b""
                if n % FOLDER_FILES == 0:
                    store.create_dir(f"{root}/files/{task}-{n // FOLDER_FILES}", recursive=True)
                name = f"files/{task}-{n // FOLDER_FILES}/{n}.bin"
                with store.open_output_stream(f"{root}/{name}") as file:
                    file.write(data)
                paths.append(f"{prefix}/{name}")
                lengths.append(len(data))
                n += 1
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(lengths, pa.int64())], ["path", "length"])

    named = df.select(col(content).cast("binary").alias("content")).mapInArrow(write, WRITTEN)
    named.write.parquet(f"{folder}/named")
    rows = spark.read.schema(WRITTEN).parquet(f"{folder}/named")
    return rows.select(normal_path(F.col("path")).alias("path"), "length")


def content_name(content: Column) -> Column:
    """File name derived from the bytes; equal bytes share one name."""
    return F.concat(F.lit("tabular_image_"), F.sha1(content.cast("binary")), F.lit(".png"))


def name_images(images: DataFrame, content: str = "content") -> DataFrame:
    """Distinct contents as (name, copies); the bytes themselves are not shuffled."""
    return images.select(content_name(col(content)).alias("name")).groupBy("name").agg(F.count("*").alias("copies"))


def relativize_paths(df: DataFrame, path_column: str) -> tuple[DataFrame, str]:
    """Paths below their common parent (whose own name is kept), and the common path.

    Runs one aggregate job for the common path, which comes back as a single string.
    """
    parts = common_parts(df, path_column)
    # Absolute paths begin with an empty part, which never belongs to a relative path.
    drop = max(len(parts) - 1, 1 if parts[:1] == [""] else 0)
    split = F.split(normal_path(col(path_column)), "/")
    relative = F.array_join(F.slice(split, drop + 1, F.greatest(F.size(split) - drop, F.lit(0))), "/")
    return df.withColumn(path_column, relative), "/".join(parts)


def reroot_paths(df: DataFrame, path_column: str, root: str) -> DataFrame:
    return df.withColumn(path_column, F.concat(F.lit(root.rstrip("/") + "/"), col(path_column)))


def mark_image(df: DataFrame, column: str, role: str = "image_path") -> DataFrame:
    """Tag a column as image; the tag travels in the schema."""
    return df.withMetadata(column, {**df.schema[column].metadata, "role": role})


def find_image_column(df: DataFrame, roles: tuple[str, ...] = IMAGE_ROLES) -> str | None:
    """First column tagged with one of ``roles``."""
    return next((f.name for f in df.schema.fields if f.metadata.get("role") in roles), None)
