"""Reading tables, converting between formats, and reading request files."""

from __future__ import annotations

import os
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.operators.columns import align_columns, col

# File endings and request content types that are understood.
CSV_ENDINGS = (".csv", ".tsv")
PARQUET_ENDINGS = (".parquet", ".pq")
REQUEST_TYPES = ("application/x-parquet", "text/csv", "application/json", "application/jsonl")


def table_format(path: str) -> str:
    name = str(path).rstrip("/")
    if name.endswith(CSV_ENDINGS):
        return "csv"
    if name.endswith(PARQUET_ENDINGS):
        return "parquet"
    raise ValueError(f"cannot tell the format of {name!r}: not supported, only {', '.join((*CSV_ENDINGS, *PARQUET_ENDINGS))}")


def _session(spark: SparkSession | None) -> SparkSession:
    return spark or SparkSession.active()


# Values may hold line ends and outer white space; with these options they come back as they were.
CSV_READ = {"escape": '"', "multiLine": True, "mode": "FAILFAST", "enforceSchema": False}
CSV_WRITE = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def _struct(schema: "T.StructType | str") -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def read_csv(
    path: str,
    schema: "T.StructType | str | None" = None,
    separator: str = ",",
    spark: SparkSession | None = None,
    line_ends: bool = True,
) -> DataFrame:
    """CSV with a header in every file, columns matched by name.

    Types are inferred unless a schema is given; then its columns are returned in its order and
    others are left out. Files whose headers differ are refused, and so are malformed rows.

    Quoted values may hold line ends, so one task reads a whole file. ``line_ends=False`` says that
    none does: then uncompressed files are split among tasks like any other, and a value with a line end
    in it is a malformed row.
    """
    reader = _session(spark).read.options(**(CSV_READ | {"multiLine": line_ends}), sep=separator)
    if schema is None:
        return reader.csv(path, header=True, inferSchema=True)
    wanted = _struct(schema)
    head = first_line(path, spark, separator)
    if not head:
        return _session(spark).createDataFrame([], wanted)
    known = {f.name: f.dataType for f in wanted}
    by_file = T.StructType([T.StructField(c, known.get(c, T.StringType())) for c in head])
    missing = [c for c in known if c not in head]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    return align_columns(reader.csv(path, header=True, schema=by_file), wanted.fieldNames())


def read_table(
    source: "DataFrame | str | Path",
    schema: "T.StructType | str | None" = None,
    spark: SparkSession | None = None,
    line_ends: bool = True,
) -> DataFrame:
    """A DataFrame as is; a path by its ending. CSV types are inferred unless a schema is given.

    ``line_ends=False`` lets large CSV files be split, see ``read_csv``.
    """
    if isinstance(source, DataFrame):
        return source
    if not isinstance(source, (str, os.PathLike)):
        raise ValueError(f"not supported: a table given as {type(source).__name__}")
    path = str(source)
    if table_format(path) == "parquet":
        reader = _session(spark).read
        return (reader.schema(schema) if schema is not None else reader).parquet(path)
    return read_csv(path, schema, "\t" if path.rstrip("/").endswith(".tsv") else ",", spark, line_ends)


def as_frame(source: "DataFrame | str | Path | None") -> DataFrame | None:
    return None if source is None else read_table(source)


def convert_format(source: "DataFrame | str | Path", fmt: str, target: str, spark: SparkSession | None = None) -> str:
    """Path to the table in format ``fmt``; a file that already has it is left where it is."""
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"not supported as a target format: {fmt}")
    if not isinstance(source, DataFrame) and table_format(str(source)) == fmt:
        return str(source)
    frame = read_table(source, spark=spark)
    if fmt == "csv":
        frame.write.mode("overwrite").options(**CSV_WRITE).csv(target)
    else:
        frame.write.mode("overwrite").parquet(target)
    return target


def read_requests(
    path: str, content_type: str, schema: "T.StructType | str | None" = None, spark: SparkSession | None = None
) -> DataFrame:
    """Request files by content type: Parquet, CSV, JSON arrays, or JSON lines."""
    session = _session(spark)
    if content_type == "application/x-parquet":
        return session.read.parquet(path)
    if content_type == "text/csv":
        return read_csv(path, schema, spark=session)
    if content_type in ("application/json", "application/jsonl"):
        return session.read.json(path, schema=schema, multiLine=content_type == "application/json", mode="FAILFAST")
    raise ValueError(f"requests of type {content_type} are not supported")


def first_line(path: str, spark: SparkSession | None = None, separator: str = ",") -> list[str]:
    """Fields of the first record of the first file."""
    row = _session(spark).read.options(**CSV_READ, sep=separator).csv(path, header=False).limit(1).collect()
    return ["" if x is None else x for x in row[0]] if row else []


def check_width(found: int, expected: int) -> None:
    if found != expected:
        raise ValueError(f"rows of {found} columns, but the model expects {expected}")


def _inferred(df: DataFrame) -> DataFrame:
    """Text columns as the narrowest of int, bigint and double that holds all their values."""
    kinds = ("int", "bigint", "double")
    fits = [
        F.bool_and(col(c).isNull() | col(c).try_cast(kind).isNotNull()).alias(f"{i}_{kind}")
        for i, c in enumerate(df.columns)
        for kind in kinds
    ]
    found = df.agg(*fits).first()
    chosen = [next((k for k in kinds if found[f"{i}_{k}"]), "string") for i in range(len(df.columns))]
    return df.select(*[col(c).cast(k).alias(c) for c, k in zip(df.columns, chosen)])


def read_headerless(
    path: str, expected: "Sequence[str] | T.StructType", spark: SparkSession | None = None
) -> DataFrame:
    """CSV files each of which may lack its header.

    Every file is judged by its own first record: one that has the expected names (in any order) is
    its header and names its columns; otherwise it is data, and columns go by position. So a folder
    may mix files with and without headers, and with headers in other orders. Rows of another width
    are an error. Costs one pass more, for the first records.
    """
    schema = expected if isinstance(expected, T.StructType) else None
    names = schema.fieldNames() if schema is not None else list(expected)
    session = _session(spark)
    head = first_line(path, session)
    if not head:
        return session.createDataFrame([], schema or ", ".join(f"`{n}` string" for n in names))
    check_width(len(head), len(names))
    text = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
    # The ids only compare rows of one file, which one task reads in order.
    rows = session.read.options(**CSV_READ).csv(path, header=False, schema=text).select(
        F.array(*text.fieldNames()).alias("row"), F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at")
    )
    first = rows.groupBy("file").agg(F.min("at").alias("first"), F.min_by("row", "at").alias("head"))
    heads = first.where(F.array_sort("head") == F.array_sort(F.lit(names))).withColumnRenamed("file", "of")
    data = rows.join(heads, F.col("file") == F.col("of"), "left").where("first IS NULL OR at <> first")
    place = lambda i, n: F.coalesce(F.array_position("head", n), F.lit(i + 1)).cast("int")
    out = data.select(*[F.element_at("row", place(i, n)).alias(n) for i, n in enumerate(names)])
    if schema is None:
        return _inferred(out)
    return out.select(*[col(f.name).cast(f.dataType).alias(f.name) for f in schema])
