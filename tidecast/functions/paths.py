"""Path arithmetic on columns of "/"-separated paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.operators.columns import col


def normal_path(path: Column) -> Column:
    """Local paths without their scheme, so ``file:/a/b`` and ``/a/b`` compare equal."""
    return F.regexp_replace(path, r"^file:/+", "/")


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def common_path(df: DataFrame, path_column: str) -> DataFrame:
    """One row ``common_path``: the longest whole-component prefix of all paths.

    The prefix of a set is the prefix of its smallest and largest member, provided the
    separator sorts before every other character; hence the translation.
    """
    flat = F.translate(normal_path(col(path_column)), "/", "\u0001")
    ends = df.agg(F.split(F.min(flat), "\u0001").alias("lo"), F.split(F.max(flat), "\u0001").alias("hi"))
    shared = F.array_size(
        F.filter(
            F.sequence(F.lit(1), F.least(F.size("lo"), F.size("hi"))),
            lambda i: F.slice(F.col("lo"), 1, i) == F.slice(F.col("hi"), 1, i),
        )
    )
    return ends.select(F.array_join(F.slice("lo", F.lit(1), shared), "/").alias("common_path"))


def common_parts(df: DataFrame, path_column: str) -> list[str]:
    found = common_path(df, path_column).first()[0]
    return found.split("/") if found is not None else []
