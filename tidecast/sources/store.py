"""Small JSON documents and folders, on any file system Spark can reach."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


def write_json(spark: SparkSession, path: str, document: dict) -> None:
    text = json.dumps(document)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_json(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def _folder(spark: SparkSession, path: str):
    """(file system, Hadoop path) through the session's own settings."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, sorted; none if there is no such folder."""
    fs, place = _folder(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds; nothing happens if it is gone."""
    fs, place = _folder(spark, path)
    fs.delete(place, True)
