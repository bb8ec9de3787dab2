"""From raw documents to packed token ids in five stages, each written and read again.

Every stage is a function of (spark, docs, sf_dir). All but the last give the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidecast.llm.common import table
from tidecast.llm.compression import fit_quality, keep_good
from tidecast.llm.decontamination import drop_contaminated
from tidecast.llm.jaccard import drop_near_duplicates
from tidecast.llm.mixing import mix_sources
from tidecast.llm.token_output import token_rows
from tidecast.session import scratch_path


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier, fitted on the labels, doesn't reject."""
    return keep_good(docs, fit_quality(docs, table(spark, sf_dir, "labels")))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates."""
    return drop_near_duplicates(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as many times as the mix takes them."""
    return mix_sources(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document's ids lie in the packed files, their number and their crc32."""
    return token_rows(spark, docs)


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("mixing sources", mixed),
    ("token ids", token_ids),
]

# The classifier, the fingerprints and the tokenizer can't be expressed in SQL; tests hold the
# stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
