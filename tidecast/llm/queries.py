"""One query per operator over its whole table, and the SQL that must agree where there is any."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.llm.common import crc_mod, table
from tidecast.llm.compression import fit_quality, score_quality
from tidecast.llm.decontamination import benchmark_matches
from tidecast.llm.host_rules import apply_rules
from tidecast.llm.jaccard import similar_components
from tidecast.llm.lexical_search import search
from tidecast.llm.lines import duplicate_lines
from tidecast.llm.lm_scoring import score_texts
from tidecast.llm.mixing import mix_report
from tidecast.llm.secrets import scan_secrets
from tidecast.llm.token_counts import token_counts
from tidecast.llm.token_output import token_rows
from tidecast.llm.trie import conversation_trie
from tidecast.llm.warc import warc_rows


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(table(spark, sf_dir, "documents")).drop("host", "host_rate")


def op4_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, model).select(
        "doc_id",
        (crc_mod(F.col("doc_id"), 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op5_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = similar_components(table(spark, sf_dir, "documents"))
    return found.select(F.col("key").alias("doc_id"), "n_shingles", "component_id")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", F.size("dropped").cast("long").alias("n_dropped"), F.array_join(F.col("dropped").cast("array<string>"), ",").alias("dropped")
    )


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_rows(spark, table(spark, sf_dir, "pages")).drop("url", "file")


def op9_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_rows(spark, table(spark, sf_dir, "documents"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans"
    )


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_mix": op1_mix,
    "op2_decontaminate": op2_decontaminate,
    "op3_host_rules": op3_host_rules,
    "op4_compression_quality": op4_compression_quality,
    "op5_context_tree": op5_context_tree,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_line_dedup": op7_line_dedup,
    "op8_warc": op8_warc,
    "op9_token_ids": op9_token_ids,
    "op10_secrets": op10_secrets,
    "op11_ranked_search": op11_ranked_search,
    "op12_token_counts": op12_token_counts,
    "op13_prefix_trie": op13_prefix_trie,
}
