"""Mixing sources to target weights by systematic sampling.

Only built-in functions are used. Within a source the documents are ordered by size class and a
hash; their expected copies are summed up along that order, one random offset is added, and a
document is emitted once for each whole number that the sum passes. The order is cut into
(source, size class, hash piece) so that a source with a third of all rows is spread over many
tasks: counts per cut give each cut its starting rank, and only ranks inside a cut need a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.llm.common import WORD, named


def source_targets(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeat: int = 3) -> DataFrame:
    """Targets for (skey, source, source_size): shares by weight, at most ``max_repeat`` times the size.

    Sources in code point order, null last, weigh ``weights`` in turn. What a capped source leaves
    is shared among the others by weight until none is above its cap; that level is found in one
    pass over the sources ordered by cap per weight. The table has one short row per source, which
    is what the two windows without a key hold.
    """
    order = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.lit(list(weights)), ((order - 1) % len(weights) + 1).cast("int")).cast("double")
    cap = (F.col("source_size") * max_repeat).cast("double")
    caps = sources.select("skey", "source_size", weight.alias("w")).withColumn("cap", cap)
    by = Window.orderBy(F.col("cap") / F.col("w"), "skey")
    whole = by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    onward = by.rowsBetween(0, Window.unboundedFollowing)
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    level = caps.withColumn("own_level", left / F.sum("w").over(onward))
    level = level.withColumn("level", F.max("own_level").over(whole))
    target = F.least(F.col("cap"), F.col("w") * F.col("level"))
    return level.select("skey", "source_size", target.alias("target"))


def _offset(skey: Column, seed: int) -> Column:
    """One number in [0, 1) per source."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), skey).cast("binary")), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / float(1 << 32)


def _sampled(
    docs: DataFrame, keep: Column, key: str, text: str, source: str, weights: tuple[int, ...], max_repeat: int, seed: int
) -> DataFrame:
    """row (what ``keep`` gives), size, source_size, target and copies of each document."""
    digest = F.md5(F.coalesce(named(key).cast("string"), F.lit("")).cast("binary"))
    bits = F.bin(F.col("size"))
    sized = docs.select(
        keep.alias("row"),
        named(source).cast("string").alias("source"),
        F.coalesce(F.regexp_count(named(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        digest.alias("digest"),
        F.xxhash64(named(text)).alias("tie"),
    ).select(
        "row", "size", "digest", "tie", "source",
        F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")).alias("skey"),
        F.concat(F.lpad(F.length(bits).cast("string"), 2, "0"), F.substring(bits, 1, 4)).alias("class"),
        F.substring("digest", 1, 3).alias("piece"),
    )
    cuts = sized.groupBy("skey", "source", "class", "piece").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("words")
    )
    along = Window.partitionBy("skey").orderBy("class", "piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = cuts.select("skey", "class", "piece", F.coalesce(F.sum("n").over(along), F.lit(0)).alias("start"))
    targets = source_targets(
        cuts.groupBy("skey", "source").agg(F.sum("words").alias("source_size")), weights, max_repeat
    )
    starts = starts.join(targets, "skey")
    inside = Window.partitionBy("skey", "class", "piece").orderBy("digest", "tie", "size")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    upto = F.floor(F.col("rate") * F.col("rank") + F.col("offset"))
    below = F.floor(F.col("rate") * (F.col("rank") - 1) + F.col("offset"))
    return (
        sized.drop("source")
        .join(starts, ["skey", "class", "piece"])
        .withColumn("rank", F.col("start") + F.row_number().over(inside))
        .withColumns({"rate": rate, "offset": _offset(F.col("skey"), seed)})
        .select("row", "size", "source_size", "target", (upto - below).cast("int").alias("copies"))
    )


def mix_report(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[int, ...] = (1, 2, 3), max_repeat: int = 3, seed: int = 17,
) -> DataFrame:
    """Each document's key, size in words, its source's size and target, and the copies it gets.

    Null text has size 0; a null source is a source of its own; repeated rows are drawn one by one;
    rows equal in every used column are interchangeable. An empty table gives no rows, and a source
    without words gets no copies. Reruns agree, since the order and the offset come from hashes.
    """
    out = _sampled(docs, named(key), key, text, source, weights, max_repeat, seed)
    return out.withColumnRenamed("row", key)


def mix_sources(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[int, ...] = (1, 2, 3), max_repeat: int = 3, seed: int = 17,
) -> DataFrame:
    """The mixed rows: every document as many times as it is drawn, with the columns of ``docs``."""
    row = F.struct(*[named(c) for c in docs.columns])
    out = _sampled(docs, row, key, text, source, weights, max_repeat, seed).where("copies > 0")
    return out.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*")
