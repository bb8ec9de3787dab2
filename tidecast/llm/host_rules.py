"""Quality rules per document, and host verdicts from their failures.

Only built-in functions are used. Every document is profiled where it lies: repeated windows are
found by sorting the hashes of a text's own windows, so no word leaves its row. What is shuffled is
one slim row per document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import SPACE, named, stored, words_of

WINDOW = 5


def _windows(words: Column) -> Column:
    """A 64-bit hash of each run of five words; none where there are fewer than two runs."""
    each = F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]),
    )
    return F.when(F.size(words) > WINDOW, each)


def _covered(starts: Column) -> Column:
    """Words under windows that begin at the sorted ``starts``."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        starts,
        zero,
        lambda s, p: F.struct(
            (p + WINDOW).alias("end"), (s["n"] + p + WINDOW - F.greatest(p, s["end"])).alias("n")
        ),
        lambda s: s["n"],
    )


def text_profile(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """One row per document: key, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words.

    Null and empty texts have zero of everything. Repeated rows stay repeated. Other columns are
    not read, so their names cannot clash.
    """
    body = F.coalesce(named(text), F.lit(""))
    split = docs.select(
        named(key).alias("key"), named(host).alias("host"), body.alias("body"), words_of(named(text)).alias("words")
    )
    lines = F.filter(F.split("body", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counted = split.select(
        "key",
        "host",
        F.size("words").cast("long").alias("n_words"),
        (F.char_length("body") - F.regexp_count("body", F.lit(SPACE))).cast("long").alias("word_chars"),
        F.regexp_count("body", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        _windows(F.col("words")).alias("grams"),
    )
    twice = F.size(F.array_distinct("grams")) < F.size("grams")
    pairs = F.array_sort(F.transform("grams", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    ranked = counted.select(
        "key", "host", "n_words", "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(twice, pairs).alias("ranked"),
    )
    met = F.filter(
        "ranked",
        lambda x, i: F.coalesce(F.get("ranked", i - 1)["g"] == x["g"], F.lit(False))
        | F.coalesce(F.get("ranked", i + 1)["g"] == x["g"], F.lit(False)),
    )
    starts = F.array_sort(F.transform(met, lambda x: x["i"]))
    return ranked.select(
        "key", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.coalesce(_covered(starts), F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def failed_rules(min_words: int = 10, repeat_percent: int = 20) -> Column:
    """Whether a profile breaks a rule: too few words, or too large a share of repeated ones."""
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))


def host_verdicts(profiles: DataFrame, max_rate: float = 0.5) -> DataFrame:
    """One row per host: documents, failures, shrunk failure rate, and whether the host is rejected.

    The rates of all hosts give the beta prior by their mean and variance; a host's rate is the
    posterior mean, so a host of few documents stays near the mean. Null is a host of its own. One
    row of statistics reaches the driver. A table without rows has no hosts.
    """
    hosts = profiles.groupBy("host").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("base_failed").cast("long")).alias("n_failed")
    )
    rate = F.col("n_failed") / F.col("n_docs")
    seen = hosts.agg(F.avg(rate), F.var_pop(rate)).first()
    mean, spread = seen[0] or 0.0, seen[1] or 0.0
    held = mean * (1 - mean)
    strength = min(max(held / spread - 1, 1.0), 1e6) if spread > 1e-12 else 1e6
    shrunk = (F.col("n_failed") + mean * strength) / (F.col("n_docs") + strength)
    return hosts.select("host", "n_docs", "n_failed", shrunk.alias("rate"), (shrunk > max_rate).alias("rejected"))


def apply_rules(
    docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source",
    min_words: int = 10, repeat_percent: int = 20, max_rate: float = 0.5,
) -> DataFrame:
    """Profiles with ``base_failed``, the host's shrunk ``host_rate`` and ``kept``.

    A document stays if it breaks no rule itself and its host's shrunk rate is at most
    ``max_rate``. Profiles are written once to the shared folder, because both the host counts and
    the join back read them. An empty table gives no rows.
    """
    profiles = stored(
        text_profile(docs, key, text, host).withColumn("base_failed", failed_rules(min_words, repeat_percent)),
        "host-rules",
    )
    verdicts = host_verdicts(profiles, max_rate).select(F.col("host").alias("of"), "rate", "rejected")
    return profiles.join(verdicts, F.col("host").eqNullSafe(F.col("of")), "left").select(
        F.col("key").alias(key), "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", F.col("rate").alias("host_rate"), (~F.col("base_failed") & ~F.col("rejected")).alias("kept"),
    )
