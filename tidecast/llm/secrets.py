"""Secrets in text: fixed patterns, and strings that a battery of tests can't tell from random.

Only built-in functions are used. A pattern's matches and the gaps between them come from the text
in its row; only their lengths are exploded, and a running sum over a text's own matches gives the
code point positions. Long strings of code characters, or their parts where separators of several
alphabets meet in one, then get an encoding (the smallest alphabet that holds them) and three tests of randomness in it: chi-squared uniformity over the alphabet, the
runs above and below its middle, and the correlation of neighbours. Within each length class the
strings that are surely not random are found with a controlled false discovery rate and dropped;
what is left is reported.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.llm.common import named, stored

# What the base patterns are, in the order in which kinds are listed.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # a match of 20 or more characters; a shorter one has no longer part
HEX = r"[0-9a-f]{24,}"
CODE = r"[A-Za-z0-9+/_-]{20,}={0,2}"
KINDS = ("assign", "access", "hex", "random")

# Alphabets in the order in which they are tried.
ALPHABETS = {
    "hex": "0123456789abcdef",
    "hex_upper": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "base36_upper": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "base62": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "+/0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64_url": "-0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ_abcdefghijklmnopqrstuvwxyz",
}
# Alphabets of strings of letters alone, tried before the others.
LETTERS = {
    "letters_lower": "abcdefghijklmnopqrstuvwxyz",
    "letters_upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "letters": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
}
# Separators at which a string is cut that has some of both alphabets, each way by itself.
CUTS = ("[+/]", "[_-]", "[+/_-]")
LEAST = 20  # characters of a part


def _matches(body: Column, kind: str, pattern: str, group: int = 0) -> Column:
    """(kind, i, length of the gap before, length, text, length of ``group``) of each match, in order."""
    p = F.lit(pattern)
    parts = F.arrays_zip(
        F.split(body, pattern, -1).alias("gaps"),
        F.regexp_extract_all(body, p, F.lit(0)).alias("hits"),
        F.regexp_extract_all(body, p, F.lit(group)).alias("values"),
    )
    each = F.transform(
        parts,
        lambda x, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("i"), F.char_length(x["gaps"]).alias("gap"),
            F.char_length(x["hits"]).alias("long"), x["hits"].alias("hit"), F.char_length(x["values"]).alias("value"),
        ),
    )
    return F.when(body.rlike(pattern), F.filter(each, lambda x: x["hit"].isNotNull()))


def found_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, h, kind, start, end, hit) of all matches, failing ones dropped; one row for repeated rows.

    ``h`` is the hash of the text, so that rows with the same key and other texts stay apart. The
    kind ``random`` holds every long string of code characters, not tested yet.
    """
    body = F.coalesce(named(text), F.lit(""))
    none = F.array().cast("array<struct<kind:string,i:int,gap:int,long:int,hit:string,value:int>>")
    kinds = [("assign", ASSIGN, 2), ("access", ACCESS, 0), ("hex", HEX, 0), ("random", CODE, 0)]
    lists = [F.coalesce(_matches(F.col("body"), *k), none) for k in kinds]
    rows = (
        docs.select(named(key).alias("key"), body.alias("body"), F.xxhash64(body).alias("h"))
        .select("key", "h", F.explode(F.concat(*lists)).alias("m"))
        .select("key", "h", "m.*")
        .repartition("key", "h", "kind")
        .groupBy("key", "h", "kind", "i")
        .agg(*[F.first(c).alias(c) for c in ("gap", "long", "hit", "value")])
    )
    upto = Window.partitionBy("key", "h", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.withColumn("end", F.sum(F.col("gap") + F.col("long")).over(upto).cast("int"))
    return placed.where("kind <> 'assign' OR value >= 6").select(
        "key", "h", "kind", (F.col("end") - F.col("long")).alias("start"), "end", "hit"
    )


def coded_parts(found: DataFrame) -> DataFrame:
    """``found`` with strings that no alphabet holds replaced by their parts of LEAST or more characters."""
    mixed = F.col("hit").rlike("[+/]") & F.col("hit").rlike("[_-]")
    lists = []
    for cut in CUTS:
        parts = F.split("hit", cut, -1)
        # Each part with where it begins: its length and one separator further for every part before.
        placed = F.aggregate(
            parts,
            F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<at:int,part:string>>").alias("out")),
            lambda s, x: F.struct(
                (s["at"] + F.char_length(x) + 1).alias("at"),
                F.concat(s["out"], F.array(F.struct(s["at"].alias("at"), x.alias("part")))).alias("out"),
            ),
            lambda s: s["out"],
        )
        lists.append(F.filter(placed, lambda x: F.char_length(F.regexp_replace(x["part"], "=+$", "")) >= LEAST))
    parts = found.where(mixed).withColumn("p", F.explode(F.array_distinct(F.concat(*lists))))
    start = F.col("start") + F.col("p.at")
    cut = parts.select(
        *[c for c in found.columns if c not in ("start", "end", "hit")],
        start.alias("start"), (start + F.char_length("p.part")).alias("end"), F.col("p.part").alias("hit"),
    )
    return found.where(~mixed).unionByName(cut)


def _upper_tail(z: Column) -> Column:
    """P(Z > z) of the standard normal distribution, by a rational approximation of the error function."""
    x = F.abs(z) / 2**0.5
    t = 1 / (1 + 0.3275911 * x)
    # Coefficients of Abramowitz and Stegun 7.1.26.
    series = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    half = 0.5 * series * F.exp(-x * x)
    return F.when(z >= 0, half).otherwise(1 - half)


def randomness(hits: DataFrame) -> DataFrame:
    """``hits`` with ``encoding`` and ``p``, the smallest of three p-values times three.

    Strings with letters are tested, those of letters alone in alphabets of letters; others have no
    encoding and a p of 0. A string that uses one half of its alphabet only fails the test of runs.
    """
    bare = F.regexp_replace("hit", "=+$", "")
    code = F.when(~bare.rlike("[A-Za-z]"), None)
    alphabets = LETTERS | ALPHABETS
    for name, letters in alphabets.items():
        code = code.when(bare.rlike("^[" + letters.replace("-", r"\-") + "]+$"), name)
    inferred = hits.withColumn("encoding", code).withColumn("bare", bare)
    alphabet = F.element_at(F.create_map(*[F.lit(x) for pair in alphabets.items() for x in pair]), F.col("encoding"))
    values = F.transform(F.split("bare", ""), lambda c: F.instr(F.col("alphabet"), c) - 1)
    coded = inferred.withColumn("alphabet", alphabet).withColumn("v", F.when(F.col("encoding").isNotNull(), values))

    n, size = F.size("v").cast("double"), F.length("alphabet").cast("double")
    zero = F.lit(0.0)
    squares = F.aggregate(
        F.array_distinct("v"), zero, lambda s, d: s + F.pow(F.size(F.filter("v", lambda x: x == d)).cast("double"), 2.0)
    )
    total = F.aggregate("v", zero, lambda s, x: s + x)
    high = F.size(F.filter("v", lambda x: 2 * x >= F.length("alphabet"))).cast("double")
    start = F.struct(F.lit(None).cast("int").alias("last"), F.lit(1.0).alias("runs"))
    turns = F.aggregate(
        "v",
        start,
        lambda s, x: F.struct(
            x.cast("int").alias("last"),
            (s["runs"] + F.when((2 * x >= F.length("alphabet")) != (2 * s["last"] >= F.length("alphabet")), 1.0).otherwise(0.0)).alias("runs"),
        ),
        lambda s: s["runs"],
    )
    summed = coded.select(
        *hits.columns, "encoding", "v", n.alias("n"), size.alias("size"), squares.alias("squares"),
        (total / n).alias("mean"), high.alias("high"), turns.alias("runs"),
    )
    first = F.struct(F.lit(None).cast("double").alias("last"), zero.alias("cov"), zero.alias("var"))
    moments = F.aggregate(
        "v",
        first,
        lambda s, x: F.struct(
            (x - F.col("mean")).alias("last"),
            (s["cov"] + F.coalesce(s["last"] * (x - F.col("mean")), zero)).alias("cov"),
            (s["var"] + (x - F.col("mean")) * (x - F.col("mean"))).alias("var"),
        ),
        lambda s: F.struct(s["cov"].alias("cov"), s["var"].alias("var")),
    )
    df = F.col("size") - 1
    chi = F.col("size") / F.col("n") * F.col("squares") - F.col("n")
    z_chi = (F.pow(chi / df, 1 / 3) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
    low = F.col("n") - F.col("high")
    mu = 2 * F.col("high") * low / F.col("n") + 1
    spread = F.sqrt((mu - 1) * (mu - 2) / (F.col("n") - 1))
    z_runs = F.when(spread > 0, (F.col("runs") - mu) / spread).otherwise(99.0)
    z_serial = F.when(F.col("m.var") > 0, (F.col("m.cov") / F.col("m.var") + 1 / F.col("n")) * F.sqrt("n")).otherwise(99.0)
    least = F.least(_upper_tail(z_chi), 2 * _upper_tail(F.abs(z_runs)), 2 * _upper_tail(F.abs(z_serial)))
    p = F.when(F.col("encoding").isNotNull(), F.least(F.lit(1.0), 3 * least)).otherwise(0.0)
    return summed.withColumn("m", moments).select(*hits.columns, "encoding", p.alias("p"))


def random_strings(tested: DataFrame, rate: float = 0.05) -> DataFrame:
    """Those of ``tested`` that are not shown to be other than random.

    The step-up rule of Benjamini and Hochberg at ``rate`` runs within each length class (lengths
    of the same leading two bits) over counts by p-value, in steps of a twentieth of a decade:
    short strings are judged among short ones, where the tests say less.
    """
    bits = F.bin(F.char_length("hit").cast("long"))
    step = F.least(F.lit(400), F.floor(-20 * F.log10(F.greatest(F.col("p"), F.lit(1e-20))))).cast("int")
    classed = tested.where("encoding IS NOT NULL").select(
        "*", F.concat(F.length(bits).cast("string"), F.lit(":"), F.substring(bits, 1, 2)).alias("class"), step.alias("step")
    )
    counts = classed.groupBy("class", "step").agg(F.count(F.lit(1)).alias("n"), F.max("p").alias("most"))
    up = Window.partitionBy("class").orderBy(F.col("step").desc()).rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy("class")
    cuts = (
        counts.select("class", "step", "most", F.sum("n").over(up).alias("upto"), F.sum("n").over(every).alias("all"))
        .where(F.col("most") <= rate * F.col("upto") / F.col("all"))
        .groupBy(F.col("class").alias("of"))
        .agg(F.min("step").alias("cut"))
    )
    judged = classed.join(cuts, F.col("class") == F.col("of"), "left")
    return judged.where("cut IS NULL OR step < cut").select(*tested.columns)


def scan_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", rate: float = 0.05) -> DataFrame:
    """One row per row of ``docs``: key, counts of the base kinds, ``base`` and ``spans``.

    Spans are written kind:start:end in code points, ordered by start, then kind, then end, and
    joined by commas; ``base`` has those of the fixed patterns, ``spans`` also those of random
    strings. Null and empty texts have none. Repeated rows get the same spans each. An empty table
    gives no rows. Other columns are not read.
    """
    found = stored(found_spans(docs, key, text), "secret-spans")
    tested = randomness(coded_parts(found.where("kind = 'random'")))
    spans = found.where("kind <> 'random'").drop("hit").unionByName(random_strings(tested, rate).select("key", "h", "kind", "start", "end"))
    place = F.array_position(F.lit(list(KINDS)), F.col("kind"))
    item = F.struct("start", place.alias("place"), "end", "kind")
    listed = lambda spans: F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ","
    )
    per_text = spans.groupBy(F.col("key").alias("of"), F.col("h").alias("of_h")).agg(
        F.sort_array(F.collect_list(item)).alias("all"),
        *[F.sum(F.when(F.col("kind") == k, 1).otherwise(0)).alias(f"n_{k}") for k in KINDS[:3]],
    )
    every = docs.select(named(key).alias("key"), F.xxhash64(F.coalesce(named(text), F.lit(""))).alias("h"))
    met = F.col("key").eqNullSafe(F.col("of")) & (F.col("h") == F.col("of_h"))
    base = F.filter("all", lambda x: x["kind"] != "random")
    return every.join(per_text, met, "left").select(
        F.col("key").alias(key),
        *[F.coalesce(F.col(f"n_{k}"), F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS[:3]],
        F.coalesce(listed(base), F.lit("")).alias("base"),
        F.coalesce(listed(F.col("all")), F.lit("")).alias("spans"),
    )
