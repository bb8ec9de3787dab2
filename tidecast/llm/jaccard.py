"""All documents that are linked by equal five-word shingles, as components.

Method: prefix filtering with adaptive multi-match prefixes. A document's distinct shingles are put
in one global order, the costly ones (found in many documents) last. Two sets with similarity t
share at least l of the first n - ceil(t n) + l of each, for every l; each document takes its own l
from its size and from the estimated cost of its prefix, lengthens the prefix by that, and a pair
goes on only if it shares the smaller of the two l. Costs are estimates and only decide the order
and l, so they can't change the result.

Lists of documents are then counted exactly, and the prefixes are cut a second time by the same
rule: the sizes of those in a document's lists tell how many shingles any partner shares with it, so
all of its longest lists but one of that many are left out. What is found nowhere else can't be
shared, which bounds the overlap of a pair from above and takes documents out of lists where no
other is small enough for them.

Equal sets become one node first, so copies cost nothing later. A shingle's documents aren't paired
with each other: in each of a few rounds they are paired with one pivot, links are verified on the
whole sets, and components are merged. What then still lies in different components is paired
exhaustively, so no link between different texts is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidecast.llm.common import Stored, named, near, pieces, release, stored
from tidecast.llm.graph import Growing
from tidecast.session import bounded_batches

WORDS = 5
PERCENT = 75  # of the union, that the intersection must have
COSTLY = 1 << 23  # most shingles that are told to be costly; 8 bytes each go to every worker
SEEN = 16  # documents from which a shingle is told to be costly
RUN = 4_000_000  # shingles counted together in a task
ROUNDS = 2  # of pivots, before what is left is paired exhaustively
WORD_LIMIT = 1 << 18  # words whose hashes a worker remembers

SIDES = {"node": "", "n": "n", "slack": "s", "cut": "c", "most": "m"}  # columns of either side of a pair

BITS = 16  # longs of a set's bitmap

PROFILE = "key long, h long, node long, n int, need int, prefix array<long>"


class Shingler:
    """Distinct shingle hashes of texts (A-Z lower-cased, words by ASCII white space)."""

    def __init__(self):
        import numpy as np
        import xxhash

        class Hashes(dict):
            def __missing__(self, word):
                value = self[word] = xxhash.xxh3_64_intdigest(word)
                return value

        self.np, self.hashes, self.digest = np, Hashes(), xxhash.xxh3_64_intdigest

    def _mixed(self, h):
        """Hashes of every run of five neighbours in ``h``."""
        np = self.np
        mul = np.uint64(0x9E3779B97F4A7C15)
        s = h[: len(h) - WORDS + 1].copy()
        for k in range(1, WORDS):
            s = s * mul + h[k : len(h) - WORDS + 1 + k]
        s ^= s >> np.uint64(32)
        s *= np.uint64(0xD6E8FEB86659FD93)
        s ^= s >> np.uint64(29)
        return s.view(np.int64)

    def sets(self, texts: list[bytes]) -> list:
        """Per text its sorted distinct shingles as int64; empty for a text without words."""
        np = self.np
        if len(self.hashes) > WORD_LIMIT:
            self.hashes.clear()
        words = [t.lower().split() for t in texts]
        sizes = [len(w) for w in words]
        flat = np.fromiter((x for w in words for x in map(self.hashes.__getitem__, w)), np.uint64, sum(sizes))
        runs = self._mixed(flat) if len(flat) >= WORDS else np.zeros(0, np.int64)
        out, at = [], 0
        for n in sizes:
            if n >= WORDS:
                out.append(np.unique(runs[at : at + n - WORDS + 1]))
            elif n:
                short = self.digest(flat[at : at + n].tobytes(), seed=n)
                out.append(np.array([short], np.uint64).view(np.int64))
            else:
                out.append(np.zeros(0, np.int64))
            at += n
        return out


def costly_shingles(docs: DataFrame, text: str = "text"):
    """(shingles, documents that have them): sorted arrays of the most frequent shingles.

    Every document is counted. Tasks leave out shingles that they meet once in a run, so counts are
    lower bounds. At most ``COSTLY`` shingles can each hold that share of all, which bounds what
    reaches the driver and the workers.
    """
    import numpy as np

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        release()
        shingler, run, used = Shingler(), np.empty(RUN, np.int64), 0

        def counted():
            # sorted in place: a run takes its own bytes and little more
            held = run[:used]
            held.sort()
            values, again = np.unique(held[1:][held[1:] == held[:-1]], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(again + 1)], ["shingle", "n"])
            yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([used], pa.int64())], ["shingle", "n"])

        for _, values in pieces(batches, 0):
            for s in shingler.sets(values):
                while len(s):
                    part = s[: RUN - used]
                    run[used : used + len(part)] = part
                    used += len(part)
                    s = s[len(part) :]
                    if used == RUN:
                        yield from counted()
                        used = 0
        if used:
            yield from counted()

    counts = docs.select(named(text).alias("text")).mapInArrow(count, "shingle long, n long")
    totals = stored(counts.groupBy("shingle").agg(F.sum("n").alias("n")).where(f"n >= {SEEN} OR shingle IS NULL"), "costly")
    total = totals.where("shingle IS NULL").agg(F.sum("n")).first()[0] or 0
    rows = totals.where(f"shingle IS NOT NULL AND n >= {max(SEEN, -(-total // COSTLY))}").toArrow()
    shingles, n = rows.column("shingle").to_numpy(), rows.column("n").to_numpy()
    order = np.argsort(shingles)
    return shingles[order], n[order]


def profiles(docs: DataFrame, costly, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """Per row: key, h (hash of its text), node (of its set; null without shingles), n, need (its l) and prefix.

    A task gives the prefix of a node once only; nodes met by several tasks have it several times.
    """
    shared = docs.sparkSession.sparkContext.broadcast(costly)  # bounded by COSTLY

    def profile(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import xxhash

        release()
        shingler, known, counts = Shingler(), *shared.value
        shift = np.uint64(64 - 24)
        marks = np.zeros(1 << 24, bool)  # by leading bits: most shingles are told apart from the costly ones here
        marks[known.view(np.uint64) >> shift] = True
        given: set[int] = set()
        for keys, values in pieces(batches, 1):
            rows = []
            for (k, h), s in zip(((x["key"], x["h"]) for x in keys), shingler.sets(values)):
                n = len(s)
                if not n:
                    rows.append((k, h, None, 0, 0, None))
                    continue
                node = xxhash.xxh3_64_intdigest(s.tobytes())
                node -= (node >> 63) << 64
                if node in given:
                    rows.append((k, h, node, n, 0, None))
                    continue
                if len(given) >= 200_000:
                    given.clear()
                given.add(node)
                cost = np.zeros(n, np.int64)
                maybe = np.flatnonzero(marks[s.view(np.uint64) >> shift])
                if len(maybe) and len(known):
                    at = np.minimum(np.searchsorted(known, s[maybe]), len(known) - 1)
                    cost[maybe] = np.where(known[at] == s[maybe], counts[at], 0)
                ordered = s if not cost.any() else s[np.argsort(cost, kind="stable")]
                base = n - -(-percent * n // 100) + 1
                spent = int(np.sort(cost)[:base].sum())
                need = 1 + n // 16 + min(n // 16, spent.bit_length())
                rows.append((k, h, node, n, need, ordered[: base + need - 1]))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["key", "h", "node", "n", "need", "prefix"]
            )

    slim = docs.select(
        F.struct(named(key).cast("long").alias("key"), F.xxhash64(named(text)).alias("h")).alias("id"), named(text).alias("text")
    )
    return stored(slim.mapInArrow(profile, PROFILE), "shingle-prefixes")


def whole_sets(docs: DataFrame, nodes: DataFrame, n: int, key: str, text: str) -> DataFrame:
    """(node, shingles, bits) of the ``n`` ``nodes`` (node, key): the texts of one key per node are read again.

    ``bits`` has a bit for every shingle by its hash. Texts are chosen where they are read and never shuffled; a few
    others are hashed too, whose sets are then left out by their nodes.
    """

    def shingles(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import xxhash

        release()
        shingler = Shingler()

        def bitmap(shingles):
            out = np.zeros(64 * BITS, np.uint8)
            out[shingles & (64 * BITS - 1)] = 1
            return np.packbits(out).view(np.int64)

        for _, values in pieces(batches, 0):
            sets = [s for s in shingler.sets(values) if len(s)]
            hashes = [xxhash.xxh3_64_intdigest(s.tobytes()) for s in sets]
            arrays = [pa.array([h - ((h >> 63) << 64) for h in hashes], pa.int64()), pa.array(sets, pa.list_(pa.int64()))]
            arrays.append(pa.array([bitmap(s) for s in sets], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(arrays, ["node", "shingles", "bits"])

    slim = docs.select(named(key).cast("long").alias("key"), named(text).alias("text"))
    texts = near(slim, F.xxhash64("key"), nodes, F.xxhash64(nodes["key"]), n).select("text")
    return stored(
        texts.mapInArrow(shingles, "node long, shingles array<long>, bits array<long>")
        .join(nodes.select("node"), "node", "left_semi")
        .dropDuplicates(["node"]),
        "shingle-sets",
    )


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough.

    Bitmaps come first: bits that only one of two sets has are shingles that only one has, so they
    bound the overlap from above, and only pairs within the bound are joined with the sets.
    """

    def both(pairs: DataFrame, column: str) -> DataFrame:
        own = sets.select("node", F.col(column).alias("held"), F.size("shingles").alias("size"))
        for side in ("a", "b"):
            pairs = pairs.join(own.withColumnsRenamed({"node": side, "held": f"held_{side}", "size": f"size_{side}"}), side)
        return pairs

    total = F.col("size_a") + F.col("size_b")
    apart = sum((F.bit_count(F.get("held_a", F.lit(k)).bitwiseXOR(F.get("held_b", F.lit(k)))) for k in range(BITS)), F.lit(0))
    # twice the overlap is at most total - apart
    possible = both(pairs, "bits").where((total - apart) * (100 + percent) >= 2 * percent * total).select("a", "b")
    shared = F.size(F.array_intersect("held_a", "held_b"))
    return both(possible, "shingles").where(100 * shared >= percent * (total - shared)).select("a", "b")


def _overlap(na, nb, percent: int):
    """The least overlap of similar sets of these sizes."""
    return F.ceil((na + nb) * percent / (100 + percent))


def _pairs(candidates: DataFrame, percent: int) -> DataFrame:
    """Distinct (a, b) of candidates that can be similar by size and share enough prefix shingles.

    Prefixes share the least overlap less what the larger rest of a set may hold of it; the
    shingles that either has left out are taken off.
    """
    least = _overlap(F.col("na"), F.col("nb"), percent)
    fits = (F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent) & (F.least("ma", "mb") >= least)
    enough = least - F.greatest("sa", "sb") - F.greatest("ca", "cb")
    counted = candidates.where(fits).groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"), F.min(enough).alias("enough"))
    return counted.where("shared >= enough").select("a", "b")


def _fitting(entries: DataFrame, percent: int) -> DataFrame:
    """Entries whose list has another that is small enough, cut to the shortest lists that are needed.

    The smallest size and the largest rest in a list bound what a partner in it shares from below;
    the least over a node's lists holds for all its partners.
    """
    of, by_node = Window.partitionBy("shingle"), Window.partitionBy("node")
    small, slack = F.min("n").over(of), F.greatest("slack", F.max("slack").over(of))
    listed = entries.withColumns({"small": small, "rest": slack}).where(
        F.col("most") >= _overlap(F.col("n"), F.col("small"), percent)
    )
    shares = _overlap(F.col("n"), F.col("small"), percent) - F.col("rest")
    cut = F.greatest("cut", F.min(shares).over(by_node) - 1)
    return listed.withColumn("cut", cut).where("nth <= met - cut").drop("small", "rest")


def _many(entries: DataFrame, label: str) -> DataFrame:
    """The entries of shingles that are found with more than one value of ``label``."""
    of = Window.partitionBy("shingle")
    return (
        entries.withColumns({"low": F.min(label).over(of), "high": F.max(label).over(of)})
        .where("low <> high")
        .drop("low", "high")
    )


def classes(
    docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT, rounds: int = ROUNDS
) -> DataFrame:
    """Per row of ``docs``: key, h, node, n, root (the same within a component) and the component's smallest key."""
    bounded_batches(docs.sparkSession)
    rows = profiles(docs, costly_shingles(docs, text), key, text, percent)
    entries = rows.where("prefix IS NOT NULL").select(F.explode("prefix").alias("shingle"), "node")
    of, by_node = Window.partitionBy("shingle"), Window.partitionBy("node")
    listed = entries.repartition("shingle").dropDuplicates(["shingle", "node"]).withColumn("c", F.count(F.lit(1)).over(of))
    met = Stored(listed.where("c > 1"), "shared-prefixes")
    nodes = rows.where("node IS NOT NULL").groupBy("node").agg(
        F.min("key").alias("key"), F.first("n").alias("n"), F.max(F.size("prefix")).alias("long")
    )
    # A partner has at least three quarters of the size, which bounds its need from below.
    cut = F.floor(F.floor(F.col("n") * percent / 100) / 16)
    kept = (
        met.rows.join(nodes.drop("key"), "node")
        .withColumns({"met": F.count(F.lit(1)).over(by_node), "nth": F.row_number().over(by_node.orderBy("c", "shingle")), "cut": cut})
        .where("nth <= met - cut")
        .withColumns({"slack": F.col("n") - F.col("long"), "most": F.col("n") - F.col("long") + F.col("met")})
        .drop("c", "long")
    )
    table = Stored(_many(_fitting(kept, percent), "node"), "entries", n=F.count(F.lit(1)))
    met.drop()
    left = table.rows
    able = Stored(left.select("node").distinct().join(nodes, "node").select("node", "key"), "candidate-nodes", n=F.count(F.lit(1)))
    sets = whole_sets(docs, able.rows, able.seen["n"], key, text)
    found = Growing()
    for turn in range(rounds):
        if not table.seen["n"]:
            break
        # first the one with least of its own, which is nearest to the others, then any
        own = [F.col("n") - F.col("most")] if not turn else []
        of = Window.partitionBy("shingle").orderBy(*own, F.xxhash64("node", F.lit(turn)), "node")
        pivoted = left.select(
            *[F.first(c).over(of).alias(f"{short}b") for c, short in SIDES.items()],
            *[F.col(c).alias(f"{short}a") for c, short in SIDES.items()],
        )
        labels = found.add(verified(_pairs(pivoted.where("a <> b"), percent), sets, percent))
        after = Stored(_many(_labelled(left.drop("label"), labels), "label"), "entries", n=F.count(F.lit(1)))
        table.drop()
        table, left = after, after.rows
    if found.labels is not None and table.seen["n"]:
        found.add(verified(_pairs(_across(_fitting(left, percent)), percent), sets, percent))
    return _classes(rows, nodes, found.labels)


def _labelled(entries: DataFrame, labels: DataFrame) -> DataFrame:
    return entries.join(labels, "node", "left").withColumn("label", F.coalesce("root", "node")).drop("root")


def _across(left: DataFrame) -> DataFrame:
    """Every pair of a shingle's nodes with different labels; the most frequent label isn't paired with itself."""
    sizes = left.groupBy("shingle", "label").agg(F.count(F.lit(1)).alias("c"))
    major = sizes.groupBy("shingle").agg(F.max_by("label", F.struct("c", "label")).alias("major"))
    minor = left.join(major, "shingle").where("label <> major")
    minor = minor.select("shingle", "major", F.col("label").alias("other"), *[F.col(c).alias(f"{short}x") for c, short in SIDES.items()])
    pairs = minor.join(left, "shingle").where("label <> other AND (label = major OR x < node)")
    flip = F.col("x") < F.col("node")
    return pairs.select(
        *[F.when(flip, F.col(f"{short}x")).otherwise(F.col(c)).alias(f"{short}a") for c, short in SIDES.items()],
        *[F.when(flip, F.col(c)).otherwise(F.col(f"{short}x")).alias(f"{short}b") for c, short in SIDES.items()],
    )


def _classes(rows: DataFrame, nodes: DataFrame, labels: DataFrame | None) -> DataFrame:
    least = nodes.select("node", "key")
    if labels is None:
        rooted = least.withColumn("root", F.col("node"))
    else:
        rooted = least.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    roots = rooted.groupBy("root").agg(F.min("key").alias("least"))
    by_node = rooted.select("node", "root").join(roots, "root")
    return rows.select("key", "h", "node", "n").join(by_node, "node", "left")


def similar_components(
    docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT, rounds: int = ROUNDS
) -> DataFrame:
    """Per row of ``docs``: key, n_shingles and component_id (smallest key reachable by links).

    Null and blank texts have no shingles and are their own component. Repeated rows and equal texts
    are in one component. A null key takes part like any other but is never the smallest, so the
    component of null keys alone is null. An empty table gives no rows. Other columns are not read.
    """
    own = F.when(F.col("node").isNull(), F.col("key")).otherwise(F.col("least"))
    return classes(docs, key, text, percent, rounds).select(
        "key", F.col("n").cast("long").alias("n_shingles"), own.alias("component_id")
    )


def drop_near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT
) -> DataFrame:
    """``docs`` with one row of each component: that with the smallest key, null last.

    Of rows equal in key and text any one stays. Rows without shingles all stay.
    """
    found = stored(classes(docs, key, text, percent), "near-duplicates")
    order = F.struct(F.col("key").isNull().alias("no_key"), "key", "h")
    first = found.where("node IS NOT NULL").groupBy("root").agg(F.min(order).alias("m")).select("m.key", "m.h")
    bare = found.where("node IS NULL").select("key", "h").distinct().withColumn("bare", F.lit(True))
    stay = first.withColumn("bare", F.lit(False)).union(bare).select(F.col("key").alias("of"), F.col("h").alias("of_h"), "bare")
    again = found.where("node IS NOT NULL").groupBy("key", "h").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    packed = docs.select(F.struct(*[named(c) for c in docs.columns]).alias("row"), named(key).cast("long").alias("key"), F.xxhash64(named(text)).alias("h"))
    met = F.col("key").eqNullSafe(F.col("of")) & (F.col("h") == F.col("of_h"))
    if again.isEmpty():
        return packed.join(stay, met, "left_semi").select("row.*")
    kept = packed.join(stay, met).withColumn("nth", F.row_number().over(Window.partitionBy("key", "h").orderBy("bare")))
    return kept.where("bare OR nth = 1").select("row.*")
