"""The trie of all conversations' prefixes, with totals of every subtree.

A node is a distinct sequence of first turns. Its name is a running sum over the turns, each turn
giving a 128-bit digest of its place and content, so names come from prefix sums over chunks of a
conversation and no conversation is gathered in one task.

Totals come from parallel tree contraction over tables. A round takes two exchanges: in the first,
leaves are raked (a leaf's total is final and goes to its parent) and every other node tells its
parent about itself; in the second, nodes with a single child that were picked are compressed away,
their child hanging on their parent with what they carried. Picked are nodes whose depth has round
many trailing zero bits, so that a chain halves in every round, and a random part of those left from
earlier rounds; a node whose child is picked waits, so no two neighbours go at once. When only the
root is left, the rounds are undone in reverse order: a compressed node's total is what it carried
plus its child's total.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tidecast.llm.common import WORD, crc_mod, named, stored
from tidecast.session import scratch_path

CHUNK = 4096  # turns of a conversation in one window
HEADS = 4  # a rebuilt conversation takes fewer than HEADS turns from its family's first,
FAMILY = 20  # and a family is so many neighbouring conversation ids
PARTS = ("p0", "p1", "p2", "p3")  # a name's four 32-bit parts
LOW = 0xFFFFFFFF


def ordered_turns(table: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, place, role, text, part, at): turns of each conversation numbered from 1 within its part.

    A part is a range partition of the whole table in order of conversation and turn, null turns
    first; turns of the same number follow role and text, and equal rows are interchangeable. A long
    conversation has several parts. Rows without a conversation id are left out.
    """
    rows = table.select(
        named(conv).cast("long").alias("conv"),
        named(turn).cast("long").alias("turn"),
        F.coalesce(named(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(named(text).cast("string"), F.lit("")).alias("text"),
    ).where("conv IS NOT NULL")
    keys = ["conv", "turn", "role", "text", "tie"]
    placed = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    place = F.monotonically_increasing_id()
    return stored(placed.select("conv", "role", "text", F.shiftright(place, 33).alias("part"), place.alias("at")), "ordered-turns")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations, turns) after each took its first turns from its family's first conversation.

    conversations: conv, length. turns: conv, depth (from 1), role, text, ends (whether it is the last).
    """
    parts = turns.groupBy("conv", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = stored(parts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "turn-parts")
    sizes = parts.groupBy("conv").agg(F.sum("n").alias("own"))
    family = F.col("conv") - F.col("conv") % FAMILY
    shared = sizes.select(F.col("conv").alias("family"), F.col("own").alias("firsts"))
    wanted = crc_mod(F.col("conv"), HEADS)
    convs = (
        sizes.withColumn("family", family)
        .withColumn("h", wanted)
        .join(shared, "family", "left")
        .select("conv", "family", "h", F.least("h", F.coalesce("firsts", F.lit(0))).alias("taken"), "own")
        .withColumn("length", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    )
    convs = stored(convs, "conversations")
    # Everything a turn must know is looked up by conversation and part, so a long one is many keys.
    known = parts.join(convs.select("conv", "family", "h", "taken", "length"), "conv").drop("n")
    numbered = turns.join(known, ["conv", "part"]).withColumn("place", F.col("before") + F.col("at") - F.col("first") + 1)
    own = numbered.where("place > h").select(
        "conv", (F.col("place") - F.col("h") + F.col("taken")).alias("depth"), "role", "text", "length"
    )
    firsts = numbered.where((F.col("conv") == F.col("family")) & (F.col("place") < HEADS)).select("family", "place", "role", "text")
    heads = convs.join(firsts, "family").where("place <= h").select("conv", F.col("place").alias("depth"), "role", "text", "length")
    every = own.union(heads).select("conv", "depth", "role", "text", (F.col("depth") == F.col("length")).alias("ends"))
    return convs.select("conv", "length"), every


def _name(parts: list[Column]) -> tuple[Column, Column]:
    """The two 64-bit halves of a name from its four parts."""
    a, b, c, d = parts
    return F.shiftleft(a, 32).bitwiseOR(b), F.shiftleft(c, 32).bitwiseOR(d)


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv, depth, hi, lo, phi, plo, words, ends): the node each turn leads to, and that node's parent.

    ``turns`` has conv, depth, role, text and ends. The root is (0, 0).
    """
    content = F.concat_ws(":", "depth", F.length("role"), F.concat("role", "text"))
    digest = F.md5(content.cast("binary"))
    slim = turns.select(
        "conv",
        "depth",
        "ends",
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"),
        *(F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(p) for i, p in enumerate(PARTS)),
        F.expr(f"(depth - 1) div {CHUNK}").alias("chunk"),
    )
    slim = stored(slim, "slim-turns")
    earlier = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = slim.groupBy("conv", "chunk").agg(*(F.sum(p).bitwiseAND(LOW).alias(p) for p in PARTS))
    sums = sums.select("conv", "chunk", *(F.coalesce(F.sum(p).over(earlier), F.lit(0)).alias(f"e{p}") for p in PARTS))
    within = Window.partitionBy("conv", "chunk").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    summed = slim.select("*", *(F.sum(p).over(within).alias(f"r{p}") for p in PARTS)).join(sums, ["conv", "chunk"])
    here = [(F.col(f"e{p}") + F.col(f"r{p}")).bitwiseAND(LOW) for p in PARTS]
    above = [(F.col(f"e{p}") + F.col(f"r{p}") - F.col(p)).bitwiseAND(LOW) for p in PARTS]
    (hi, lo), (phi, plo) = _name(here), _name(above)
    return summed.select("conv", "depth", hi.alias("hi"), lo.alias("lo"), phi.alias("phi"), plo.alias("plo"), "words", "ends")


def _picked(depth: Column, hi: Column, lo: Column, turn: int) -> Column:
    """Whether a node may be compressed in round ``turn``."""
    lower = depth.bitwiseAND((1 << turn) - 1)
    coin = F.xxhash64(hi, lo, F.lit(turn)) % 2 == 0
    return F.when(lower == 0, F.shiftright(depth, turn) % 2 == 1).otherwise(coin)


STATE = ("phi", "plo", "depth", "kids", "leaves", "saved", "up_leaves", "up_saved")


def _most(*names: str) -> list[Column]:
    return [F.max(n).alias(n) for n in names]


def _round(live: DataFrame, turn: int) -> DataFrame:
    """The nodes after raking and compressing; compressed ones are marked ``gone`` and keep what they carried.

    ``leaves`` and ``saved`` are what a node has of its own and from raked children, ``up_*`` what
    compressed nodes between it and its parent carried.
    """
    leaf, null = F.col("kids") == 0, F.lit(None).cast("long")
    child = ("child_hi", "child_lo", "child_leaves", "child_saved", "child_picked")
    stay = live.where(~leaf).select("hi", "lo", *STATE, *(null.alias(c) for c in child))
    told = live.where("phi IS NOT NULL").select(
        F.col("phi").alias("hi"),
        F.col("plo").alias("lo"),
        *(null.alias(c) for c in ("phi", "plo", "depth")),
        F.when(leaf, -1).otherwise(0).cast("long").alias("kids"),
        F.when(leaf, F.col("leaves") + F.col("up_leaves")).otherwise(0).alias("leaves"),
        F.when(leaf, F.col("saved") + F.col("up_saved")).otherwise(0).alias("saved"),
        null.alias("up_leaves"),
        null.alias("up_saved"),
        *(F.when(~leaf, F.col(a)).alias(b) for a, b in zip(("hi", "lo", "up_leaves", "up_saved"), child)),
        F.when(~leaf, _picked(F.col("depth"), F.col("hi"), F.col("lo"), turn).cast("long")).alias("child_picked"),
    )
    raked = stay.unionByName(told).groupBy("hi", "lo").agg(
        *_most("phi", "plo", "depth", "up_leaves", "up_saved", *child), *(F.sum(c).alias(c) for c in ("kids", "leaves", "saved"))
    )
    goes = (
        F.col("phi").isNotNull()
        & (F.col("kids") == 1)
        & _picked(F.col("depth"), F.col("hi"), F.col("lo"), turn)
        & (F.col("child_picked") == 0)
    )
    raked = raked.withColumn("gone", F.coalesce(goes, F.lit(False)))
    moved = ("new_hi", "new_lo", "more_leaves", "more_saved")
    kept = raked.select(
        "hi", "lo", *STATE, "gone",
        *(F.when(F.col("gone"), F.col(c)).alias(c) for c in ("child_hi", "child_lo", "child_leaves", "child_saved")),
        *(null.alias(c) for c in moved),
    )
    down = raked.where("gone").select(
        F.col("child_hi").alias("hi"),
        F.col("child_lo").alias("lo"),
        F.col("phi").alias("new_hi"),
        F.col("plo").alias("new_lo"),
        (F.col("leaves") + F.col("up_leaves")).alias("more_leaves"),
        (F.col("saved") + F.col("up_saved")).alias("more_saved"),
    )
    joined = kept.unionByName(down, allowMissingColumns=True).groupBy("hi", "lo").agg(
        *_most(*STATE, "gone", "child_hi", "child_lo", "child_leaves", "child_saved", *moved)
    )
    return joined.select(
        "hi", "lo",
        F.coalesce("new_hi", "phi").alias("phi"), F.coalesce("new_lo", "plo").alias("plo"), "depth", "kids",
        (F.col("leaves") + F.coalesce("child_leaves", F.lit(0))).alias("leaves"),
        (F.col("saved") + F.coalesce("child_saved", F.lit(0))).alias("saved"),
        (F.col("up_leaves") + F.coalesce("more_leaves", F.lit(0))).alias("up_leaves"),
        (F.col("up_saved") + F.coalesce("more_saved", F.lit(0))).alias("up_saved"),
        "gone", "child_hi", "child_lo",
    )


def subtree_totals(nodes: DataFrame) -> DataFrame:
    """(hi, lo, n_leaves, saved_tokens) of every node of a tree by rake and compress.

    ``nodes``: hi, lo, phi, plo (null at the root), depth, kids, saved. The deepest of any chain is
    halved in every round, so rounds grow with the logarithm of the longest; each is one job that
    writes its nodes to the shared folder, as does every step back.
    """
    spark = nodes.sparkSession
    live = nodes.select(
        "hi", "lo", "phi", "plo", "depth", "kids", F.when(F.col("kids") == 0, 1).otherwise(0).cast("long").alias("leaves"),
        "saved", F.lit(0).cast("long").alias("up_leaves"), F.lit(0).cast("long").alias("up_saved"),
    )
    paths, compressed, first = [], [], live.where("kids = 0").select("hi", "lo", "leaves", "saved")
    done = live.where("kids > 0").isEmpty()
    schema = None
    while not done:
        path, seen = scratch_path(spark, "contracted"), Observation()
        after = _round(live, min(len(paths), 40))
        schema = schema or after.schema
        after.observe(seen, F.max(F.when(~F.col("gone"), F.col("kids"))).alias("kids"), F.count(F.when(F.col("gone"), 1)).alias("gone")).write.parquet(path)
        paths.append(path)
        compressed.append(seen.get["gone"] or 0)
        done = not seen.get["kids"]
        live = spark.read.schema(schema).parquet(path).where(~F.col("gone"))
    totals, back = ("hi", "lo", "leaves", "saved"), []
    for turn in range(len(paths) - 1, -1, -1):
        if compressed[turn]:
            final = spark.read.schema(schema).parquet(*paths[turn:]).where("NOT gone AND kids = 0").select(*totals)
            if back:
                final = final.union(spark.read.schema(final.schema).parquet(*back))
            below = final.select(
                F.col("hi").alias("child_hi"), F.col("lo").alias("child_lo"), F.col("leaves").alias("l"), F.col("saved").alias("s")
            )
            gone = spark.read.schema(schema).parquet(paths[turn]).where("gone").join(below, ["child_hi", "child_lo"])
            back.append(scratch_path(spark, "expanded"))
            gone.select("hi", "lo", (F.col("leaves") + F.col("l")).alias("leaves"), (F.col("saved") + F.col("s")).alias("saved")).write.parquet(back[-1])
    every = first
    if paths:
        every = every.union(spark.read.schema(schema).parquet(*paths).where("NOT gone AND kids = 0").select(*totals))
    if back:
        every = every.union(spark.read.schema(first.schema).parquet(*back))
    return every.select("hi", "lo", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))


def ends_digests(ends: DataFrame) -> DataFrame:
    """(hi, lo, ends_sha256): SHA-256 of each node's ending conversations, ascending and joined by commas.

    ``ends``: hi, lo, conv, no two rows equal. Rows are range-sorted, so a large node's ids become
    text in many tasks; only the hash itself, which can't be divided, runs over a node's pieces one
    after another, in constant memory.
    """
    import hashlib

    def join_ids(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            hi, lo, conv = (batch.column(i).to_numpy() for i in range(3))
            cuts = np.flatnonzero(np.append(True, (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])))
            ids = conv.tolist()
            joined = [",".join(map(str, ids[a:z])) for a, z in zip(cuts.tolist(), [*cuts[1:].tolist(), len(ids)])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(hi[cuts]), pa.array(lo[cuts]), pa.array(conv[cuts]), pa.array(joined)], ["hi", "lo", "conv", "ids"]
            )

    def hash_ids(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def rows(done):
            columns = list(zip(*done))
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["hi", "lo", "ends_sha256"])

        node = state = None
        for batch in batches:
            done = []
            for hi, lo, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
                if node == (hi, lo):
                    state.update(b"," + ids.encode())
                    continue
                if node is not None:
                    done.append((*node, state.hexdigest()))
                node, state = (hi, lo), hashlib.sha256(ids.encode())
            if done:
                yield rows(done)
        if node is not None:
            yield rows([(*node, state.hexdigest())])

    keys = ["hi", "lo", "conv"]
    pieces = ends.select(*keys).repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(join_ids, "hi long, lo long, conv long, ids string")
    return pieces.repartition("hi", "lo").sortWithinPartitions(*keys).mapInArrow(hash_ids, "hi long, lo long, ends_sha256 string")


def prefix_trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """One row per node of the trie of ``turns``, the root included.

    ``convs``: conv, length, one row per conversation; ``turns``: conv, depth from 1 to length, role,
    text, ends. Columns: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens and ends_sha256, as the members that end there. No conversations, no rows.
    """
    path = stored(prefixes(turns), "prefixes")
    ending = path.where("ends").select("hi", "lo", "conv").union(
        convs.where("length = 0").select(F.lit(0).cast("long"), F.lit(0).cast("long"), "conv")
    )
    nodes = path.groupBy("hi", "lo").agg(
        F.max("phi").alias("phi"), F.max("plo").alias("plo"), F.max("depth").alias("depth"), F.min("conv").alias("conv"),
        F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"),
    )
    root = convs.agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select(
        *(F.lit(v).cast("long").alias(c) for c, v in (("hi", 0), ("lo", 0), ("phi", None), ("plo", None), ("depth", 0))),
        "conv", "n_convs", F.lit(0).cast("long").alias("words"),
    )
    nodes = nodes.withColumn("depth", F.col("depth").cast("long")).unionByName(root)
    about = ("phi", "plo", "depth", "conv", "n_convs", "words")
    ups = nodes.where("phi IS NOT NULL").groupBy(F.col("phi").alias("hi"), F.col("plo").alias("lo")).agg(F.count(F.lit(1)).alias("kids"))
    nodes = stored(
        nodes.join(ups, ["hi", "lo"], "left").select(
            "hi", "lo", *about, F.coalesce("kids", F.lit(0)).alias("kids"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved")
        ),
        "trie-nodes",
    )
    parents = nodes.select(F.col("hi").alias("phi"), F.col("lo").alias("plo"), F.col("conv").alias("parent_conv_id"))
    full = nodes.join(subtree_totals(nodes), ["hi", "lo"]).join(ends_digests(ending), ["hi", "lo"], "left").join(parents, ["phi", "plo"], "left")
    nobody = F.sha2(F.lit("").cast("binary"), 256)
    return full.select(
        F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", F.col("kids").alias("n_children"),
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", nobody).alias("ends_sha256"),
    )


def conversation_trie(
    table: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``prefix_trie`` of the rebuilt conversations of a table of turns.

    Null roles and texts are empty, null turns come first, repeated rows are turns of their own, and
    rows without a conversation id are left out. An empty table gives no rows. Other columns,
    whatever their names, are not read.
    """
    return prefix_trie(*rebuilt(ordered_turns(table, conv, turn, role, text)))
