"""Texts scored by a byte context tree, beside a unigram base over whole words.

One pass over the texts cuts them into blocks and counts words and byte contexts. Every context has a node
of the tree, which is spread over tasks: each fits the subtrees of its contexts, the few levels above are
sums over all of them, and each block gets the probabilities of the grams (a byte after its context) that it has. A
second pass scores every text with those of its block. Of
the word counts only those of frequent words go to the tasks (at most FREQUENT, each of which holds
that share of all tokens); the other words of each text meet their counts in a join.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import groupby, repeat

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import Stored, crc_mod, named, pieces, stored
from tidecast.session import scratch_path
from tidecast.sources.store import remove

FREQUENT = 1 << 17
HELD_WORDS = 150_000  # distinct words that a task counts before it hands them on
HELD_GRAMS = 1 << 20  # distinct contexts with their byte that it sums up before
BLOCK_GRAMS = 1 << 21  # distinct grams from which on a task begins another block
RUN = 1 << 20  # bytes of texts worked on together; a longer text is a run of its own
CUT_UP = "block long, key long, held_out boolean, text string, part int, grams binary, counts binary, word string, n long"
FITTED = "part int, grams binary, counts binary, id long, seen double, ones double, deep double"
SCORED = "rid long, key long, held_out boolean, n_tokens long, n_known long, base double, score double, rare array<struct<word:string,n:int>>"


def corpus_counts(texts: DataFrame) -> DataFrame:
    """(gram, word, n) of a one-column table of texts: either a byte context with its byte, or a word.

    A row with neither has the number of texts.
    """

    def count(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        from tidecast.llm import context_tree as ct

        words, held, size, n_texts = Counter(), [], 0, 0
        names = ["gram", "word", "n"]

        def of_words():
            data = pa.array(list(words), pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([pa.nulls(len(words), pa.int64()), data, pa.array(words.values(), pa.int64())], names)

        def of_grams():
            values, counts = (np.concatenate(x) for x in zip(*held))
            values, counts = ct.counted(values, counts)
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.nulls(len(values), pa.string()), pa.array(counts)], names)

        for _, run in pieces(batches, 0, RUN):
            run = [t.lower() for t in run]
            n_texts += len(run)
            for t in run:
                words.update(t.split())
            values, counts = ct.counted(ct.grams(run))
            held.append((values, counts))
            size += len(values)
            if len(words) >= HELD_WORDS:
                yield from of_words()
                words = Counter()
            if size >= HELD_GRAMS:
                yield from of_grams()
                held, size = [], 0
        if words:
            yield from of_words()
        if held:
            yield from of_grams()
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.string()), pa.array([n_texts], pa.int64())], names)

    counts = texts.mapInArrow(count, "gram long, word string, n long").groupBy("gram", "word").agg(F.sum("n").alias("n"))
    return stored(counts, "corpus-counts")


def fit_tree(counts: DataFrame, nodes: int | None = None):
    """The context tree from the byte contexts in ``counts``, on the driver; ``nodes`` bounds those of a depth.

    Without a bound every context has a node, as in ``score_texts``, which never holds the tree in one place.
    """
    import numpy as np

    from tidecast.llm import context_tree as ct

    grams = counts.where("gram IS NOT NULL").select("gram", "n")
    total = grams.agg(F.sum("n")).first()[0] or 0
    least = max(1, -(-total // nodes)) if nodes else 1
    levels = []
    for depth in range(ct.DEPTH + 1):
        context = F.shiftright("gram", 8).bitwiseAND((1 << (8 * depth)) - 1)
        each = grams.groupBy(context.alias("context"), F.col("gram").bitwiseAND(255).alias("byte")).agg(F.sum("n").alias("n"))
        if depth and least > 1:
            often = each.groupBy(F.col("context").alias("of")).agg(F.sum("n").alias("all")).where(F.col("all") >= least)
            each = each.join(often.select("of"), F.col("context") == F.col("of"), "left_semi")
        # with a bound at most so many contexts of 256 bytes each
        rows = each.toArrow()
        levels.append(tuple(rows.column(c).to_numpy().astype(np.int64) for c in ("context", "byte", "n")))
    return ct.build(levels)


def _batch(schema: str, **columns):
    """An Arrow batch of ``schema`` with the given columns, the others null."""
    import pyarrow as pa

    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary()}
    names = [x.split(" ") for x in schema.split(", ")]
    size = len(next(iter(columns.values())))
    arrays = [pa.array(columns[c], kinds[kind]) if c in columns else pa.nulls(size, kinds[kind]) for c, kind in names]
    return pa.RecordBatch.from_arrays(arrays, [c for c, _ in names])


def cut_up(texts: DataFrame, parts: int) -> DataFrame:
    """Blocks of a table of (id, text), id being (key, held_out): rows with a text, with grams or with a word.

    A text is lower-cased in A-Z, null is empty, and has the number of its block. The grams of a block are a row for each of the ``parts``
    of the tree, with their counts in texts that are learnt from. Words of these come with their number; the number
    of such texts is a row without a word.
    """

    def cut(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        from tidecast.llm import byte_tree as bt
        from tidecast.llm.context_tree import counted

        words, held, size, n_texts = Counter(), [], 0, 0
        block = TaskContext.get().partitionId() << 32

        def of_words():
            return _batch(CUT_UP, word=pa.array(list(words), pa.binary()).cast(pa.string()), n=list(words.values()))

        def of_grams():
            grams, counts = held[0] if len(held) == 1 else counted(*(np.concatenate(x) for x in zip(*held)))
            part = bt.part_of(grams, parts)
            order = np.argsort(part, kind="stable")
            edges = np.flatnonzero(np.r_[True, np.diff(part[order]) > 0, True])
            runs = [order[a:b] for a, b in zip(edges, edges[1:])]
            columns = {"grams": [bt.packed_grams(grams[r]) for r in runs], "counts": [bt.packed(counts[r]) for r in runs]}
            yield _batch(CUT_UP, block=[block] * len(runs), part=part[order[edges[:-1]]].tolist(), **columns)

        for ids, run in pieces(batches, 1, RUN):
            run, learnt = [t.lower() for t in run], [not k["held_out"] for k in ids]
            yield _batch(
                CUT_UP, block=[block] * len(run), key=[k["key"] for k in ids], held_out=[k["held_out"] for k in ids],
                text=pa.array(run, pa.binary()).cast(pa.string()),
            )
            for t, its in zip(run, learnt):
                if its:
                    n_texts += 1
                    words.update(t.split())
            held.append(bt.tallied(run, learnt))
            size += len(held[-1][0])
            if len(words) >= HELD_WORDS:
                yield of_words()
                words = Counter()
            if size >= HELD_GRAMS:
                held = [counted(*(np.concatenate(x) for x in zip(*held)))]
                if len(held[0][0]) >= BLOCK_GRAMS:
                    yield from of_grams()
                    held, block = [], block + 1
                size = 0
        if words:
            yield of_words()
        if held:
            yield from of_grams()
        yield _batch(CUT_UP, n=[n_texts])

    return texts.mapInArrow(cut, CUT_UP)


def _by_part(rows: DataFrame, parts: int, *order: str) -> DataFrame:
    return rows.repartition(parts, "part").sortWithinPartitions("part", *order)


def _rows(batches: Iterator) -> Iterator:
    """The rows of Arrow batches, one at a time, as tuples."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield tuple(c[i].as_py() for c in batch.columns)


def fit_parts(blocks: DataFrame, parts: int) -> Stored:
    """The tree from (part, grams, counts) of all blocks: a row with all grams of each part, and what it adds to the levels above."""

    def fit(batches: Iterator) -> Iterator:
        import numpy as np

        from tidecast.llm import byte_tree as bt
        from tidecast.llm.context_tree import counted

        for part, rows in groupby(_rows(batches), lambda r: r[0]):
            held, size = [], 0
            for _, grams, counts in rows:
                held.append((bt.unpacked_grams(grams), bt.unpacked(counts)))
                size += len(held[-1][0])
                if size >= HELD_GRAMS:
                    held, size = [counted(*(np.concatenate(x) for x in zip(*held)))], 0
            grams, counts = counted(*(np.concatenate(x) for x in zip(*held)))
            yield _batch(FITTED, part=[part], grams=[bt.packed_grams(grams)], counts=[bt.packed(counts)])
            ids, seen, ones, deep = bt.summary(grams, counts)
            yield _batch(FITTED, id=ids, seen=seen, ones=ones, deep=deep)

    return Stored(_by_part(blocks, parts).mapInArrow(fit, FITTED), "lm-tree")


def top_of(fitted: DataFrame):
    """The levels above all parts, on the driver: at most 255 decisions for each context of two bytes."""
    from tidecast.llm import byte_tree as bt

    sums = fitted.where("id IS NOT NULL").groupBy("id").agg(*[F.sum(c).alias(c) for c in ("seen", "ones", "deep")]).toArrow()
    return bt.top(*(sums.column(c).to_numpy() for c in ("id", "seen", "ones", "deep")))


def answered(blocks: DataFrame, fitted: DataFrame, above, parts: int) -> DataFrame:
    """(block, grams, logs): log10 of the probability of each gram of the blocks; ``above`` is a broadcast of ``top_of``."""

    def answer(batches: Iterator) -> Iterator:
        import numpy as np

        from tidecast.llm import byte_tree as bt

        for _, _, block, packed, counts in _rows(batches):
            grams = bt.unpacked_grams(packed)
            if block is None:  # the part's row of the tree comes before those of the blocks
                known = grams
                logs = bt.log10_of(grams, bt.unpacked(counts), above.value)
            else:
                each = logs[np.searchsorted(known, grams)]
                yield _batch("block long, grams binary, logs binary", block=[block], grams=[packed], logs=[each.tobytes()])

    tree = fitted.where("part IS NOT NULL").select("part", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("block"), "grams", "counts")
    asked = blocks.select("part", F.lit(1).alias("kind"), "block", "grams", F.lit(None).cast("binary").alias("counts"))
    return _by_part(tree.union(asked), parts, "kind").mapInArrow(answer, "block long, grams binary, logs binary")


def _of_block(folder: str, block: int):
    """(sorted grams, log10) of a block, from the folder that ``answered`` was written to by block."""
    import numpy as np
    import pyarrow.parquet as pq

    from tidecast.llm import byte_tree as bt
    from tidecast.llm.shared import open_fs

    fs, root = open_fs(folder)
    rows = pq.read_table(f"{root}/block={block}", columns=["grams", "logs"], filesystem=fs, partitioning=None)
    grams = np.concatenate([bt.unpacked_grams(x.as_py()) for x in rows.column("grams")])
    logs = np.concatenate([np.frombuffer(x.as_py(), np.float32) for x in rows.column("logs")])
    order = np.argsort(grams)
    return grams[order], logs[order]


def _log10(texts: list[bytes], known, logs):
    """log10 probability of each whole text, its end included."""
    import numpy as np

    from tidecast.llm import byte_tree as bt

    grams, starts = bt.grams_of(texts)
    order = np.argsort(grams)
    grams = grams[order]
    first = np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]])
    each = np.empty(len(grams), np.float32)
    each[order] = np.repeat(logs[np.searchsorted(known, grams[first])], np.diff(np.r_[first, len(grams)]))
    return np.add.reduceat(each, starts, dtype=np.float64)


def frequent_words(counts: DataFrame, total: int) -> dict[bytes, int]:
    """Words with at least one in FREQUENT of all tokens, so there are at most so many."""
    rows = counts.where("word IS NOT NULL").where(F.col("n") * FREQUENT >= total).select("word", "n").toArrow()
    return dict(zip((w.encode() for w in rows.column("word").to_pylist()), rows.column("n").to_pylist()))


def _runs(batches: Iterator) -> Iterator:
    """(ids, texts) of about RUN bytes, of one block each."""
    for ids, run in pieces(batches, 1, RUN):
        at = 0
        for _, same in groupby(ids, lambda k: k["block"]):
            n = sum(1 for _ in same)
            yield ids[at : at + n], run[at : at + n]
            at += n


def score_texts(
    docs: DataFrame, key: str = "doc_id", text: str = "text", folds: int = 5, held_fold: int = 1
) -> DataFrame:
    """Per row: key, held_out, n_tokens, n_known, train_tokens, base_score and score (log10).

    Rows whose crc32(key) mod ``folds`` is ``held_fold`` are not learnt from; a null key counts as
    empty text there. Texts are lower-cased in A-Z; null is empty, and an empty text has its end
    only. Every row is scored by itself, repeated rows too. Without training rows every word is
    unknown and every byte equally likely. An empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    held = crc_mod(named(key), folds) == held_fold
    parts = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    slim = docs.select(F.struct(named(key).cast("long").alias("key"), held.alias("held_out")).alias("id"), named(text).alias("text"))
    cut = Stored(cut_up(slim, parts), "lm-blocks")
    words = stored(cut.rows.where("n IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n")), "corpus-counts")
    tokens, distinct = words.agg(F.sum("n"), F.count(F.lit(1))).first()
    tokens, ends = tokens or 0, words.where("word IS NULL").agg(F.sum("n")).first()[0] or 0
    distinct = distinct if ends else distinct - words.where("word IS NULL").count()  # the end is a token, if there was one
    blocks = cut.rows.where("part IS NOT NULL").select("part", "block", "grams", "counts")
    fitted = fit_parts(blocks.drop("block"), parts)
    above = spark.sparkContext.broadcast(top_of(fitted.rows))
    folder = scratch_path(spark, "lm-answers")
    answered(blocks, fitted.rows, above, parts).repartition("block").write.partitionBy("block").parquet(folder)
    shared = spark.sparkContext.broadcast(frequent_words(words, tokens))  # of bounded size

    def score(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        often, block, chances = shared.value, None, None
        number = {w: i for i, w in enumerate(often)}
        logs = np.log10(np.array([*often.values(), 0], float) + 0.5)
        logs[-1] = 0.0
        rid = TaskContext.get().partitionId() << 40
        end = float(np.log10(ends + 0.5))
        names = [x.split(" ")[0] for x in SCORED.split(", ")[:7]] + ["rare"]
        for keys, run in _runs(batches):
            if keys[0]["block"] != block:
                block = keys[0]["block"]
                chances = _of_block(folder, block)
            parts = [t.split() for t in run]
            sizes = np.array([len(p) for p in parts])
            ids = np.fromiter((i for p in parts for i in map(number.get, p, repeat(-1))), np.int64, int(sizes.sum()))
            edges = np.r_[0, np.cumsum(sizes)]
            sums, known = np.r_[0, np.cumsum(logs[ids])], np.r_[0, np.cumsum(ids >= 0)]
            base = np.add.reduceat(np.r_[logs[ids], 0.0], edges[:-1]) if len(sizes) else sums[:0]
            base = np.where(sizes > 0, base, 0.0) + end
            n_known = known[edges[1:]] - known[edges[:-1]] + (ends > 0)
            rare_words, rare_n, rare_ends = [], [], [0]
            unknown = np.flatnonzero(ids < 0)
            cuts = np.searchsorted(unknown, edges)
            for d, p in enumerate(parts):
                own = Counter([p[i] for i in (unknown[cuts[d] : cuts[d + 1]] - edges[d]).tolist()])
                rare_words += own
                rare_n += own.values()
                rare_ends.append(len(rare_words))
            rare = pa.ListArray.from_arrays(
                pa.array(rare_ends, pa.int32()),
                pa.StructArray.from_arrays([pa.array(rare_words, pa.binary()).cast(pa.string()), pa.array(rare_n, pa.int32())], ["word", "n"]),
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(len(run)) + rid), pa.array([k["key"] for k in keys], pa.int64()),
                    pa.array([k["held_out"] for k in keys], pa.bool_()), pa.array(sizes + 1), pa.array(n_known),
                    pa.array(base), pa.array(_log10(run, *chances)), rare,
                ],
                names,
            )
            rid += len(run)

    texts = cut.rows.where("text IS NOT NULL").select(F.struct("key", "held_out", "block").alias("id"), "text")
    # Written once, so that the numbers of the rows (rid) hold from here on.
    scored = stored(texts.mapInArrow(score, SCORED), "lm-scores")
    cut.drop()
    fitted.drop()
    remove(spark, folder)
    rare = scored.select("rid", F.explode("rare").alias("r")).select("rid", "r.word", F.col("r.n").alias("times"))
    met = rare.join(words.where("word IS NOT NULL").select("word", F.col("n").alias("c")), "word", "left")
    c = F.coalesce("c", F.lit(0))
    sums = met.groupBy("rid").agg(
        F.sum(F.col("times") * F.log10(c + 0.5)).alias("rare_base"), F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("rare_known")
    )
    scale = F.log10(F.lit(tokens + 0.5 * (distinct + 1)))
    return scored.drop("rare").join(sums, "rid", "left").select(
        F.col("key").alias(key), "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0)) - F.col("n_tokens") * scale).alias("base_score"),
        "score",
    )
