"""Ranked lexical search of a query set over all documents: accumulators first, then skipping.

Documents are cut into terms once, and a table in the shared folder keeps what the queries can touch
of each: its length, and the queries' terms in it with their counts. Spark sums N, L and every df
from that table. Each task then takes its documents in blocks, turns a block into posting lists, and
answers every query on it:

* term at a time: the scores of all short lists are summed into accumulators, sorted by document;
* document at a time: the accumulators act as one more posting list, whose bound is their largest
  sum. Together with the long lists it is walked in ranges of documents. A range whose bounds don't
  reach the k-th score so far is skipped; within a range, lists that cannot lift a document to that
  score by themselves only answer look-ups for documents met elsewhere, and a document is dropped as
  soon as what is left cannot lift it.

A task gives at most k rows per query; the best k of all come from two rounds of row numbers, the
first over salted parts of a query's rows. All scores are exact 64-bit integers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidecast.llm.common import named, pieces, stored
from tidecast.session import scratch_path

TOP = 10
SET_TERMS = 200_000  # terms, with repeats, of the queries that one pass over the documents answers
BLOCK_DOCS = 1 << 16  # documents of a task that are searched together, and
BLOCK_POSTINGS = 4_000_000  # their postings
RANGE = 2048  # documents between two looks at the bounds
SHORT = 32  # a list with at most one posting per so many documents is short
SALTS = 256
NO_KEY = -(2**63)  # stands for a null key, which sorts before all others
INDEX = "key long, n long, terms array<int>, counts array<int>"

_LETTERS = bytes(range(65, 91))
# Bytes of terms: digits, letters (lowered) and everything beyond ASCII; all else separates.
_TO_TERMS = bytes(
    b + 32 if b in _LETTERS else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text: runs of ASCII letters, digits and non-ASCII characters, A-Z lowered."""
    return text.translate(_TO_TERMS).split()


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def impacts(tf, n, docs: int, total: int):
    """(1e9 tf) div (1000 tf + 8 m) of int64 arrays, m = 25 + (75 n N) div L."""
    m = 25 + (75 * n * docs) // total
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Best:
    """The k best (score, key) seen, higher scores first, then smaller keys; null keys come first."""

    def __init__(self, k: int):
        import numpy as np

        self.k, self.floor = k, 1
        self.scores = self.keys = np.zeros(0, np.int64)

    def offer(self, scores, keys) -> None:
        import numpy as np

        scores, keys = np.concatenate([self.scores, scores]), np.concatenate([self.keys, keys])
        order = np.lexsort((keys, -scores))[: self.k]
        self.scores, self.keys = scores[order], keys[order]
        if len(order) == self.k:
            self.floor = max(self.floor, int(self.scores[-1]))


class Block:
    """Posting lists of some documents, numbered in ascending order of key."""

    def __init__(self, keys, lengths, sizes, terms, counts, docs: int, total: int):
        import numpy as np

        order = np.argsort(keys, kind="stable")
        self.keys, self.size = keys[order], len(keys)
        place = np.empty(self.size, np.int64)
        place[order] = np.arange(self.size)
        doc = np.repeat(place, sizes)
        worth = impacts(counts.astype(np.int64), np.repeat(lengths, sizes), docs, total)
        by_term = np.argsort(terms.astype(np.int64) * self.size + doc)
        self.doc, self.worth, sorted_terms = doc[by_term], worth[by_term], terms[by_term]
        self.names, self.begins = np.unique(sorted_terms, return_index=True)
        self.ends = np.append(self.begins[1:], len(sorted_terms))
        self.edges = np.append(np.arange(0, self.size, RANGE), self.size)
        self.bounds: dict[int, tuple] = {}

    def find(self, term: int) -> int:
        """The number of the term's list, or -1."""
        import numpy as np

        at = int(np.searchsorted(self.names, term))
        return at if at < len(self.names) and self.names[at] == term else -1

    def ranges(self, number: int):
        """(first posting of each range and the end, largest impact in each range) of a list; kept for later queries."""
        import numpy as np

        if number not in self.bounds:
            a, z = self.begins[number], self.ends[number]
            self.bounds[number] = _by_range(np.searchsorted(self.doc[a:z], self.edges), self.worth[a:z], a)
        return self.bounds[number]

    def search(self, query: list[tuple[int, int]], best: Best) -> None:
        """Offer ``best`` all documents of the block that can be among the k best; query: (term, weight times repeats)."""
        import numpy as np

        found = [(number, w) for term, w in query if w > 0 and (number := self.find(term)) >= 0]
        lists = [(int(self.ends[i] - self.begins[i]), i, w) for i, w in found]
        short = [(i, w) for n, i, w in lists if n * SHORT <= self.size]
        long = [(i, w) for n, i, w in lists if n * SHORT > self.size]

        # Term at a time.
        if short:
            docs = np.concatenate([self.doc[self.begins[i] : self.ends[i]] for i, _ in short])
            gains = np.concatenate([self.worth[self.begins[i] : self.ends[i]] * w for i, w in short])
            order = np.argsort(docs, kind="stable")
            docs, gains = docs[order], gains[order]
            held = np.flatnonzero(np.append(True, docs[1:] != docs[:-1]))
            docs, gains = docs[held], np.add.reduceat(gains, held)
        else:
            docs = gains = np.zeros(0, np.int64)
        if not long:
            good = gains >= best.floor
            best.offer(gains[good], self.keys[docs[good]])
            return
        floor = best.floor  # sums only grow, so the k-th accumulator bounds the k-th score from below
        if len(gains) >= best.k:
            floor = max(floor, int(np.partition(gains, -best.k)[-best.k]))

        # Document at a time: the accumulators and the long lists, range by range.
        at, most = _by_range(np.searchsorted(docs, self.edges), gains, 0)
        tops = np.stack([self.ranges(i)[1] * w for i, w in long])
        for r in np.flatnonzero(tops.sum(axis=0) + most >= floor):
            floor = max(floor, best.floor)
            top = tops[:, r]
            if top.sum() + most[r] < floor:
                continue
            base, width = int(self.edges[r]), int(self.edges[r + 1] - self.edges[r])
            rising = np.argsort(top, kind="stable")
            leading = int(np.searchsorted(np.cumsum(top[rising]), floor))  # lists before it never suffice alone
            score = np.zeros(width, np.int64)
            a, z = at[r], at[r + 1]
            score[docs[a:z] - base] = gains[a:z]
            for j in rising[leading:]:
                i, w = long[j]
                a, z = self.ranges(i)[0][r : r + 2]
                score[self.doc[a:z] - base] += self.worth[a:z] * w
            rest = int(top[rising[:leading]].sum())
            met = np.flatnonzero(score)
            met = met[score[met] + rest >= floor]
            for j in rising[:leading][::-1]:
                if not len(met):
                    break
                i, w = long[j]
                a, z = self.ranges(i)[0][r : r + 2]
                if z > a:
                    held = self.doc[a:z] - base
                    spot = np.minimum(np.searchsorted(held, met), z - a - 1)
                    hit = held[spot] == met
                    score[met[hit]] += self.worth[a + spot[hit]] * w
                rest -= int(top[j])
                met = met[score[met] + rest >= floor]
            if len(met):
                best.offer(score[met], self.keys[met + base])


def _by_range(cuts, values, offset: int):
    """(cuts moved by offset, the largest value between neighbouring cuts, 0 where there is none)."""
    import numpy as np

    most = np.zeros(len(cuts) - 1, np.int64)
    full = np.flatnonzero(cuts[1:] > cuts[:-1])
    if len(full):
        most[full] = np.maximum.reduceat(values, cuts[full])
    return cuts + offset, most


def _sets(items: DataFrame, item: str, text: str) -> Iterator[list[tuple]]:
    """Lists of (item, {term: repeats}) of at most SET_TERMS terms, or of one longer item."""
    held, size = [], 0
    rows = items.select(named(item).cast("long"), F.coalesce(named(text).cast("string"), F.lit("")).cast("binary"))
    for key, body in rows.toLocalIterator():
        found = terms_of(bytes(body))
        if held and size + len(found) > SET_TERMS:
            yield held
            held, size = [], 0
        repeats: dict[bytes, int] = {}
        for t in found:
            repeats[t] = repeats.get(t, 0) + 1
        if found:
            held.append((key, repeats))
            size += len(found)
    if held:
        yield held


def _postings(docs: DataFrame, number: dict[bytes, int], key: str, text: str) -> DataFrame:
    """INDEX rows of all documents; terms ascending, documents without any of them included."""

    def index(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for keys, values in pieces(batches):
            lengths, sizes, terms, counts = [], [0], [], []
            for body in values:
                found = terms_of(body)
                lengths.append(len(found))
                t, c = np.unique(np.array([x for x in map(number.get, found) if x is not None], np.int32), return_counts=True)
                terms.append(t)
                counts.append(c.astype(np.int32))
                sizes.append(len(t))
            cuts = pa.array(np.cumsum(sizes), pa.int32())
            lists = [pa.ListArray.from_arrays(cuts, pa.array(np.concatenate(x))) for x in (terms, counts)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(lengths, pa.int64()), *lists], ["key", "n", "terms", "counts"]
            )

    rows = docs.select(named(key).cast("long").alias("key"), named(text).cast("string").alias("text"))
    return rows.mapInArrow(index, INDEX)


def _answers(index: DataFrame, queries: list[tuple], docs: int, total: int, k: int) -> DataFrame:
    """(query, item_id, key, score): each task's k best documents of every query; queries: (item, [(term, weight)])."""

    def search(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        best = [Best(k) for _ in queries]
        held, n_docs, n_postings = [], 0, 0

        def flush() -> None:
            columns = [np.concatenate([h[j] for h in held]) for j in range(5)]
            block = Block(*columns, docs, total)
            for (_, query), found in zip(queries, best):
                block.search(query, found)
            held.clear()

        for batch in batches:
            keys = batch.column(0).fill_null(NO_KEY).to_numpy()
            lists = batch.column(2)
            held.append(
                (keys, batch.column(1).to_numpy(), np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy(), batch.column(3).flatten().to_numpy())
            )
            n_docs, n_postings = n_docs + len(keys), n_postings + len(held[-1][3])
            if n_docs >= BLOCK_DOCS or n_postings >= BLOCK_POSTINGS:
                flush()
                n_docs = n_postings = 0
        if held:
            flush()
        sizes = [len(b.keys) for b in best]
        if sum(sizes):
            keys = np.concatenate([b.keys for b in best])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.arange(len(best)), sizes), pa.int64()),
                    pa.array([item for (item, _), n in zip(queries, sizes) for _ in range(n)], pa.int64()),
                    pa.array(keys, pa.int64(), mask=keys == NO_KEY),
                    pa.array(np.concatenate([b.scores for b in best]), pa.int64()),
                ],
                ["query", "item_id", "key", "score"],
            )

    # Only tasks' documents with a term of some query matter from here on.
    return index.where(F.size("terms") > 0).mapInArrow(search, "query long, item_id long, key long, score long")


def search(
    docs: DataFrame, items: DataFrame, k: int = TOP, key: str = "doc_id", text: str = "text", item: str = "item_id"
) -> DataFrame:
    """(item_id, rank, key, score): the k best documents of each row of ``items`` with a score above 0.

    Equal scores follow the keys in ascending order, null first; repeated document rows each take a
    rank. Null, empty and term-less texts are never found, and such items find nothing. Every row of
    ``items`` is a query of its own, so a repeated item has its ranking as often. Either table may be
    empty; other columns, whatever their names, are not read. Keys and item ids are cast to long.

    Queries are answered in sets of SET_TERMS terms, which is what the driver and a worker hold of
    them; more queries mean more passes over the documents, whose answers are written one after
    another.
    """
    spark = docs.sparkSession
    out = scratch_path(spark, "ranked")
    schema = "item_id long, rank int, key long, score long"
    spark.createDataFrame([], schema).write.parquet(out)
    for queries in _sets(items, item, text):
        number = {t: i for i, t in enumerate(sorted({t for _, repeats in queries for t in repeats}))}
        index = stored(_postings(docs, number, key, text), "postings")
        found = index.agg(F.count(F.when(F.col("n") > 0, 1)), F.sum("n")).first()
        n, total = found[0], found[1] or 0
        if n == 0:
            break
        df = dict(index.select(F.explode("terms").alias("t")).groupBy("t").count().collect())
        weighted = [
            (i, [(number[t], r * weight(n, df[number[t]])) for t, r in repeats.items() if number[t] in df])
            for i, repeats in queries
        ]
        parts = _answers(index, weighted, n, total, k)
        salted = Window.partitionBy("query", "salt").orderBy(F.desc("score"), "key")
        whole = Window.partitionBy("query").orderBy(F.desc("score"), "key")
        (
            parts.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)))
            .withColumn("rank", F.row_number().over(salted))
            .where(F.col("rank") <= k)
            .withColumn("rank", F.row_number().over(whole))
            .where(F.col("rank") <= k)
            .select("item_id", "rank", "key", "score")
            .write.mode("append")
            .parquet(out)
        )
    return spark.read.schema(schema).parquet(out).withColumnRenamed("key", key)
