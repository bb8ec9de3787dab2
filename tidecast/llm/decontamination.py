"""Documents that hold benchmark items, found by SimHash and verified exactly.

Each item gives 64-bit SimHash fingerprints of all its windows of one size, about three fifths of
the item, and the documents give those of windows of that size on a grid of a quarter of it. However an item lies on the
grid, one of the document's windows then covers the same words as one of the item's. A multi-index
finds every fingerprint within the radius: 64 bits in three blocks, and two fingerprints that differ
in at most eight bits differ in at most two in some block. Fingerprints of an item with a long
insertion or scattered edits lie farther off, so the shingles themselves are looked up too: places
with as many of an item's shingles as the threshold takes are candidates, however they lie.
Candidates are verified by the weighted similarity of five-word shingles, each with its number of
occurrences as weight; the best window counts.

Items go to the tasks in blocks of bounded size, each block against all documents.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import held, named, pieces
from tidecast.session import bounded_batches

WORDS = 5
PERCENT = 75
RADIUS = 8
BLOCKS = ((43, 21), (22, 21), (0, 22))  # shift and bits
PARTS = 4  # grid steps in a window
GRAM_BITS = 22  # of a shingle's hash, looked up first
ITEM_BLOCK = (2_000, 2 << 20)  # items, bytes
FOUND = "doc_id long, item_id long, similarity double, first_word long, n_words long"


def step_of(n_words: int) -> int:
    """The grid step for items of so many words.

    Whatever keeps three quarters of the shingles has at least 0.75 n + 1 words in a row or two
    nearly whole parts; PARTS + 1 steps less one word fit in that.
    """
    return max(1, min(63, (3 * n_words + 8) // 20))


def fingerprints(bits, step: int):
    """SimHash of each window of PARTS steps: rows of ``bits`` are words, their 64 columns bits."""
    import numpy as np

    n = len(bits) // step
    if n < PARTS:
        return np.zeros(0, np.uint64)
    rows = bits[: n * step].reshape(n, step * 64)
    sums = rows[:, :64].copy()
    for k in range(1, step):
        sums += rows[:, 64 * k : 64 * k + 64]
    windows = sums[: n - PARTS + 1].copy()
    for k in range(1, PARTS):
        windows += sums[k : n - PARTS + 1 + k]
    return np.packbits(windows > PARTS * step // 2, axis=1).view(">u8").astype(np.uint64).reshape(-1)


class Index:
    """The items of a block and the multi-index of their fingerprints."""

    def __init__(self, items: tuple[tuple[int, bytes], ...]):
        import numpy as np
        import xxhash

        class Hashes(dict):
            def __missing__(self, word):
                value = self[word] = xxhash.xxh3_64_intdigest(word, seed=1)
                return value

        self.np, self.hashes = np, Hashes()
        self.items, by_step = [], {}
        for item_id, text in items:
            words = self.words(text)
            if len(words) < WORDS:
                continue
            at, step = len(self.items), step_of(len(words))
            self.items.append((item_id, len(words), self.shingles(words)))
            bits = self.bits(words)
            for offset in range(len(words) - PARTS * step + 1):
                by_step.setdefault(step, []).append((fingerprints(bits[offset:], step)[0], at, offset))
        held = [(at, g) for at, (_, _, wanted) in enumerate(self.items) for g in wanted]
        grams = self.gram_hashes(np.frombuffer(b"".join(g for _, g in held), np.uint64).reshape(-1, WORDS).T)
        order = np.argsort(grams, kind="stable")
        self.grams, self.gram_items = grams[order], np.array([at for at, _ in held], np.int64)[order]
        self.gram_marks = np.zeros(1 << GRAM_BITS, bool)
        self.gram_marks[self.grams >> np.uint64(64 - GRAM_BITS)] = True
        self.tables = {step: self._table(rows) for step, rows in by_step.items()}

    def words(self, text: bytes):
        """Word hashes of a text, A-Z lower-cased."""
        found = text.lower().split()
        return self.np.fromiter(map(self.hashes.__getitem__, found), self.np.uint64, len(found))

    def bits(self, words):
        np = self.np
        return np.unpackbits(words.view(np.uint8)).reshape(-1, 64)

    def shingles(self, words) -> Counter:
        data = words.tobytes()
        return Counter(data[8 * i : 8 * i + 8 * WORDS] for i in range(len(words) - WORDS + 1))

    def gram_hashes(self, columns):
        """One hash per shingle, from the hashes of its first words, its second words and so on."""
        np = self.np
        out = np.zeros(len(columns[0]), np.uint64)
        for words in columns:
            out = (out ^ words) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        return out * np.uint64(0xBF58476D1CE4E5B9)

    def shared(self, flat, starts, percent: int):
        """(text, item, first, end): where shingles of an item lie as densely as in a similar window.

        A window with S of the item's N shingles and W of its own is similar if S is at least
        ``percent`` of W + N - S, so S is at least ``percent`` of N, and W at most N / ``percent``.
        """
        np = self.np
        if len(flat) < WORDS or not len(self.grams):
            return
        hashes = self.gram_hashes([flat[i : len(flat) - WORDS + 1 + i] for i in range(WORDS)])
        hit = np.flatnonzero(self.gram_marks[hashes >> np.uint64(64 - GRAM_BITS)])
        low, high = np.searchsorted(self.grams, hashes[hit]), np.searchsorted(self.grams, hashes[hit], "right")
        size = high - low
        at, item = np.repeat(hit, size), self.gram_items[np.repeat(low - np.cumsum(size) + size, size) + np.arange(size.sum())]
        doc = np.searchsorted(starts, at, "right") - 1
        inside = at + WORDS <= starts[doc + 1]  # not from one text into the next
        at, item, doc = at[inside], item[inside], doc[inside]
        order = np.lexsort((at, item, doc))
        at, item, doc = at[order], item[order], doc[order]
        edges = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]), True]) if len(at) else []
        for a, b in zip(edges[:-1], edges[1:]):
            total = self.items[item[a]][1] - WORDS + 1
            least, widest = -(-percent * total // 100), 100 * total // percent
            if b - a < least:
                continue
            place = at[a:b] - starts[doc[a]]
            begin = place[: len(place) - least + 1]
            begin = begin[place[least - 1 :] - begin < widest]
            cuts = np.flatnonzero(np.diff(begin) >= widest) + 1
            for run in np.split(begin, cuts):
                if len(run):
                    yield int(doc[a]), int(item[a]), int(run[0]), int(run[-1]) + widest + WORDS - 1

    def _table(self, rows):
        np = self.np
        prints = np.array([r[0] for r in rows], np.uint64)
        blocks = []
        for shift, width in BLOCKS:
            near = RADIUS // len(BLOCKS)
            masks = [sum(1 << b for b in c) for k in range(near + 1) for c in combinations(range(width), k)]
            own = (prints >> np.uint64(shift)).astype(np.int64) & ((1 << width) - 1)
            keys = (own[:, None] ^ np.array(masks, np.int64)[None, :]).reshape(-1)
            who = np.repeat(np.arange(len(rows)), len(masks))
            order = np.argsort(keys, kind="stable")
            marks = np.zeros(1 << width, bool)
            marks[keys] = True
            blocks.append((shift, width, marks, keys[order], who[order]))
        return prints, np.array([r[1] for r in rows]), np.array([r[2] for r in rows]), blocks

    def near(self, prints, table):
        """(window, fingerprint) numbers of all pairs within the radius; a pair may come again."""
        np = self.np
        own, _, _, blocks = table
        for shift, width, marks, keys, who in blocks:
            values = ((prints >> np.uint64(shift)) & np.uint64((1 << width) - 1)).astype(np.int64)
            hit = np.flatnonzero(marks[values])
            low, high = np.searchsorted(keys, values[hit]), np.searchsorted(keys, values[hit], "right")
            window = np.repeat(hit, high - low)
            place = np.arange(len(window)) - np.repeat(np.cumsum(high - low) - (high - low), high - low)
            fingerprint = who[np.repeat(low, high - low) + place]
            close = np.bitwise_count(prints[window] ^ own[fingerprint]) <= RADIUS
            yield window[close], fingerprint[close]

    def scan(self, texts: list[bytes], percent: int) -> list[dict]:
        """Per text {item: (similarity, first word, words)} with each item's best place."""
        np = self.np
        if len(self.hashes) > 1 << 17:
            self.hashes.clear()
        words = [self.words(t) for t in texts]
        starts = np.cumsum([0, *map(len, words)])
        flat = np.concatenate(words) if words else np.zeros(0, np.uint64)
        bits, places = self.bits(flat), set()
        for step, table in self.tables.items():
            prints = fingerprints(bits, step)
            for window, fingerprint in self.near(prints, table):
                first = window * step
                doc = np.searchsorted(starts, first, "right") - 1
                begin = first - table[2][fingerprint] - starts[doc]
                places.update(zip(doc.tolist(), table[1][fingerprint].tolist(), begin.tolist()))
        out: list[dict] = [{} for _ in texts]
        spans = set(self.shared(flat, starts, percent))
        for doc, item, begin in places:
            _, n, _ = self.items[item]
            # A similar window around the place of a fingerprint ends within three quarters of the item.
            reach = 100 * n // percent - PARTS * step_of(n)
            spans.add((doc, item, max(0, begin - reach), begin + n + reach))
        for doc, item, low, high in spans:
            item_id, *_ = self.items[item]
            found = self.verify(words[doc], item, low, high, percent)
            if found and found > out[doc].get(item_id, (0,)):
                out[doc][item_id] = found
        return out

    def verify(self, words, item: int, low: int, high: int, percent: int):
        """The most similar window from word ``low`` to ``high``, or None: (similarity, -first word, words)."""
        np = self.np
        _, n, wanted = self.items[item]
        total = n - WORDS + 1
        data = words[low:high].tobytes()
        grams = [data[8 * i : 8 * i + 8 * WORDS] for i in range(len(data) // 8 - WORDS + 1)]
        # The best window begins and ends with a shingle of the item.
        held = [i for i, g in enumerate(grams) if g in wanted]
        most = sum(min(c, wanted[g]) for g, c in Counter(grams[i] for i in held).items())
        if 100 * most < percent * total:
            return None
        at, shared, best = np.array(held), np.zeros(len(held), np.int64), None
        widest, seen = 100 * total // percent, {}
        for k, i in enumerate(held):
            mine = seen.setdefault(grams[i], [])
            mine.append(k)
            from_ = mine[-1 - wanted[grams[i]]] + 1 if len(mine) > wanted[grams[i]] else 0
            first = int(np.searchsorted(at, i - widest + 1))
            # shared[j] is what the window from held[j] to here has in common with the item
            shared[max(from_, first) : k + 1] += 1
            union = total + i - at[first : k + 1] + 1 - shared[first : k + 1]
            values = shared[first : k + 1] / union
            j = int(values.argmax())
            if 100 * int(shared[first + j]) >= percent * int(union[j]):
                found = (float(values[j]), -(low + held[first + j]), i - held[first + j] + WORDS)
                best = found if best is None else max(best, found)
        return best


def index_of(items: tuple[tuple[int, bytes], ...]) -> Index:
    return Index(items)


def item_blocks(items: DataFrame, key: str = "item_id", text: str = "text") -> Iterator[tuple]:
    """The items in blocks of at most ITEM_BLOCK rows and bytes (one item at least), in order of their key."""
    rows = items.where(named(text).isNotNull()).select(named(key).cast("long"), named(text)).orderBy(named(key), named(text))
    block, size = [], 0
    for key_, text_ in rows.toLocalIterator():
        data = text_.encode()
        if block and (len(block) >= ITEM_BLOCK[0] or size + len(data) > ITEM_BLOCK[1]):
            yield tuple(block)
            block, size = [], 0
        block.append((key_, data))
        size += len(data)
    if block:
        yield tuple(block)


def benchmark_matches(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
    item_key: str = "item_id", item_text: str = "text", percent: int = PERCENT,
) -> DataFrame:
    """(doc_id, item_id, similarity, first_word, n_words): the best place of each item in each row.

    Null and blank texts hold nothing. Items of fewer than five words have no shingle and are never
    found. Of items with the same key the most similar counts; repeated rows give repeated results,
    also rows without a key. Empty tables give no rows. Other columns are not read.
    """
    bounded_batches(docs.sparkSession)
    slim = docs.select(named(key).cast("long").alias("key"), named(text).alias("text"))
    out = docs.sparkSession.createDataFrame([], FOUND)
    for number, block in enumerate(item_blocks(items, item_key, item_text)):

        def find(batches: Iterator, block=block) -> Iterator:
            import pyarrow as pa

            index = held(index_of, block)
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
            for keys, values in pieces(batches, size=2 << 20):
                rows = [
                    (k, item, s, -first, n)
                    for k, found in zip(keys, index.scan(values, percent))
                    for item, (s, first, n) in found.items()
                ]
                if rows:
                    names = ["doc_id", "item_id", "similarity", "first_word", "n_words"]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
            index.hashes.clear()

        found = slim.mapInArrow(find, FOUND)
        out = found if not number else out.union(found)
    return out


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that hold none of ``items``, with their columns; no shuffle."""
    bounded_batches(docs.sparkSession)
    for block in item_blocks(items):

        def clean(batches, block=block):
            import pyarrow as pa

            index = held(index_of, block)
            for batch in batches:
                values, out, at = [x or b"" for x in batch.cast(pa.binary()).to_pylist()], [], 0
                while at < len(values):
                    end, size = at, 0
                    while end < len(values) and (end == at or size + len(values[end]) <= 2 << 20):
                        size += len(values[end])
                        end += 1
                    out += [not found for found in index.scan(values[at:end], percent)]
                    at = end
                yield pa.array(out, pa.bool_())
            index.hashes.clear()

        docs = docs.where(F.arrow_udf(clean, "boolean", F.ArrowUDFType.SCALAR_ITER)(named(text)))
    return docs
