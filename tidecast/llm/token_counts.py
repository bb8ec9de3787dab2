"""Token counts of texts by byte-pair merging, without making any token id.

A piece of text begins as one symbol per byte. A heap holds its adjacent pairs that have a merge
rule, lowest rank first and leftmost among equals; a doubly linked list holds the symbols that are
left. Popping a live pair joins its two symbols and offers the pairs with the new neighbours. The
count of a piece is its number of bytes less its merges. Heap entries whose pair is gone are dropped
when they come up, so a piece of n bytes takes O(n log n) however long it is.

Pieces never span white space, so a text is cut at white space first, and each worker remembers the
counts of the words and pieces it has met.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import held, named
from tidecast.llm.token_output import tokenizer_path

LIMIT = 2048
KNOWN = 400_000  # words, and as many pieces, a worker remembers; it forgets them all when there are more
RUN = 4 << 20  # bytes of text whose words are looked at together


def byte_marks() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    own = [b for a, z in ((33, 126), (161, 172), (174, 255)) for b in range(a, z + 1)]
    marks = {b: chr(b) for b in own}
    for b in range(256):
        marks.setdefault(b, chr(256 + len(marks) - len(own)))
    return [marks[b] for b in range(256)]


class MergeRules:
    """Ranks of symbol pairs from a tokenizer file; symbols are numbers private to this object."""

    def __init__(self, merges: list, end: str):
        number: dict[str, int] = {}

        def symbol(token: str) -> int:
            return number.setdefault(token, len(number))

        marks = byte_marks()
        self.inner = [symbol(m) for m in marks]
        self.last = [symbol(m + end) for m in marks]
        self.rank: dict[tuple[int, int], int] = {}
        self.joined: list[int] = []
        for rank, pair in enumerate(merges):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.rank[symbol(left), symbol(right)] = rank
            self.joined.append(symbol(left + right))

    def count(self, piece: bytes) -> int:
        """Symbols left of a piece that isn't empty when no pair can be merged any more."""
        size = len(piece)
        inner, rank_of, joined = self.inner, self.rank.get, self.joined
        symbols = [inner[b] for b in piece]
        symbols[-1] = self.last[piece[-1]]
        heap = []
        for at in range(size - 1):
            rank = rank_of((symbols[at], symbols[at + 1]))
            if rank is not None:
                heap.append((rank, at))
        if not heap:
            return size
        heapq.heapify(heap)
        pop, push = heapq.heappop, heapq.heappush
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        merges = 0
        while heap:
            rank, at = pop(heap)
            right = after[at]
            # A symbol taken by its left neighbour is -1; any other change of the pair changes its rank.
            if right == size or rank_of((symbols[at], symbols[right])) != rank:
                continue
            symbols[at] = new = joined[rank]
            symbols[right] = -1
            merges += 1
            after[at] = beyond = after[right]
            if beyond < size:
                before[beyond] = at
                rank = rank_of((new, symbols[beyond]))
                if rank is not None:
                    push(heap, (rank, at))
            left = before[at]
            if left >= 0:
                rank = rank_of((symbols[left], new))
                if rank is not None:
                    push(heap, (rank, left))
        return size - merges


class TokenCounter:
    """Token counts of texts by a byte-pair tokenizer file (JSON) whose pieces don't span white space.

    The file's own added tokens count as one where they stand in a text, as its library does by default.
    """

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, first = spec["model"], (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0]
        norms = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        if model["type"] != "BPE" or norms != ["NFC", "Replace", "Lowercase"] or first.get("type") != "Split":
            raise ValueError(f"{path} isn't a lower-casing byte-pair tokenizer that drops white space")
        self.rules = MergeRules(model["merges"], model["end_of_word_suffix"] or "")
        self.cut = regex.compile(first["pattern"]["Regex"])
        added = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.words: dict[bytes, int] = {}
        self.pieces: dict[bytes, int] = {}

    def _piece(self, piece: bytes) -> int:
        n = self.pieces.get(piece)
        if n is None:
            if len(self.pieces) >= KNOWN:
                self.pieces.clear()
            n = self.pieces[piece] = self.rules.count(piece)
        return n

    def _word(self, raw: bytes) -> int:
        if raw.isalpha():  # ASCII letters: one piece, unless the pattern cuts it, which takes an apostrophe
            return self._piece(raw.lower())
        word, n = raw.decode("utf-8", "replace"), 0
        parts = [word]
        if self.added and self.added.search(word):
            parts = self.added.split(word)
            n = len(parts) - 1
        for part in parts:
            # Letters are lowered one by one, so a sigma at a word's end is like any other.
            lowered = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
            n += sum(self._piece(p.encode()) for p in self.cut.findall(lowered))
        return n

    def _total(self, words: list[bytes]) -> int:
        known = self.words
        try:
            return sum(map(known.__getitem__, words))
        except KeyError:
            pass
        new = set(words).difference(known)
        if len(known) + len(new) > KNOWN:
            known.clear()
            new = set(words)
        for raw in new:
            known[raw] = self._word(raw)
        return sum(map(known.__getitem__, words))

    def count(self, text: bytes) -> int:
        """Tokens of a whole text; long ones are looked at in runs that end at white space."""
        total = at = 0
        while len(text) - at > RUN:
            stop = max(text.rfind(b" ", at, at + RUN), text.rfind(b"\n", at, at + RUN))
            if stop <= at:  # no blank in a whole run: one word, taken with all the rest
                break
            total += self._total(text[at:stop].split())
            at = stop
        return total + self._total(text[at:].split())


def _counter(path: str) -> TokenCounter:
    return TokenCounter(path)


def token_counts(
    docs: DataFrame, path: str | None = None, limit: int = LIMIT, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) of every row; a null or empty text has none of either.

    Rows are kept as they are: repeated and null keys too. An empty table gives no rows; other
    columns, whatever their names, are not read. No shuffle, and no state besides the workers'
    bounded memory of counts.
    """
    file = path or tokenizer_path()

    @F.arrow_udf("long")
    def tokens(column):
        import pyarrow as pa

        counter = held(_counter, file)
        return pa.array([counter.count(x) for x in column.to_pylist()], pa.int64())

    body = F.coalesce(named(text).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(named(key).alias("key"), F.octet_length(body).cast("long").alias("n_bytes"), tokens(body).alias("n_tokens"))
    return rows.select(F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
