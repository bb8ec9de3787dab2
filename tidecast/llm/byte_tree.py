"""The context tree of ``context_tree`` with a node for every context of the training bytes, in pieces.

Numerical helpers for tasks that hold a part of the tree each; ``lm_scoring`` spreads them. A gram is a
byte after its context, as one number: the most recent byte first, the byte itself last, so that sorted
grams hold each context's subtree together. A decision is (context, beginning of the byte) as one number; only
those that training bytes made are held. A part has whole subtrees below contexts of CUT bytes; what is above them are sums over
parts, at most 255 decisions for each context of fewer than CUT bytes. As every context has a node, nothing
is left for the leaves beside the nodes: a byte that goes on below a node does so in one of its children.
"""

from __future__ import annotations

import numpy as np

from tidecast.llm.context_tree import DEPTH, _log_gamma, counted, positions

CUT = 3  # bytes of the contexts whose subtrees are never divided
HALF = float(np.log(0.5))


def grams_of(texts: list[bytes]):
    """(gram of each byte to predict, first of them per text)."""
    flat, at, starts = positions(texts)
    grams = np.zeros(len(at), np.int64)
    for back in (*range(1, DEPTH + 1), 0):
        grams <<= 8
        grams |= flat[at - back]
    return grams, starts


def tallied(texts: list[bytes], learnt: list[bool]):
    """Sorted distinct grams of ``texts`` and how often those of the learnt ones have them, which may be 0."""
    grams, starts = grams_of(texts)
    sizes = np.diff(np.r_[starts, len(grams)])
    grams <<= 1
    grams |= np.repeat(np.array(learnt, np.int64), sizes)
    grams, counts = counted(grams)
    return counted(grams >> 1, counts * (grams & 1))


def part_of(grams, parts: int):
    """The part of the tree that holds each gram: one for all with the same CUT last bytes before."""
    context = (grams >> (8 * (DEPTH + 1 - CUT))).astype(np.uint64)
    return ((context * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % parts


def packed(values) -> bytes:
    """Integers by places of their bytes, which are mostly zeros, compressed."""
    import pyarrow as pa

    planes = np.ascontiguousarray(values, "<i8").view(np.uint8).reshape(-1, 8).T.tobytes()
    return len(values).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unpacked(data: bytes):
    import pyarrow as pa

    n = int.from_bytes(data[:8], "little")
    planes = pa.decompress(data[8:], decompressed_size=8 * n, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, n).T).view("<i8").reshape(-1)


def packed_grams(grams) -> bytes:
    return packed(np.diff(grams, prepend=0))


def unpacked_grams(data: bytes):
    return np.cumsum(unpacked(data))


def _sum(of, values, n: int):
    return np.bincount(of, values, n).astype(float)  # without values bincount gives integers


class Level:
    """The decisions of one depth: sorted ``ids``, how often each was made and was 1, and ``deep``, the log of its weighted probability.

    ``below`` is the sum of ``deep`` over the children, None at the full depth; ``up`` has the places of the children's parents.
    """

    def __init__(self, ids, n, ones, below=None, up=None):
        self.ids, self.n, self.ones, self.up = ids, n, ones, up
        own = _log_gamma(n - ones + 0.5) + _log_gamma(ones + 0.5) - np.log(np.pi) - _log_gamma(n + 1)
        self.deep = own if below is None else np.logaddexp(own, below) + HALF
        self.weight = np.exp(np.minimum(0, own + HALF - self.deep))

    def sums(self):
        """(ids, n, ones, sum of deep, places of the parents) of the depth above."""
        ids, up = np.unique((self.ids >> 16 << 8) | (self.ids & 255), return_inverse=True)
        return ids, *(_sum(up, x, len(ids)) for x in (self.n, self.ones, self.deep)), up

    def descend(self, mixed, rest):
        """What goes down from here, from what came down to each decision: chances mixed so far and the weight that is left.

        ``stop`` is the chance of a 1 where the next context has no node, ``zero`` where it has, but never made the decision.
        """
        own = (self.ones + 0.5) / (self.n + 1)
        self.stop = mixed + rest * own
        self.mixed, self.rest = mixed + rest * self.weight * own, rest * (1 - self.weight)
        self.zero = self.mixed + self.rest * 0.5
        return self


def _subtrees(grams, counts) -> list[Level]:
    """The levels from CUT to DEPTH of grams with their counts."""
    learnt = counts > 0
    grams, counts = grams[learnt], counts[learnt].astype(float)
    byte = grams & 255
    each = np.concatenate([(grams & ~255) | ((256 | byte) >> (8 - k)) for k in range(8)])
    ones = np.concatenate([counts * ((byte >> (7 - k)) & 1) for k in range(8)])
    ids, of = np.unique(each, return_inverse=True)
    levels = [Level(ids, _sum(of, np.tile(counts, 8), len(ids)), _sum(of, ones, len(ids)))]
    for _ in range(DEPTH - CUT):
        levels.insert(0, Level(*levels[0].sums()))
    return levels


def summary(grams, counts):
    """(ids, n, ones, sum of deep) that a part adds to the decisions of depth CUT - 1."""
    return _subtrees(grams, counts)[0].sums()[:4]


def top(ids, n, ones, below) -> list[Level]:
    """The levels from 0 to CUT - 1, from the sums over all parts."""
    order = np.argsort(ids)
    levels = [Level(ids[order], n[order], ones[order], below[order])]
    for _ in range(CUT - 1):
        levels.insert(0, Level(*levels[0].sums()))
    levels[0].descend(np.zeros(len(levels[0].ids)), np.ones(len(levels[0].ids)))
    for above, level in zip(levels, levels[1:]):
        level.descend(above.mixed[above.up], above.rest[above.up])
    return levels


def _find(ids, wanted):
    """(places, whether there)."""
    if not len(ids):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(ids, wanted), len(ids) - 1)
    return at, ids[at] == wanted


def log10_of(grams, counts, above: list[Level]):
    """log10 of the probability of each gram's byte after its context; ``grams`` are all of a part, learnt or not."""
    levels = _subtrees(grams, counts)
    at, _ = _find(above[-1].ids, (levels[0].ids >> 16 << 8) | (levels[0].ids & 255))
    levels[0].descend(above[-1].mixed[at], above[-1].rest[at])
    for upper, level in zip(levels, levels[1:]):
        level.descend(upper.mixed[upper.up], upper.rest[upper.up])
    levels = [*above, *levels]
    contexts = [grams >> (8 * (DEPTH + 1 - depth)) for depth in range(DEPTH + 1)]
    known = [_find(level.ids, context << 8 | 1)[1] for level, context in zip(levels, contexts)]
    byte, out = grams & 255, np.zeros(len(grams))
    for k in range(8):
        chance, begin = np.full(len(grams), 0.5), (256 | byte) >> (8 - k)
        for depth, (level, context) in enumerate(zip(levels, contexts)):
            at, found = _find(level.ids, context << 8 | begin)
            if found.any():
                here = level.stop[at] if depth == DEPTH else np.where(known[depth + 1], level.zero[at], level.stop[at])
                chance = np.where(found, here, chance)
        out += np.log10(np.where((byte >> (7 - k)) & 1, chance, 1 - chance))
    return out.astype(np.float32)
