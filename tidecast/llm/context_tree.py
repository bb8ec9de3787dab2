"""A context tree over bytes: Krichevsky-Trofimov estimates of all depths, mixed by weighting.

Small numerical helpers; counting and scoring are spread by Spark in ``lm_scoring``. A byte is eight
binary decisions, each with a tree of its own over the contexts (the bytes before, most recent
first, at most DEPTH). A tree that is held in one place may leave out rare contexts; what a node sees in those goes to
one more leaf below it, so every byte is counted in a leaf. Texts are scored by the tree of all contexts (``byte_tree``). A node's weighted probability is the
mean of its own estimate and the product over what is below it.
"""

from __future__ import annotations

import numpy as np

DEPTH = 4
NODES = 8192  # per depth, a bound for trees in one place; texts are scored without any
END = 0xFF  # never in UTF-8: before a text and after it
LEVELS = [(1 << k) - 1 for k in range(8)]  # where the decisions on bit k begin among the 255
BYTES = np.arange(256)


def positions(texts: list[bytes]):
    """(bytes with END around each text, indices of the bytes to predict, first of them per text)."""
    pad = bytes([END]) * DEPTH
    flat = np.frombuffer(b"".join(pad + t + bytes([END]) for t in texts), np.uint8)
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    at = np.arange(int(sizes.sum())) + np.repeat((np.arange(len(texts)) + 1) * DEPTH, sizes)
    return flat, at, starts


def grams(texts: list[bytes]):
    """Each predicted byte with the DEPTH bytes before it, as one number, the byte last."""
    flat, at, _ = positions(texts)
    key = np.zeros(len(at), np.int64)
    for back in range(DEPTH, -1, -1):
        key <<= 8
        key |= flat[at - back]
    return key


def counted(values, counts=None):
    """Distinct values and how often each came."""
    if counts is None:  # the caller's array is used up
        order = None
        values.sort()
    else:
        order = np.argsort(values, kind="stable")
        values = values[order]
    first = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.zeros(0, np.int64)
    if order is None:
        return values[first], np.diff(np.r_[first, len(values)])
    return values[first], np.add.reduceat(counts[order], first) if len(first) else counts[:0]


def _log_gamma(x):
    """The logarithm of the gamma function for x >= 0.5, by Stirling's series after eight steps up."""
    shift = np.zeros_like(x)
    for k in range(8):
        shift += np.log(x + k)
    y = x + 8
    inv = 1 / (y * y)
    series = (1 / 12 - inv * (1 / 360 - inv * (1 / 1260 - inv / 1680))) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - shift


def _decisions(counts):
    """How often each of the 255 decisions was 0 and 1; ``counts`` has a column per byte."""
    sums, zeros, ones = counts, [], []
    for _ in range(8):
        zeros.append(sums[:, 0::2])
        ones.append(sums[:, 1::2])
        sums = zeros[-1] + ones[-1]
    return np.concatenate(zeros[::-1], 1), np.concatenate(ones[::-1], 1)


def _log_kt(counts, chunk: int = 1024):
    """Log block probability of every decision of every row."""
    out = np.zeros((len(counts), 255))
    for at in range(0, len(counts), chunk):
        n0, n1 = _decisions(counts[at : at + chunk].astype(float))
        out[at : at + chunk] = _log_gamma(n0 + 0.5) + _log_gamma(n1 + 0.5) - np.log(np.pi) - _log_gamma(n0 + n1 + 1)
    return out


def _estimate(counts):
    """Chance of a 1 in every decision of every row."""
    n0, n1 = _decisions(counts.astype(float))
    return ((n1 + 0.5) / (n0 + n1 + 1)).astype(np.float32)


def _bytes_log10(ones):
    """log10 of every byte's probability, from the chances of a 1 in the 255 decisions."""
    out = np.zeros((len(ones), 256), np.float32)
    with np.errstate(divide="ignore"):
        one, zero = np.log10(ones), np.log10(1 - ones)
    for k, base in enumerate(LEVELS):
        at = base + (BYTES >> (8 - k))
        out += np.where((BYTES >> (7 - k)) & 1, one[:, at], zero[:, at])
    return out


class ContextTree:
    """States and log10 probabilities: walk ``step`` DEPTH times from state 0, then read ``table``."""

    def __init__(self, step, row, table):
        self.step, self.row, self.table = step, row, table

    def log10(self, texts: list[bytes]):
        """log10 probability of each whole text, its end included."""
        flat, at, starts = positions(texts)
        state = np.zeros(len(at), np.int64)
        for back in range(1, DEPTH + 1):
            state = self.step[state * 256 + flat[at - back]].astype(np.int64)
        each = self.table[self.row[state] * 256 + flat[at]]
        return np.add.reduceat(each, starts, dtype=np.float64) if len(starts) else np.zeros(0)


def build(levels: list[tuple]) -> ContextTree:
    """The tree from (context, byte, count) arrays of each depth, 0 to DEPTH, kept contexts only.

    A context is the number whose lowest byte is the most recent. An empty corpus makes every byte
    as likely as any other.
    """
    contexts, counts = [], []
    for depth, (context, byte, n) in enumerate(levels):
        known = np.unique(context) if depth else np.zeros(1, np.int64)
        table = np.zeros((len(known), 256), np.int64)
        np.add.at(table, (np.searchsorted(known, context), byte), n)
        contexts.append(known)
        counts.append(table)
    parents = [None]
    for depth in range(1, DEPTH + 1):
        up = contexts[depth] & ((1 << (8 * (depth - 1))) - 1)
        parents.append(np.searchsorted(contexts[depth - 1], up))
    others = []
    for depth in range(DEPTH):
        below = np.zeros_like(counts[depth])
        np.add.at(below, parents[depth + 1], counts[depth + 1])
        others.append(counts[depth] - below)

    weights, deep = [None] * DEPTH, _log_kt(counts[DEPTH])
    for depth in range(DEPTH - 1, -1, -1):
        own, split = _log_kt(counts[depth]), _log_kt(others[depth])
        np.add.at(split, parents[depth + 1], deep)
        deep = np.logaddexp(own, split) + np.log(0.5)
        weights[depth] = np.exp(np.minimum(0, own + np.log(0.5) - deep)).astype(np.float32)

    offsets = np.cumsum([0, *map(len, contexts)])  # of the states of nodes; those that stop at a node come after
    n_inner = int(offsets[DEPTH])
    n_states = int(offsets[-1]) + n_inner
    step = np.repeat(np.arange(n_states), 256).reshape(n_states, 256)
    row = np.zeros(n_states, np.int64)
    tables, filled = [], 0
    mixed, rest = np.zeros((1, 255), np.float32), np.ones((1, 255), np.float32)
    for depth in range(DEPTH):
        here, stop = np.arange(len(contexts[depth])) + offsets[depth], np.arange(len(contexts[depth])) + offsets[depth]
        stop = stop + int(offsets[-1])
        step[here] = stop[:, None]
        newest = contexts[depth + 1] >> (8 * depth)
        step[parents[depth + 1] + offsets[depth], newest] = np.arange(len(contexts[depth + 1])) + offsets[depth + 1]
        if depth:
            mixed, rest = mixed[parents[depth]], rest[parents[depth]]
        own = _estimate(counts[depth])
        mixed = mixed + rest * weights[depth] * own
        rest = rest * (1 - weights[depth])
        empty = others[depth].sum(1) == 0
        aside = np.where(empty[:, None], own, _estimate(others[depth]))
        tables.append(_bytes_log10(mixed + rest * aside))
        row[stop] = filled + np.arange(len(stop))
        filled += len(stop)
    leaf = parents[DEPTH]
    tables.append(_bytes_log10(mixed[leaf] + rest[leaf] * _estimate(counts[DEPTH])))
    row[offsets[DEPTH] : offsets[DEPTH + 1]] = filled + np.arange(len(leaf))
    kind = np.uint16 if n_states <= 1 << 16 else np.int32
    return ContextTree(step.astype(kind).reshape(-1), row, np.concatenate(tables).reshape(-1))
