"""Ids in the fewest bits that hold the vocabulary, in blocks with offsets.

Layout of a file: blocks of packed ids, most significant bit first; then little-endian int64 arrays
(block offsets with the end of the last one, document starts with the end of the last one, document
keys) and one byte per document for a null key; then the six int64 of ``TAIL`` and the magic word.
All of a file's blocks hold ``BLOCK`` ids but the last.
"""

from __future__ import annotations

import numpy as np

BLOCK = 8192
MAGIC = b"TDCIDS01"
TAIL = ("width", "n_ids", "n_docs", "n_blocks", "block", "index_at")


def width_of(vocabulary: int) -> int:
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """``ids`` in ``width`` bits each; the last byte is filled with zeros."""
    if width % 8 == 0:
        held = ids.astype(">u4").view(np.uint8).reshape(-1, 4)
        return held[:, 4 - width // 8 :].tobytes()
    bits = np.unpackbits(ids.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)[:, 32 - width :]
    return np.packbits(bits).tobytes()


def unpack(data: bytes, n: int, width: int) -> np.ndarray:
    """The ``n`` ids packed in ``data``, as little-endian uint32."""
    raw = np.frombuffer(data, np.uint8)
    wide = np.zeros((n, 4), np.uint8)
    if width % 8 == 0:
        wide[:, 4 - width // 8 :] = raw[: n * width // 8].reshape(n, width // 8)
    else:
        bits = np.zeros((n, 32), np.uint8)
        bits[:, 32 - width :] = np.unpackbits(raw, count=n * width).reshape(n, width)
        wide[:] = np.packbits(bits, axis=1)
    return wide.reshape(-1).view(">u4").astype("<u4")


class Writer:
    """Packs documents into ``out`` (anything with ``write`` and ``at``), a block at a time."""

    def __init__(self, out, width: int):
        self.out, self.width = out, width
        self.held, self.n_held, self.n_ids = [], 0, 0
        self.starts, self.keys, self.offsets = [], [], []

    def add(self, key: int | None, ids: bytes) -> None:
        """One document: its key and its ids as little-endian uint32."""
        self.starts.append(self.n_ids)
        self.keys.append(key)
        self.held.append(ids)
        self.n_held += len(ids) // 4
        self.n_ids += len(ids) // 4
        if self.n_held >= BLOCK:
            self._flush(self.n_held - self.n_held % BLOCK)

    def _flush(self, n: int) -> None:
        ids = np.frombuffer(b"".join(self.held), "<u4")
        for at in range(0, n, BLOCK):
            self.offsets.append(self.out.at)
            self.out.write(pack(ids[at : min(at + BLOCK, n)], self.width))
        self.held, self.n_held = [ids[n:].tobytes()], len(ids) - n

    def close(self) -> None:
        if self.n_held:
            self._flush(self.n_held)
        n_blocks, index_at = len(self.offsets), self.out.at
        offsets, starts = [*self.offsets, index_at], [*self.starts, self.n_ids]
        for values in (offsets, starts, [k or 0 for k in self.keys]):
            self.out.write(np.array(values, "<i8").tobytes())
        self.out.write(np.array([k is None for k in self.keys], np.uint8).tobytes())
        self.out.write(np.array([self.width, self.n_ids, len(self.keys), n_blocks, BLOCK, index_at], "<i8").tobytes())
        self.out.write(MAGIC)


class Reader:
    """Random access to a written file, given something with ``size()`` and ``read_at(n, offset)``."""

    def __init__(self, file):
        self.file, size = file, file.size()
        tail = 8 * len(TAIL) + len(MAGIC)
        end = file.read_at(tail, size - tail)
        if end[-len(MAGIC) :] != MAGIC:
            raise ValueError("this is no file of packed ids")
        self.width, self.n_ids, self.n_docs, n_blocks, self.block, at = np.frombuffer(end, "<i8", len(TAIL)).tolist()
        index = file.read_at(size - tail - at, at)
        self.offsets = np.frombuffer(index, "<i8", n_blocks + 1)
        self.starts = np.frombuffer(index, "<i8", self.n_docs + 1, 8 * (n_blocks + 1))
        self.keys = np.frombuffer(index, "<i8", self.n_docs, 8 * (n_blocks + self.n_docs + 2))
        self.nulls = np.frombuffer(index, np.uint8, self.n_docs, 8 * (n_blocks + 2 * self.n_docs + 2))

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` (exclusive) of the file, reading only their blocks."""
        if start >= stop:
            return np.zeros(0, "<u4")
        first, last = start // self.block, (stop - 1) // self.block
        at = int(self.offsets[first])
        data = self.file.read_at(int(self.offsets[last + 1]) - at, at)
        n = min(self.n_ids, (last + 1) * self.block) - first * self.block
        # whole blocks end on a byte, since a block's ids are a multiple of eight
        return unpack(data, n, self.width)[start - first * self.block : stop - first * self.block]

    def documents(self, most: int = 1 << 20):
        """(key, start, ids) of every document, reading about ``most`` ids at a time."""
        at = 0
        while at < self.n_docs:
            end = max(at + 1, int(np.searchsorted(self.starts, self.starts[at] + most, "right")) - 1)
            end = min(end, self.n_docs)
            held, base = self.ids(int(self.starts[at]), int(self.starts[end])), int(self.starts[at])
            for d in range(at, end):
                a, b = int(self.starts[d]), int(self.starts[d + 1])
                yield (None if self.nulls[d] else int(self.keys[d])), a, held[a - base : b - base]
            at = end
