"""Vectorised text primitives over Arrow string buffers.

Documents arrive as Arrow string arrays, whose character data is one contiguous UTF-8 buffer.  Words, their
64-bit hashes and per-document sums are computed over that buffer with numpy, a slice of documents at a time, so
that temporaries stay near ``SLICE_BYTES`` times a small constant.  One document is never split.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; a longer document forms a slice of its own.
SLICE_BYTES = 1 << 18
#: Rows of an Arrow batch that are turned into Python or copied at once.
PART_ROWS = 500

_SEED = np.random.RandomState(20240607)
_BYTE = np.frombuffer(_SEED.bytes(256 * 8), np.uint64).copy()
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]

#: Word bytes: everything but ASCII white space.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: Word bytes: ASCII letters and digits and every byte of a non-ASCII character.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True

_factors: list[np.ndarray] = []


def _factor(n: int) -> np.ndarray:
    """A pseudo-random odd factor for each of n places in a word.  Unlike powers of one base modulo 2^64, whose sums vanish
    on some pairs of long words whatever the base, they have no algebraic relation."""
    if not _factors or len(_factors[0]) < n:
        _factors[:] = [mix64(np.arange(1, max(n, SLICE_BYTES) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)]
    return _factors[0][:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def settle() -> None:
    """Gives freed memory back to the system: Python workers are used again, and what they keep counts with later tasks."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def slices(column: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of documents; null texts count as empty."""
    for begin in range(0, len(column), PART_ROWS):
        part = pc.fill_null(column.slice(begin, PART_ROWS), "").cast(pa.large_string())
        n = len(part)
        _, offsets, data = part.buffers()
        off = np.frombuffer(offsets, np.int64)[part.offset : part.offset + n + 1]
        data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        i = 0
        while i < n:
            j = max(i + 1, min(n, int(np.searchsorted(off, off[i] + max_bytes, "right")) - 1))
            yield begin + i, begin + j, data[off[i] : off[j]], off[i : j + 1] - off[i]
            i = j
    settle()


def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of PART_ROWS rows at most, without copying."""
    for batch in batches:
        for at in range(0, len(batch), PART_ROWS):
            yield batch.slice(at, PART_ROWS)


def per_doc(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sum of one value a byte over each document."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[off[1:]] - total[off[:-1]]


class Words:
    """Words of a slice in text order: start and end byte, document index, 64-bit hash, position in its document."""

    def __init__(self, buf: np.ndarray, off: np.ndarray, table: np.ndarray = NOT_SPACE, lower: bool = True):
        n = len(buf)
        inside = table[buf]
        edge = np.zeros(n + 1, bool)
        edge[off] = True
        before = np.zeros(n, bool)
        before[1:] = inside[:-1]
        before[edge[:n]] = False
        after = np.zeros(n, bool)
        after[:-1] = inside[1:]
        after[edge[1:]] = False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.doc = np.searchsorted(off, self.start, "right") - 1
        self.n_docs = len(off) - 1
        self.first = np.searchsorted(self.start, off)  # of each document's words
        self.count = np.diff(self.first)
        sums = np.zeros(n + 1, np.uint64)
        size = self.end - self.start
        if len(size):
            at = np.flatnonzero(inside)  # the bytes of all words, in order
            place = np.arange(len(at)) - np.repeat(np.cumsum(size) - size, size)
            value = np.zeros(n, np.uint64)
            value[at] = (_BYTE_LOWER if lower else _BYTE)[buf[at]] * _factor(int(size.max()))[place]
            np.cumsum(value, out=sums[1:])
        self._sums = sums
        self.hash = mix64(sums[self.end] - sums[self.start] + size.astype(np.uint64))

    def __len__(self) -> int:
        return len(self.start)

    def prefix(self, size: int) -> np.ndarray:
        """Hashes of the words' first bytes, apart from word hashes; 0 for words that are no longer than that."""
        at = self.start + size
        longer = at < self.end
        return np.where(longer, mix64(self._sums[np.minimum(at, self.end)] - self._sums[self.start] - np.uint64(size)), np.uint64(0))

    @property
    def pos(self) -> np.ndarray:
        return np.arange(len(self.start)) - self.first[self.doc]


def word_hash(words: list[str], lower: bool = True) -> np.ndarray:
    """The hashes that Words gives to these words."""
    data = [w.encode() for w in words]
    off = np.concatenate([[0], np.cumsum([len(x) for x in data])]).astype(np.int64)
    every = np.ones(256, bool)
    return Words(np.frombuffer(b"".join(data), np.uint8), off, every, lower).hash if data else np.zeros(0, np.uint64)


def shingles(words: Words, k: int, short: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, hash, first word) of each run of k words; with short, a document of fewer words is one run."""
    h, n = words.hash, len(words)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    left = words.first[words.doc + 1] - np.arange(n)  # words from here to the document's end
    out = np.zeros(n, np.uint64)
    for i in range(k):
        there = left > i
        shifted = np.zeros(n, np.uint64)
        shifted[: max(n - i, 0)] = h[i:]
        out = np.where(there, mix64(out + shifted * np.uint64(2 * i + 3) + np.uint64(i + 1)), out)
    keep = left >= k
    if short:
        first = words.first[:-1][(words.count > 0) & (words.count < k)]
        keep[first] = True
    at = np.flatnonzero(keep)
    return words.doc[at], out[at], at


class HashIndex:
    """Position of 64-bit keys in a fixed array, looked up for whole arrays at once."""

    def __init__(self, keys: np.ndarray):
        keys = np.asarray(keys, np.uint64)
        self.bits = np.uint64(64 - max(4, int(len(keys) * 2).bit_length()))
        slot = (mix64(keys) >> self.bits).astype(np.int64)
        self.order = np.argsort(slot, kind="stable")
        self.keys = keys[self.order]
        count = np.bincount(slot, minlength=1 << int(64 - int(self.bits)))
        self.at = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)

    def find(self, x: np.ndarray) -> np.ndarray:
        """Index of each value in the keys as given, or -1."""
        out = np.full(len(x), -1, np.int64)
        if not len(self.keys):
            return out
        slot = (mix64(x) >> self.bits).astype(np.int64)
        at, end = self.at[slot], self.at[slot + 1]
        live = np.flatnonzero(at < end)
        while len(live):
            here = at[live]
            hit = self.keys[here] == x[live]
            out[live[hit]] = self.order[here[hit]]
            at[live] += 1
            live = live[~hit]
            live = live[at[live] < end[live]]
        return out
