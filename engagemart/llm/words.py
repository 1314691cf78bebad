"""Vectorised work on Arrow text columns: word bounds and 64-bit hashes of words.

Texts stay in the Arrow buffer; word bounds and hashes come from a few numpy passes over
slices of bounded size, so a worker holds one slice (or one longer text) at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_MULTIPLY_1, _MULTIPLY_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MULTIPLY_1
    x = x ^ (x >> np.uint64(27))
    x = x * _MULTIPLY_2
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd number and of its inverse modulo 2^64, grown on demand, for ``least`` numbers at first."""

    def __init__(self, base: int = _BASE, least: int = SLICE_BYTES):
        self._base, self._least = (base, pow(base, -1, 1 << 64)), least
        self._tables = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self._tables[0]):
            size = max(n, self._least + 2)
            for i, base in enumerate(self._base):
                steps = np.full(size, np.uint64(base), np.uint64)
                steps[0] = 1
                self._tables[i] = np.cumprod(steps, dtype=np.uint64)
        return self._tables[0], self._tables[1]


class Rolling:
    """Hash of any stretch of a sequence of numbers, from one prefix sum."""

    def __init__(self, values: np.ndarray, powers: Powers):
        self._direct, self._inverse = powers.upto(len(values) + 1)
        self._sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self._direct[: len(values)], out=self._sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of ``values[starts:ends]``; equal stretches have equal hashes."""
        return mix((self._sums[ends] - self._sums[starts]) * self._inverse[starts])


def text_slices(
    texts: pa.Array, limit: int = SLICE_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, row offsets) of slices of whole texts.

    A slice has at most ``limit`` bytes unless one text is longer; NULL is an empty text.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    width = np.dtype(kind).itemsize
    offsets = np.frombuffer(texts.buffers()[1], kind, len(texts) + 1, texts.offset * width).astype(np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(len(texts), max(first + 1, last))
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each run of non-blank bytes, and the words before each row (n + 1 values)."""
    solid = ~BLANK[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = solid
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = solid
    before[offsets] = False
    starts = np.flatnonzero(after[:-1] & ~before[:-1])
    after[offsets] = False
    ends = np.flatnonzero(solid & ~after[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    lengths = (ends - starts).astype(np.uint64)
    return mix(Rolling(data.astype(np.uint64) + np.uint64(1), powers)(starts, ends) + lengths)


def lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    """Arrow list column from the rows' values one after the other and their counts."""
    return pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(values)
    )


def packed_chunks(column: pa.ChunkedArray, kind: type) -> list[np.ndarray]:
    """The numbers packed in each chunk of a binary column, without a copy."""
    found = []
    for chunk in column.chunks:
        if len(chunk):
            offsets = np.frombuffer(chunk.buffers()[1], np.int32, len(chunk) + 1, 4 * chunk.offset)
            found.append(np.frombuffer(chunk.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view(kind))
    return found


def packed(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    """The numbers packed in a binary column, one value after the other, without copying each."""
    column = column.combine_chunks()
    if not len(column):
        return np.zeros(0, kind)
    offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, 4 * column.offset)
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view(kind)
