"""Minimal perfect hashing: n distinct keys to the numbers 0 to n - 1, in a few bits a key.

Keys are pairs of 64-bit hashes. Level after level, every key left over is hashed into a row of bits; a
bit that exactly one key meets is set and settles that key, and the others go on to the next level. A key's
number is the count of set bits before its own. A key that was not there at building gets -1 or the number
of some other key, which is why whoever stores entries stores a fingerprint of the key with them.
"""

from __future__ import annotations

import numpy as np

from engagemart.llm.words import mix

#: Bits a level has for each key left over; more of them make fewer levels.
GAMMA = 2.0
MOST_LEVELS = 100
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _places(first: np.ndarray, second: np.ndarray, level: int, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(first + mix(second + np.uint64(level) * _STEP)) % np.uint64(bits)).astype(np.int64)


class PerfectHash:
    def __init__(self, levels: list[np.ndarray]):
        """``levels``: each level's bits as 64-bit words."""
        self._levels = levels
        self._ranks, total = [], 0
        for words in levels:
            counts = np.bitwise_count(words).astype(np.int64)
            self._ranks.append(total + np.cumsum(counts) - counts)
            total += int(counts.sum())
        self.size = total

    @classmethod
    def build(cls, first: np.ndarray, second: np.ndarray) -> PerfectHash:
        """From distinct pairs of unsigned 64-bit hashes."""
        levels = []
        while len(first):
            if len(levels) == MOST_LEVELS:
                raise ValueError("keys must be distinct")
            width = max(1, int(np.ceil(GAMMA * len(first) / 64)))
            places = _places(first, second, len(levels), 64 * width)
            alone = np.bincount(places, minlength=64 * width)[places] == 1
            bits = np.zeros(64 * width, np.uint8)
            bits[places[alone]] = 1
            levels.append(np.packbits(bits, bitorder="little").view("<u8"))
            first, second = first[~alone], second[~alone]
        return cls(levels)

    def __call__(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The keys' numbers, -1 for keys that meet no bit."""
        numbers, left = np.full(len(first), -1, np.int64), np.arange(len(first))
        for level, (words, ranks) in enumerate(zip(self._levels, self._ranks, strict=True)):
            if not len(left):
                break
            places = _places(first[left], second[left], level, 64 * len(words))
            word, bit = words[places >> 6], (places & 63).astype(np.uint64)
            met = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            numbers[left[met]] = (ranks[places >> 6] + below)[met]
            left = left[~met]
        return numbers

    def to_bytes(self) -> bytes:
        sizes = np.array([len(self._levels), *map(len, self._levels)], "<u4")
        return b"".join([sizes.tobytes(), *[words.tobytes() for words in self._levels]])

    @classmethod
    def from_bytes(cls, data: bytes) -> tuple[PerfectHash, int]:
        """The hash at the front of ``data`` and the bytes it takes."""
        count = int(np.frombuffer(data, "<u4", 1)[0])
        sizes = np.frombuffer(data, "<u4", count, 4).astype(int)
        levels, place = [], 4 + 4 * count
        for size in sizes:
            levels.append(np.frombuffer(data, "<u8", size, place))
            place += 8 * size
        return cls(levels), place
