"""Word shingles as sorted 64-bit hashes, and the binary form in which they travel."""

from __future__ import annotations

import hashlib

import numpy as np

_ODD = tuple(np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                                    0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63))
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)
_PART = 1 << 20  # bytes hashed at once

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Powers:
    """Powers of an odd number and of its inverse modulo 2^64, as many as the longest run needs."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            self.up = np.cumprod(np.r_[np.uint64(1), np.full(2 * n, _BASE, np.uint64)])
            self.down = np.cumprod(np.r_[np.uint64(1), np.full(2 * n, _INVERSE, np.uint64)])
        return self.up[:n], self.down[:n]

    def ranges(self, values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A hash of ``values[begin:end]`` per pair: a polynomial modulo 2^64, from prefix sums."""
        up, down = self.of(len(values) + 1)
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[:-1], out=sums[1:])
        return mixed((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64) * _ODD[0])


class WordHasher(Powers):
    """Finds the words of a text (runs without ASCII white space) and hashes their bytes, without a loop over words."""

    def words(self, data: bytes, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First byte, end and 64-bit hash of each word; the hash depends on the word alone."""
        raw = np.frombuffer(data, np.uint8)
        outside = np.ones(len(raw) + 2, bool)
        outside[1:-1] = SPACE[raw]
        edge = np.flatnonzero(outside[1:] != outside[:-1])
        begin, end = edge[::2], edge[1::2]
        return begin, end, self.hashes(LOWER[raw] if lower else raw, begin, end)

    def hashes(self, raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the bytes of each range; ranges are in order and do not overlap."""
        found, i = [np.zeros(0, np.uint64)], 0
        while i < len(begin):
            j = max(i + 1, int(np.searchsorted(end, begin[i] + _PART)))
            part = raw[begin[i]:end[j - 1]].astype(np.uint64)
            found.append(self.ranges(part, begin[i:j] - begin[i], end[i:j] - begin[i]))
            i = j
        return np.concatenate(found)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def runs(hashes: np.ndarray, width: int) -> np.ndarray:
    """One hash per run of ``width`` words, in order."""
    n = len(hashes) - width + 1
    total = np.zeros(n, np.uint64)
    for i in range(width):
        total += hashes[i:i + n] * _ODD[i]
    return mixed(total)


def shingle_set(data: bytes, width: int, hasher: WordHasher) -> np.ndarray:
    """Sorted distinct shingles; a shorter text is one shingle of all its words, an empty one has none."""
    hashes = hasher.words(data, lower=True)[2]
    if not len(hashes):
        return hashes
    return np.unique(runs(hashes, min(width, len(hashes))) + np.uint64(min(width, len(hashes))))


def digest(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()
