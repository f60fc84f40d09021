"""Words of texts as hashes, for work on word sequences in Arrow batches.

Words are what ASCII white space separates; their 128-bit hashes are looked up once per distinct word
and kept in a bounded cache that lives as long as the Python worker. Where 64 bits do, ``range_hashes`` takes
words as ranges of bytes, by prefix sums, at one cost for new and known words.
"""

from __future__ import annotations

import numpy as np

_CACHE_WORDS = 150_000
#: Odd multipliers of the polynomial hashes (5 modulo 8, so that powers differ in many bits).
LOW, HIGH = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)


class WordHashes(dict):
    """word -> row number of its hashes; the arrays ``low`` and ``high`` hold them."""

    def __init__(self):
        super().__init__()
        self.rows, self.size = np.zeros((2, 1 << 12), "uint64"), 0

    def __missing__(self, word):
        import xxhash

        if self.size == self.rows.shape[1]:
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)], axis=1)
        whole = xxhash.xxh3_128_intdigest(word)
        self.rows[:, self.size] = whole & 0xFFFFFFFFFFFFFFFF, whole >> 64
        at = self[word] = self.size
        self.size += 1
        return at

    def hashes(self, words: list[bytes]) -> np.ndarray:
        """Two rows: the low and the high 64 bits of each word's hash."""
        if self.size > _CACHE_WORDS:
            self.clear()
            self.size = 0
        at = np.fromiter(map(self.__getitem__, words), "int64", len(words))
        return self.rows[:, at]


_cache = WordHashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return _cache.hashes(words)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def rolling(values: np.ndarray, size: int, multiplier: np.uint64) -> np.ndarray:
    """Hash of every run of ``size`` values, the order of values included."""
    n = len(values) - size + 1
    if n <= 0:
        return np.zeros(0, "uint64")
    out = values[:n].copy()
    for i in range(1, size):
        out *= multiplier
        out += values[i : i + n]
    return out


_powers: dict[int, np.ndarray] = {}


def powers(multiplier: np.uint64, n: int) -> np.ndarray:
    """multiplier ** i modulo 2**64 for i below n."""
    known = _powers.get(int(multiplier))
    if known is None or len(known) < n:
        size = 1 << max(12, n.bit_length())
        known = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, multiplier, "uint64")]), dtype="uint64")
        _powers[int(multiplier)] = known
    return known[:n]


def inverse(multiplier: np.uint64) -> np.uint64:
    return np.uint64(pow(int(multiplier), -1, 1 << 64))


class RangeHash:
    """Hashes of any ranges of one array of values."""

    def __init__(self, values: np.ndarray, multiplier: np.uint64):
        n = len(values)
        self.back = powers(inverse(multiplier), n + 1)
        self.sums = np.zeros(n + 1, "uint64")
        np.cumsum(values * powers(multiplier, n), out=self.sums[1:])

    def of(self, first: np.ndarray, length) -> np.ndarray:
        return (self.sums[first + length] - self.sums[first]) * self.back[first]


_SLICE = 1 << 19
#: Random values of bytes, one row for each of two independent hashes.
_BYTES = mixed(np.arange(1, 513, dtype="uint64") * LOW).reshape(2, 256)


def range_hashes(data: np.ndarray, first: np.ndarray, length: np.ndarray, lane: int) -> np.ndarray:
    """A hash of every range of bytes; ranges follow each other and are worked on half a megabyte at a time."""
    out = np.zeros(len(first), "uint64")
    cuts = np.searchsorted(first, np.arange(_SLICE, len(data) + _SLICE, _SLICE))
    low = 0
    for high in np.unique(np.append(cuts, len(first))).tolist():
        if high > low:
            begin, end = int(first[low]), int(first[high - 1] + length[high - 1])
            hashes = RangeHash(_BYTES[lane][data[begin:end]], LOW if lane else HIGH)
            out[low:high] = mixed(hashes.of(first[low:high] - begin, length[low:high]) + length[low:high].astype("uint64"))
            low = high
    return out
