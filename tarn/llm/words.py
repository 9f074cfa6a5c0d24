"""Words of texts as arrays of hashes.

A word is a run of bytes other than space and \\t to \\r, which is what ``bytes.split`` gives.
"""

from __future__ import annotations

import numpy as np
import xxhash

#: Words remembered by a worker; the table is emptied beyond that.
MEMO = 200_000
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
#: Base of the rolling sums: odd, so that it has an inverse modulo 2**64.
BASE = 0xD1342543DE82EF95


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > MEMO:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _B
    return h ^ (h >> np.uint64(29))


def pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A hash of two hashes, order-sensitive."""
    return mix(left * _A + right)


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each ``size`` consecutive word hashes, put together from stretches of 1, 2, 4, ... words."""
    out, width, power, power_width, rest = None, 0, hashes, 1, size
    while rest:
        if rest & 1:
            n = max(0, len(hashes) - width - power_width + 1)
            out = power if out is None else pair(out[:n], power[width : width + n])
            width += power_width
        rest >>= 1
        if rest:
            n = max(0, len(power) - power_width)
            power, power_width = pair(power[:n], power[power_width : power_width + n]), power_width * 2
    return out


class Rolling:
    """Hashes of any stretches of a hash array, from sums modulo 2**64."""

    def __init__(self, values: np.ndarray) -> None:
        n = len(values)
        power = np.full(n, BASE, np.uint64)
        back = np.full(n, pow(BASE, -1, 1 << 64), np.uint64)
        if n:
            power[0] = back[0] = 1
        with np.errstate(over="ignore"):
            self.back = np.multiply.accumulate(back)
            self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(values) * np.multiply.accumulate(power), dtype=np.uint64)))

    def hash(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((self.sums[stop] - self.sums[start]) * self.back[start] + (stop - start).astype(np.uint64))


def spans(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, end) of consecutive stretches."""
    ends = np.cumsum(lengths)
    return ends - lengths, ends
