"""Vectorised 64-bit hashing of byte ranges, shared by the text operators.

A polynomial hash over random byte values, kept as prefix sums modulo 2^64, so
that the hash of any byte range costs two look-ups and one product.
"""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: list[np.ndarray] = []
#: 64-bit value of each byte, from a fixed seed.
BYTE_VALUE = np.random.default_rng(20240229).integers(1, 2 ** 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, at least ``n`` each."""
    if not _POWERS or len(_POWERS[0]) < n:
        n = max(n, 1 << 16)
        inverse = pow(_BASE, -1, 1 << 64)
        _POWERS[:] = [np.cumprod(np.concatenate(([np.uint64(1)], np.full(n - 1, np.uint64(b)))), dtype=np.uint64)
                      for b in (_BASE, inverse)]
    return _POWERS[0], _POWERS[1]


class Prefix:
    """Prefix sums of a byte array; ``ranges(a, b)`` are the hashes of [a, b)."""

    def __init__(self, data: np.ndarray):
        power, self.inverse = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTE_VALUE[data] * power[:len(data)], out=self.sums[1:])

    def ranges(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (self.sums[b] - self.sums[a]) * self.inverse[a]

    def all_of(self, size: int) -> np.ndarray:
        """Hash of every range of ``size`` bytes, by start."""
        n = len(self.sums) - size
        return (self.sums[size:] - self.sums[:-size]) * self.inverse[:n] if n > 0 else np.zeros(0, np.uint64)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by start."""
    done = 1
    while 2 * done <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    return np.minimum(x[:len(x) - (width - done)], x[width - done:]) if done < width else x


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
