"""Hashes of any stretch of a byte buffer, from one pass over it."""

from __future__ import annotations

import numpy as np

_ODD, _SEED = 0x9E3779B97F4A7C15, 0xD1B54A32D192ED03
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one shuffle of 64-bit numbers (the finaliser of the public splitmix64 generator)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD) + np.uint64(_SEED))
_powers = {_BASE: np.ones(1, np.uint64), _INVERSE: np.ones(1, np.uint64)}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64; kept for the next call."""
    have = _powers[base]
    if len(have) < n:
        factors = np.full(max(n, 1 << 20), base, np.uint64)
        factors[0] = 1
        have = _powers[base] = np.cumprod(factors, dtype=np.uint64)
    return have[:n]


class PrefixHash:
    """Polynomial hashes over random byte values, modulo 2 ** 64: equal stretches have equal hashes wherever they stand.

    Instead of bytes, ``buf`` may hold the 64-bit hashes of larger units.
    """

    def __init__(self, buf: np.ndarray):
        self.sums = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum((_VALUES[buf] if buf.dtype == np.uint8 else buf) * _power(_BASE, len(buf)), dtype=np.uint64, out=self.sums[1:])
        self.inverse = _power(_INVERSE, len(buf) + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.inverse[start])

    def rolling(self, n: int) -> np.ndarray:
        """The hashes of all stretches of ``n`` bytes, in order."""
        return mixed((self.sums[n:] - self.sums[:-n]) * self.inverse[:len(self.sums) - n])
