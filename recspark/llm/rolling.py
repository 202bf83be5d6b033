"""Hashes of all fixed-length byte strings of a buffer, with array operations."""

from __future__ import annotations

import numpy as np

_A = 0x9E3779B97F4A7C15
_B = 0xC2B2AE3D27D4EB4F
_WRAP = (1 << 64) - 1


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (finaliser of a public hash family)."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(29)
    return h


class Rolling:
    """Polynomial hashes modulo 2**64 by doubling: the hash of a string of a + b items is
    hash(first a) * base**b + hash(next b)."""

    def __init__(self, items: np.ndarray, second: bool = False):
        base = _B if second else _A
        self.n, self.powers = len(items), {1: base}
        self.by = {1: items.astype(np.uint64) + np.uint64(1)}

    def _double(self, k: int) -> np.ndarray:
        if k not in self.by:
            half = self._double(k // 2)
            self.powers[k] = self.powers[k // 2] ** 2 & _WRAP
            self.by[k] = half[:-(k // 2)] * np.uint64(self.powers[k // 2]) + half[k // 2:]
        return self.by[k]

    def of(self, length: int) -> np.ndarray:
        """Scrambled hash of items[i:i + length] for every i that has so many."""
        out, done, m = None, 0, self.n - length + 1
        if m <= 0:
            return np.zeros(0, np.uint64)
        for bit in reversed(range(length.bit_length())):
            k = 1 << bit
            if length & k:
                part = self._double(k)
                out = part[:m] if out is None else out * np.uint64(self.powers[k]) + part[done:done + m]
                done += k
        return mix(out)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of x[i:i + width] for every i that has so many."""
    m, k = x, 1
    while k * 2 <= width:
        m = np.minimum(m[:-k], m[k:])
        k *= 2
    n = len(x) - width + 1
    return np.minimum(m[:n], m[width - k:width - k + n])
