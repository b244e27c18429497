"""Hashes of many stretches of one byte buffer at once."""

from __future__ import annotations

import numpy as np

_rng = np.random.Generator(np.random.PCG64(20240229))
#: Two families: a random 64-bit value per byte, and an odd base.
TABLES = [_rng.integers(0, 1 << 64, 256, dtype=np.uint64) for _ in range(2)]
BASES = [np.uint64(int(x) * 8 + 5 & (1 << 64) - 1) for x in _rng.integers(0, 1 << 61, 2, dtype=np.uint64)]
INVERSES = [np.uint64(pow(int(b), -1, 1 << 64)) for b in BASES]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


class Rolling:
    """Of ``buffer`` (uint8), hashes of any stretches in constant time each: equal bytes, equal hash."""

    def __init__(self, buffer: np.ndarray, family: int = 0) -> None:
        n = len(buffer)
        with np.errstate(over="ignore"):
            self.sums = np.zeros(n + 1, np.uint64)
            np.cumsum(TABLES[family][buffer] * _powers(INVERSES[family], n), out=self.sums[1:])
        self.powers = _powers(BASES[family], n + 1)

    def hashes(self, starts: np.ndarray, sizes: np.ndarray | int) -> np.ndarray:
        with np.errstate(over="ignore"):
            raw = (self.sums[starts + sizes] - self.sums[starts]) * self.powers[starts]
            return mix(raw + np.asarray(sizes, np.uint64) * np.uint64(0x9E3779B97F4A7C15))
