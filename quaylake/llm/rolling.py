"""Polynomial hashes of all substrings of a length, by prefix sums."""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(BASE, -1, 1 << 64)
_M = np.uint64(0xD6E8FEB86659FD93)
_S = np.uint64(32)


class Powers:
    """Powers of the polynomial base and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, 2 * len(self.up), 1 << 14)
            self.up = np.ones(size, np.uint64)
            self.down = np.ones(size, np.uint64)
            np.cumprod(np.full(size - 1, BASE, np.uint64), out=self.up[1:])
            np.cumprod(np.full(size - 1, _INVERSE, np.uint64), out=self.down[1:])
        return self.up[:n], self.down[:n]


POWERS = Powers()


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _S)) * _M
    return h ^ (h >> _S)


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Sums S with S[j] - S[i] the polynomial of values[i:j] times base**i."""
    n = len(values)
    up, _ = POWERS.get(n + 1)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    return sums


def hashes(sums: np.ndarray, starts: np.ndarray | slice, ends: np.ndarray | slice) -> np.ndarray:
    """Mixed hashes of the substrings from starts to ends."""
    _, down = POWERS.get(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts])
