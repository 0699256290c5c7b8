"""Hashes of all stretches of a byte string at once, equal in every process."""

from __future__ import annotations

import numpy as np

_RANDOM = np.random.default_rng(7)
_BYTE = _RANDOM.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse modulo 2^64."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Prefix:
    """Sums of bytes times powers of a base, from which the hash of any stretch follows."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers_to(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * up[: len(data)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts])

    def windows(self, size: int, first: int = 0, last: int | None = None) -> np.ndarray:
        """Hashes of all stretches of `size` bytes that start from `first` to before `last`."""
        stop = len(self.sums) - size if last is None else last
        return mix((self.sums[first + size : stop + size] - self.sums[first:stop]) * self.down[first:stop])


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def word_hashes(raw: bytes) -> np.ndarray:
    """Hash of each word of a text, words being what stands between white space."""
    if not raw:
        return np.zeros(0, np.uint64)
    data = np.frombuffer(raw, np.uint8)
    inside = np.concatenate([[False], ~_SPACE[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return Prefix(data).of(edges[::2], edges[1::2])
