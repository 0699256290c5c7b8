"""Minimal perfect hashing of a set of numbers, built shard by shard.

A key's hash names its shard. In a shard, every level is a bit vector of about SPARE bits per key that is left: keys
that hash to a place of their own set its bit, the others go on to the next level. The number of ones before a key's
bit is its slot, so that n keys get the slots 0 to n - 1 of a dense vector. A key that was not in the set may get any
slot: the keys themselves are kept by slot, and a look-up compares.
"""

from __future__ import annotations

import numpy as np

from tradelake.llm.hashing import mix

SHARD_BITS = 10
SHARDS = 1 << SHARD_BITS
SPARE = 1.5
_STEP = 0x9E3779B97F4A7C15


def shard_of(keys: np.ndarray) -> np.ndarray:
    return (mix(keys) >> np.uint64(64 - SHARD_BITS)).astype(np.int64)


def _hash(keys: np.ndarray, level: int) -> np.ndarray:
    return mix(keys + np.uint64(_STEP * (level + 1) % 2**64))


def build(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bits of each level, the bit vectors one after another as 64-bit words, and the keys by slot, of distinct keys."""
    sizes, words, placed, left = [], [], [], keys
    while len(left):
        size = 64 * (int(len(left) * SPARE) // 64 + 1)
        at = (_hash(left, len(sizes)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        own = alone[at]
        placed.append(left[own][np.argsort(at[own])])
        words.append(np.packbits(alone, bitorder="little").view("<u8"))
        sizes.append(size)
        left = left[~own]
    joined = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return np.array(sizes, np.uint32), joined(words), joined(placed)


class Table:
    """Slots of keys, from the shards `first` on in order, each as `build` has given it."""

    def __init__(self, shards: list[tuple[np.ndarray, np.ndarray, np.ndarray]], first: int = 0):
        levels = max((len(sizes) for sizes, _, _ in shards), default=0)
        self.first, self.last = first, first + len(shards)
        self.size = np.zeros((levels, len(shards)), np.uint64)
        for i, (sizes, _, _) in enumerate(shards):
            self.size[: len(sizes), i] = sizes
        # Where each level of each shard begins: level after level within a shard, shard after shard.
        total = np.concatenate([[0], np.cumsum(self.size.T.ravel())]).astype(np.uint64)
        self.at = total[:-1].reshape(len(shards), levels).T if levels else self.size
        empty = np.zeros(0, np.uint64)
        self.words = np.concatenate([empty, *[words for _, words, _ in shards]]).astype(np.uint64)
        self.rank = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.uint32)]).astype(np.uint32)
        self.keys = np.concatenate([k for _, _, k in shards]) if shards else empty

    def look_up(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the keys belong to these shards, and the slots of those. Fails on a key that is not in the set."""
        shard = shard_of(keys)
        mine = np.flatnonzero((shard >= self.first) & (shard < self.last))
        keys, shard = keys[mine], shard[mine] - self.first
        slots, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level in range(len(self.size)):
            if not len(left):
                break
            of = shard[left]
            size = self.size[level, of]
            left, of, size = left[size > 0], of[size > 0], size[size > 0]
            at = self.at[level, of] + _hash(keys[left], level) % size
            word, bit = self.words[at >> np.uint64(6)], np.uint64(1) << (at & np.uint64(63))
            hit = (word & bit) != 0
            slots[left[hit]] = self.rank[at[hit] >> np.uint64(6)] + np.bitwise_count(word[hit] & (bit[hit] - np.uint64(1)))
            left = left[~hit]
        if (slots < 0).any() or (self.keys[slots] != keys).any():
            raise KeyError("a key that was not hashed")
        return mine, slots
