"""Elias-Fano encoding of a rising sequence of numbers, with constant-time access to any of them.

Of each number the low bits are stored as they are and the high part in unary: a bit vector with a one per number and
a zero per step of the high part. Sequences of n numbers up to u take about 2 + log2(u / n) bits each. The place of
every SAMPLE-th one is kept in 32 bits, so that the i-th number is found by looking at one stretch of the vector.
"""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 512
# Numbers whose low bits are packed at a time; a multiple of 8, so that parts end at whole bytes.
PART = 1 << 16
_HEAD = struct.Struct("<QBxxxxxxxQ")  # numbers, low bits, bytes of the high vector


def encode(values: np.ndarray) -> bytes:
    """Bytes of a rising sequence of unsigned 64-bit numbers; equal neighbours are allowed."""
    values = np.asarray(values, np.uint64)
    n = len(values)
    if n and (values[1:] < values[:-1]).any():
        raise ValueError("the numbers must not fall")
    low = max((int(values[-1]) // n).bit_length() - 1, 0) if n else 0
    ones = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
    if n and ones[-1] >= 2**32:
        raise ValueError("too many numbers for 32-bit places")
    high = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
    high[ones] = 1
    packed = np.packbits(high, bitorder="little").tobytes()
    bits = np.arange(low, dtype=np.uint64)
    parts = [
        np.packbits(((values[i : i + PART, None] >> bits) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little").tobytes()
        for i in range(0, n if low else 0, PART)
    ]
    return b"".join([_HEAD.pack(n, low, len(packed)), packed, ones[::SAMPLE].astype("<u4").tobytes(), *parts])


class Sequence:
    """Reads what `encode` has written, without unpacking all of it."""

    def __init__(self, raw: bytes):
        self.n, self.low, size = _HEAD.unpack_from(raw)
        at = _HEAD.size
        self.high = np.frombuffer(raw, np.uint8, size, at)
        self.samples = np.frombuffer(raw, "<u4", -(-self.n // SAMPLE), at + size)
        self.rest = np.frombuffer(raw, np.uint8, offset=at + size + 4 * len(self.samples))

    def __len__(self) -> int:
        return self.n

    def slice(self, first: int, last: int) -> np.ndarray:
        """Numbers first to before last."""
        if not 0 <= first <= last <= self.n:
            raise IndexError((first, last, self.n))
        if first == last:
            return np.zeros(0, np.uint64)
        sample, after = first // SAMPLE, -(-last // SAMPLE)
        begin = int(self.samples[sample]) // 8
        end = int(self.samples[after]) // 8 + 1 if after < len(self.samples) else len(self.high)
        ones = np.flatnonzero(np.unpackbits(self.high[begin:end], bitorder="little")) + begin * 8
        skip = int(np.searchsorted(ones, self.samples[sample])) + first - sample * SAMPLE
        high = (ones[skip : skip + last - first] - np.arange(first, last)).astype(np.uint64)
        if not self.low:
            return high
        a, b = first * self.low, last * self.low
        bits = np.unpackbits(self.rest[a // 8 : -(-b // 8)], bitorder="little")[a % 8 :][: b - a].reshape(-1, self.low)
        low = (bits.astype(np.uint64) << np.arange(self.low, dtype=np.uint64)).sum(1, dtype=np.uint64)
        return (high << np.uint64(self.low)) | low

    def select(self, i: int) -> int:
        """The i-th number."""
        return int(self.slice(i, i + 1)[0])
