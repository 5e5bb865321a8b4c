"""Elias-Fano code of a non-decreasing sequence, with constant-time select.

Each value is split: its low bits are stored as they are, its high part in
unary in a bit vector.  Together that is about ``2 + log2(last / n)`` bits a
value.  ``select`` finds the i-th set bit of the vector from a sample of every
``SAMPLE``-th one and the popcounts of the words that follow.
"""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 256
_HEAD = struct.Struct("<QqBQ")  # values, first value, low bits, words of the unary vector


class EliasFano:
    """Values are given relative to the first, which is stored apart (it may be negative)."""

    def __init__(self, n: int, base: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.base, self.low_bits, self.low, self.high, self.samples = n, base, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> "EliasFano":
        values = np.asarray(values, dtype=np.int64)
        n = len(values)
        if n and (values[1:] < values[:-1]).any():
            raise ValueError("values must not decrease")
        base = int(values[0]) if n else 0
        rel = values.view(np.uint64) - np.uint64(base % (1 << 64))
        low_bits = max(0, (int(rel[-1]) // n).bit_length() - 1) if n else 0
        ones = (rel >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros((int(ones[-1]) // 64 + 1) if n else 0, dtype="<u8")
        np.bitwise_or.at(high, ones // 64, np.uint64(1) << (ones % 64).astype(np.uint64))
        bits = rel[:, None] >> np.arange(low_bits, dtype=np.uint64) & np.uint64(1)
        low = np.packbits(bits.astype(np.uint8), bitorder="little")
        return cls(n, base, low_bits, low, high, ones[::SAMPLE].astype("<u4"))

    def to_bytes(self) -> bytes:
        return (_HEAD.pack(self.n, self.base, self.low_bits, len(self.high)) + self.low.tobytes()
                + self.high.tobytes() + self.samples.tobytes())

    @classmethod
    def from_bytes(cls, data: bytes) -> "EliasFano":
        n, base, low_bits, words = _HEAD.unpack_from(data)
        at = _HEAD.size
        low = np.frombuffer(data, np.uint8, -(-n * low_bits // 8), at)
        high = np.frombuffer(data, "<u8", words, at + len(low))
        samples = np.frombuffer(data, "<u4", -(-n // SAMPLE), at + len(low) + 8 * words)
        return cls(n, base, low_bits, low, high, samples)

    def _low(self, i: int) -> int:
        a, b = i * self.low_bits, (i + 1) * self.low_bits
        piece = int.from_bytes(self.low[a // 8:-(-b // 8)].tobytes(), "little")
        return piece >> a % 8 & (1 << self.low_bits) - 1

    def select(self, i: int) -> int:
        """The i-th value."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, rank = int(self.samples[i // SAMPLE]), i % SAMPLE  # pass over ``rank`` ones from ``at``
        word = at // 64
        left = int(self.high[word]) >> at % 64 << at % 64
        while (ones := left.bit_count()) <= rank:
            rank -= ones
            word += 1
            left = int(self.high[word])
        for _ in range(rank):
            left &= left - 1
        one = word * 64 + (left & -left).bit_length() - 1
        return self.base + ((one - i) << self.low_bits | self._low(i))

    def values(self) -> np.ndarray:
        """All values at once."""
        ones = np.flatnonzero(np.unpackbits(self.high.view(np.uint8), bitorder="little"))[:self.n]
        rel = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        bits = np.unpackbits(self.low, bitorder="little")[:self.n * self.low_bits].reshape(self.n, self.low_bits)
        for j in range(self.low_bits):
            rel |= bits[:, j].astype(np.uint64) << np.uint64(j)
        return (rel + np.uint64(self.base % (1 << 64))).view(np.int64)
