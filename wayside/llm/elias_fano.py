"""Elias-Fano code of an ascending sequence, with a structure to select any element."""

from __future__ import annotations

import numpy as np

#: Every so many elements the position of its bit is kept.
SAMPLE = 256


class EliasFano:
    """n ascending numbers below a universe U in about n * (2 + log2(U / n)) bits.

    The low bits stand side by side, the high bits in unary: element i sets bit
    (value >> low) + i. Selecting element i starts at the sample before it.
    """

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: bytes):
        self.n, self.low_bits = n, low_bits
        self.low, self.high, self.samples = low, high, samples

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        universe = int(values[-1]) + 1 if n else 1
        low_bits = max(0, (universe // max(n, 1)).bit_length() - 1)
        values = values.astype(np.uint64)
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits((values[:, None] >> shifts & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        at = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(at[-1]) + 1 if n else 0, np.uint8)
        bits[at] = 1
        high = np.packbits(bits, bitorder="little")
        return cls(n, low_bits, low.tobytes(), high.tobytes(), at[::SAMPLE].astype("<u4").tobytes())

    def _low(self, first: int, last: int) -> np.ndarray:
        a, b = first * self.low_bits, last * self.low_bits
        raw = np.frombuffer(self.low, np.uint8)[a // 8 : -(-b // 8)]
        bits = np.unpackbits(raw, bitorder="little")[a % 8 : a % 8 + b - a].reshape(last - first, self.low_bits)
        return bits.astype(np.int64) @ (1 << np.arange(self.low_bits, dtype=np.int64))

    def values(self) -> np.ndarray:
        at = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little"))
        return (at - np.arange(self.n) << self.low_bits) + self._low(0, self.n)

    def select(self, i: int) -> int:
        """Element i, from its sample on."""
        sample = i // SAMPLE
        start = int(np.frombuffer(self.samples, "<u4")[sample])
        left, at, size = i - sample * SAMPLE, start // 8, 1024
        raw = np.frombuffer(self.high, np.uint8)
        while True:
            set_bits = np.flatnonzero(np.unpackbits(raw[at : at + size], bitorder="little")) + at * 8
            set_bits = set_bits[set_bits >= start]
            if len(set_bits) > left:
                high = int(set_bits[left]) - i
                return (high << self.low_bits) + int(self._low(i, i + 1)[0])
            size *= 2
