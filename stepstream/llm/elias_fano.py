"""Rising integers in near-minimal space, with access to any one of them."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

EVERY = 64  # one sampled position per so many values


class EliasFano(NamedTuple):
    """``count`` integers up to ``limit`` that never fall.

    Each value is split: its ``width`` low bits stand packed in ``low``; the rest is in
    ``high``, where the bit at (rest + index) is set. ``samples`` has where in ``high`` each
    64th set bit is, so :meth:`select` reads a few bytes only. All take about
    2 + log2(limit / count) bits a value.
    """

    count: int
    limit: int
    width: int
    low: bytes
    high: bytes
    samples: bytes

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.int64)
        count, limit = len(values), int(values[-1]) if len(values) else 0
        width = max(0, (limit // count).bit_length() - 1) if count else 0
        index = np.arange(count)
        at = (values >> width) + index
        marks = np.zeros((limit >> width) + count + 1, dtype=np.uint8)
        marks[at] = 1
        low = (values[:, None] >> np.arange(width)) & 1
        samples = at[::EVERY].astype("<u4").tobytes()
        return cls(count, limit, width, _packed(low.ravel()), _packed(marks), samples)

    def all(self) -> np.ndarray:
        index = np.arange(self.count)
        high = np.flatnonzero(_bits(self.high))[: self.count] - index
        return (high << self.width) | self._low(0, self.count)

    def select(self, index: int) -> int:
        """The value at ``index``."""
        if not 0 <= index < self.count:
            raise IndexError(index)
        start = int(np.frombuffer(self.samples, "<u4")[index // EVERY])
        wanted, byte, seen = index % EVERY, start // 8, -1
        skip = start % 8
        while True:
            bits = np.flatnonzero(_bits(self.high[byte : byte + EVERY]))
            bits = bits[bits >= skip]
            if seen + len(bits) >= wanted:
                at = byte * 8 + int(bits[wanted - seen - 1])
                return ((at - index) << self.width) | int(self._low(index, 1)[0])
            seen, byte, skip = seen + len(bits), byte + EVERY, 0

    def _low(self, start, count):
        if not self.width:
            return np.zeros(count, dtype=np.int64)
        first = start * self.width
        data = _bits(self.low[first // 8 : (first + count * self.width + 7) // 8])
        data = data[first % 8 : first % 8 + count * self.width].reshape(count, self.width)
        return data.astype(np.int64) @ (1 << np.arange(self.width, dtype=np.int64))


def _packed(bits):
    return np.packbits(bits.astype(np.uint8), bitorder="little").tobytes()


def _bits(data):
    return np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little")
