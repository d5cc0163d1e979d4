"""Polynomial hashes of any slice of a byte string, for many slices at once.

Modulo 2**64 with an odd base: a prefix hash is a running sum, a slice's hash a difference times the
inverse power of where it starts. Slices with equal bytes have equal hashes; callers compare bytes
where more than a candidate is needed.
"""

from __future__ import annotations

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
MIX = np.uint64(0xD6E8FEB86659FD93)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
# Each byte value gets 64 random-looking bits, by the same mixing as below.
byte_values = (np.arange(1, 257, dtype=np.uint64) * MIX) ^ np.uint64(0x632BE59BD9B4E019)
byte_values = (byte_values ^ (byte_values >> np.uint64(32))) * MIX


def powers_for(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        for i, b in enumerate((BASE, INVERSE)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            _powers[i] = np.multiply.accumulate(p)
    return _powers[0], _powers[1]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread over all bits, as the low bits of a product modulo 2**64 are poor."""
    h = (h ^ (h >> np.uint64(32))) * MIX
    h = (h ^ (h >> np.uint64(29))) * BASE
    return h ^ (h >> np.uint64(32))


class Slices:
    """Hashes of slices of one byte string."""

    def __init__(self, raw: bytes | np.ndarray):
        data = np.frombuffer(raw, np.uint8) if isinstance(raw, bytes) else raw
        powers, self._inverse = powers_for(len(data) + 1)
        self.prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(byte_values[data] * powers[: len(data)], out=self.prefix[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.prefix[ends] - self.prefix[starts]) * self._inverse[starts])


def words_of(raw: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words joined by one space, and where each starts and ends in that."""
    joined = b" ".join(raw.split())  # bytes.split() parts at exactly space and \\x09 to \\x0d
    if not joined:
        none = np.zeros(0, np.int64)
        return joined, none, none
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = np.concatenate(([0], gaps + 1))
    return joined, starts, np.append(gaps, len(joined))
