"""The perfect binary Golay code of length 23 as a hash of nearby bit strings.

Every 23-bit string lies within three flips of exactly one of 4,096 codewords. The keys of a string
are the codewords of the string itself and of all strings one flip away: one key or six. Two strings
that differ in one or two bits have a string at most one flip from both, so they share a key.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np

LENGTH, CHECK_BITS, CORRECTED = 23, 11, 3
GENERATOR = 0xC75  # fixed value: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1


def _remainder(value: int) -> int:
    for bit in range(LENGTH - 1, CHECK_BITS - 1, -1):
        if value >> bit & 1:
            value ^= GENERATOR << (bit - CHECK_BITS)
    return value


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Remainder of each single bit, and the error pattern that belongs to each remainder."""
    single = np.array([_remainder(1 << bit) for bit in range(LENGTH)], dtype=np.uint32)
    errors = np.zeros(1 << CHECK_BITS, dtype=np.uint32)
    for weight in range(1, CORRECTED + 1):
        for bits in combinations(range(LENGTH), weight):
            errors[np.bitwise_xor.reduce(single[list(bits)])] = sum(1 << bit for bit in bits)
    return single, errors


def codeword_index(values: np.ndarray) -> np.ndarray:
    """Number of the codeword nearest to each 23-bit value."""
    single, errors = _tables()
    values = values.astype(np.uint32)
    remainder = np.zeros_like(values)
    for bit in range(LENGTH):
        remainder ^= (values >> np.uint32(bit) & np.uint32(1)) * single[bit]
    return (values ^ errors[remainder]) >> np.uint32(CHECK_BITS)


def keys(values: np.ndarray, width: int) -> np.ndarray:
    """Keys of values of ``width`` bits, one row each, sorted; a repeated key marks an empty place."""
    flips = np.array([0, *(1 << bit for bit in range(width))], dtype=np.uint32)
    return np.sort(codeword_index(values.astype(np.uint32)[:, None] ^ flips), axis=1)
