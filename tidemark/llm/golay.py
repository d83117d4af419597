"""The binary Golay code of length 23: every word lies within 3 bits of exactly one codeword."""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np

LENGTH, CHECK_BITS = 23, 11
# Fixed value: generator polynomial x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101


def _remainder(word: int) -> int:
    for bit in range(LENGTH - 1, CHECK_BITS - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - CHECK_BITS)
    return word


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and high 11 bits, and the error pattern of each syndrome."""
    low = np.array([_remainder(w) for w in range(1 << 12)], dtype=np.int64)
    high = np.array([_remainder(w << 12) for w in range(1 << 11)], dtype=np.int64)
    errors = np.zeros(1 << CHECK_BITS, dtype=np.int64)
    for weight in range(4):
        for bits in combinations(range(LENGTH), weight):
            pattern = sum(1 << b for b in bits)
            errors[low[pattern & 0xFFF] ^ high[pattern >> 12]] = pattern
    return low, high, errors


def codeword_index(words: np.ndarray) -> np.ndarray:
    """The 12-bit index of the codeword nearest to each 23-bit word."""
    low, high, errors = _tables()
    words = words.astype(np.int64)
    return (words ^ errors[low[words & 0xFFF] ^ high[words >> 12]]) >> CHECK_BITS


def nearby_indices(words: np.ndarray, width: int) -> np.ndarray:
    """Per word, the codeword indices of the word itself and of its ``width`` single-bit flips.

    Two words that differ in at most one of those bits share the index of the first with this
    set of the second; two that differ in two bits share an index between their sets.
    """
    flips = np.concatenate([[0], 1 << np.arange(width)]).astype(np.int64)
    return codeword_index(words.astype(np.int64)[:, None] ^ flips[None, :])
