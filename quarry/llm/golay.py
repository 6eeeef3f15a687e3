"""Codeword indices of the binary Golay code (23, 12, 7).

Every 23-bit word lies within three bits of exactly one codeword, its home; the
home's 12 message bits are the word's index. Words that differ in two bits have
a word between them, one bit from both, so the index sets {home of the word and
of its one-bit neighbours} of the two share an index. Words one bit apart differ
in parity, and the home of the one is in the set of the other.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np

BITS, CHECK_BITS = 23, 11
GENERATOR = 0b110001110101  # fixed value: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1


def _remainder(word: int) -> int:
    for bit in range(BITS - 1, CHECK_BITS - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - CHECK_BITS)
    return word


@lru_cache(maxsize=1)
def _tables() -> tuple[list[np.ndarray], np.ndarray]:
    """Syndromes by byte of the word, and the error of up to three bits by syndrome."""
    single = [_remainder(1 << i) for i in range(BITS)]
    by_byte = []
    for k in range(3):
        t = np.zeros(256, dtype=np.int32)
        for i in range(8 * k, min(8 * k + 8, BITS)):
            t[(np.arange(256) >> (i - 8 * k)) & 1 == 1] ^= single[i]
        by_byte.append(t)
    error = np.zeros(1 << CHECK_BITS, dtype=np.int32)
    for n in (1, 2, 3):
        for bits in combinations(range(BITS), n):
            syndrome = 0
            for i in bits:
                syndrome ^= single[i]
            error[syndrome] = sum(1 << i for i in bits)
    return by_byte, error


def home(words: np.ndarray) -> np.ndarray:
    """Index of the codeword nearest to each 23-bit word."""
    (a, b, c), error = _tables()
    return (words ^ error[a[words & 255] ^ b[words >> 8 & 255] ^ c[words >> 16 & 255]]) >> CHECK_BITS


def near(words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices of each word and its one-bit neighbours in the low ``width`` bits:
    all index sets one after the other, and the size of each."""
    around = np.stack([home(words), *(home(words ^ (1 << i)) for i in range(width))], axis=1)
    around.sort(axis=1)
    first = np.ones(around.shape, dtype=bool)
    first[:, 1:] = around[:, 1:] != around[:, :-1]
    return around[first], first.sum(axis=1)
