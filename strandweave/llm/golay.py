"""The perfect binary Golay code of length 23: nearest codewords of many words at once."""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np

#: Fixed value: the code's generator polynomial, x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101


def remainder(word: int) -> int:
    for bit in range(22, 10, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - 11)
    return word


@lru_cache(maxsize=1)
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Remainders of the low 12 and of the high 11 bits, and the error of weight 3 or less of each remainder."""
    low = np.array([remainder(x) for x in range(1 << 12)], dtype=np.int32)
    high = np.array([remainder(x << 12) for x in range(1 << 11)], dtype=np.int32)
    error = np.zeros(1 << 11, dtype=np.int32)
    for weight in (1, 2, 3):
        for bits in combinations(range(23), weight):
            word = sum(1 << b for b in bits)
            error[remainder(word)] = word
    return low, high, error


def nearest(words: np.ndarray) -> np.ndarray:
    """Index (12 bits) of the one codeword within 3 bits of each 23-bit word."""
    low, high, error = tables()
    words = words.astype(np.int32, copy=False)
    return (words ^ error[low[words & 0xFFF] ^ high[words >> 12]]) >> 11


def around(words: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Codewords nearest to each word or to a word one of its low ``bits`` away: (row of the word, index), distinct.

    A word has one or six of them: those within distance 4. Words at most one bit apart thus share the codeword
    nearest to either.
    """
    flips = np.concatenate([[0], 1 << np.arange(bits)]).astype(np.int32)
    found = np.sort(nearest(words.astype(np.int32)[:, None] ^ flips[None, :]), axis=1)
    first = np.ones(found.shape, dtype=bool)
    first[:, 1:] = found[:, 1:] != found[:, :-1]
    row, col = np.nonzero(first)
    return row, found[row, col]
