"""Fuzzy keys from the perfect binary Golay code (23, 12, 7).

Every 23-bit word lies within 3 bits of exactly one of the 4096 codewords.
The *near indices* of a word are those of all codewords within 4 bits: one, or
six when the nearest is 3 bits away.  Two words that differ in at most 2 bits
always share a near index: a word between them differs from each in at most
one bit, and its nearest codeword is within 4 bits of both.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np

BITS, INDEX_BITS = 23, 12
#: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
GENERATOR = 0b101011100011
NEAR = 6


def _remainder(word: int) -> int:
    for shift in range(BITS - 12, -1, -1):
        if word >> (shift + 11) & 1:
            word ^= GENERATOR << shift
    return word


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Syndromes of single bits; for each of the 2048 syndromes the error
    patterns of weight 4 or less that have it, -1 where there are fewer."""
    bit = np.array([_remainder(1 << i) for i in range(BITS)], dtype=np.int32)
    patterns = np.full((2048, NEAR), -1, dtype=np.int32)
    found = np.zeros(2048, dtype=np.int64)
    for weight in range(5):
        for places in combinations(range(BITS), weight):
            syndrome = 0
            for i in places:
                syndrome ^= int(bit[i])
            patterns[syndrome, found[syndrome]] = sum(1 << i for i in places)
            found[syndrome] += 1
    return bit, patterns


def near_indices(words: np.ndarray) -> np.ndarray:
    """(n, 6) codeword indices near each 23-bit word; -1 fills the rest."""
    bit, patterns = _tables()
    words = words.astype(np.int32)
    syndrome = np.zeros(len(words), dtype=np.int32)
    for i in range(BITS):
        syndrome ^= (words >> i & 1) * bit[i]
    errors = patterns[syndrome]
    return np.where(errors < 0, -1, (words[:, None] ^ errors) >> 11)
