"""The perfect binary Golay code of 23 bits, as tables for numpy.

Every word of 23 bits lies within three bits of exactly one codeword. A segment's index is the 12 data bits of that
codeword. Two words that differ in one bit or not at all share the index of one with the nearby indices of the other.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np

BITS, DATA = 23, 12
CHECK = BITS - DATA
#: Fixed value: generator polynomial x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011


@cache
def tables() -> tuple[np.ndarray, np.ndarray]:
    """Syndromes of all 23-bit words, and the error of at most three bits that each syndrome stands for."""
    powers = [1]
    for _ in range(BITS - 1):
        step = powers[-1] << 1
        powers.append(step ^ GENERATOR if step >> CHECK & 1 else step)
    syndromes = np.zeros(1, dtype=np.uint16)
    for power in powers:
        syndromes = np.concatenate([syndromes, syndromes ^ power])
    errors = np.zeros(1 << CHECK, dtype=np.uint32)
    for size in (3, 2, 1):
        for places in combinations(range(BITS), size):
            error = sum(1 << p for p in places)
            errors[syndromes[error]] = error
    errors[0] = 0
    return syndromes, errors


def index(words: np.ndarray) -> np.ndarray:
    """12-bit index of each word's codeword."""
    syndromes, errors = tables()
    return ((words ^ errors[syndromes[words]]) >> CHECK).astype(np.uint32)


def nearby(words: np.ndarray) -> np.ndarray:
    """Indices of each word and of its 23 one-bit neighbours, sorted by row; at most six differ."""
    flips = np.concatenate([[0], 1 << np.arange(BITS)]).astype(np.uint32)
    return np.sort(index(words[:, None] ^ flips[None, :]), axis=1)
