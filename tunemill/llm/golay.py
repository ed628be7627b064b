"""The binary Golay code of length 23: twelve message bits, any two code words seven or more bits apart.

The balls of radius three around the code words hold each 23-bit word exactly once. A word that
is three bits from its code word has five more code words at distance four, and a neighbour across the
border of the ball is listed under one of those. So two words that differ in one bit at most always
share one of the code words listed for them.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np

LENGTH = 23
# Fixed value: generator polynomial of the code.
GENERATOR = 0b101011100011


def syndromes(words: np.ndarray) -> np.ndarray:
    """Remainders by the generator, eleven bits each."""
    rest = words.astype(np.uint32)
    for bit in range(LENGTH - 1, 10, -1):
        rest = np.where(rest >> bit & 1, rest ^ np.uint32(GENERATOR << (bit - 11)), rest)
    return rest


def _patterns() -> np.ndarray:
    """By syndrome: the error of weight three or less, then the five of weight four (or the first again)."""
    table = np.zeros((2048, 6), np.uint32)
    for weight in range(4):
        errors = np.array([sum(1 << b for b in bits) for bits in combinations(range(LENGTH), weight)], np.uint32)
        table[syndromes(errors)] = errors[:, None]
    errors = np.array([sum(1 << b for b in bits) for bits in combinations(range(LENGTH), 4)], np.uint32)
    of = syndromes(errors)
    order = np.argsort(of, kind="stable")
    rank = np.arange(len(order)) % 5
    table[of[order], 1 + rank] = errors[order]
    return table


PATTERNS = _patterns()


def near_code_words(words: np.ndarray) -> np.ndarray:
    """Six message numbers (12 bits) for each word; fewer are padded by repeats."""
    corrected = words.astype(np.uint32)[:, None] ^ PATTERNS[syndromes(words)]
    return corrected >> 11
