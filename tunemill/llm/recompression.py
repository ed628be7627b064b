"""Recompression of token sequences: rounds that replace runs and pairs of symbols by new ones.

A name is a hash of what it stands for, so that tasks that never meet give equal names to equal runs
and pairs. Whether a symbol takes part in a pair depends on its own class and its neighbour's; both
follow from the names. So each symbol has a context, the stretch of words it is decided by: wherever
that stretch stands again, the same symbol stands in the same place of it, with the same context.
"""

from __future__ import annotations

import numpy as np

ROUNDS = 7
#: In these rounds runs are named before pairs. Each widens the contexts by both neighbours.
RUN_ROUNDS = (0,)
#: Stands after each document; takes part in nothing.
END = np.uint64(0)

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64 bits."""
    x = x ^ x >> np.uint64(32)
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ x >> np.uint64(29)
    x = x * _B
    return x ^ x >> np.uint64(32)


def _times(salt: int) -> np.uint64:
    return np.uint64(salt * int(_A) % (1 << 64))


def _named(left: np.ndarray, right: np.ndarray, salt: int) -> np.ndarray:
    return mixed(mixed(left + _times(salt)) + right * _B + _A) | np.uint64(1)


def _runs(symbols, low, high, salt):
    """Runs of two or more named by symbol and length; a run, also of one, ends where a neighbour differs."""
    n = len(symbols)
    first = np.ones(n, bool)
    first[1:] = (symbols[1:] != symbols[:-1]) | (symbols[1:] == END)
    starts = np.flatnonzero(first)
    ends = np.append(starts[1:], n) - 1
    # The symbols next to the run, not all of the runs that these are part of.
    before, after = np.maximum(starts - 1, 0), np.minimum(ends + 1, n - 1)
    wide_low = np.minimum(np.minimum.reduceat(low, starts), np.minimum(low[before], low[after]))
    wide_high = np.maximum(np.maximum.reduceat(high, starts), np.maximum(high[before], high[after]))
    symbols, lengths = symbols[starts], ends - starts + 1
    run = lengths > 1
    symbols[run] = _named(symbols[run], lengths[run].astype(np.uint64), 2 * salt + 1)
    return symbols, wide_low, wide_high


def _pairs(symbols, low, high, salt):
    """Pairs of a symbol of the left class and one of the right class after it."""
    side = (mixed(symbols + _times(salt + 1)) >> np.uint64(63)).astype(np.int8)
    side[symbols == END] = 2
    # Left symbols are decided by what follows, right ones by what stands before.
    left = np.flatnonzero(side[:-1] == 0)
    right = np.flatnonzero(side[1:] == 1) + 1
    wide_low, wide_high = low.copy(), high.copy()
    for at, other in ((left, left + 1), (right, right - 1)):
        wide_low[at] = np.minimum(low[at], low[other])
        wide_high[at] = np.maximum(high[at], high[other])
    heads = left[side[left + 1] == 1]
    named = symbols.copy()
    named[heads] = _named(symbols[heads], symbols[heads + 1], 2 * salt + 2)
    stays = np.ones(len(symbols), bool)
    stays[heads + 1] = False
    return named[stays], wide_low[stays], wide_high[stays]


def recompress(words: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols after `rounds`, and first and last word of each one's context.

    `words`: uint64 names of words, with END before and after each document. A context that
    reaches an END reaches past its document's words.
    """
    symbols = words
    low = np.arange(len(words), dtype=np.int64)
    high = low.copy()
    for salt in range(rounds):
        if salt in RUN_ROUNDS:
            symbols, low, high = _runs(symbols, low, high, salt)
        symbols, low, high = _pairs(symbols, low, high, salt)
    real = symbols != END
    return symbols[real], low[real], high[real]
