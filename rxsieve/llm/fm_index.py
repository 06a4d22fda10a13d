"""FM-index over a sequence of symbols: backward search by wavelet ranks, places by sampled suffix positions.

All searches run over arrays of patterns at once.
"""

from __future__ import annotations

import numpy as np

#: Every so many positions the suffix array is kept; a search walks back fewer steps than this.
SAMPLE_EVERY = 16


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of all suffixes. 0 is a separator, and each separator differs from the others, least first; the last symbol is one.

    Prefix doubling, in which only suffixes that still tie are sorted again.
    """
    separator = symbols == 0
    rank = np.where(separator, np.cumsum(separator) - 1, symbols.astype(np.int64) + np.count_nonzero(separator))
    order = np.argsort(rank, kind="stable")
    ranked = rank[order]
    head = np.append(True, ranked[1:] != ranked[:-1])
    group = np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))
    rank[order] = group
    tied = np.flatnonzero(~(head & np.append(head[1:], True)))
    depth = 1
    while len(tied):
        at = order[tied]
        first, second = rank[at], rank[at + depth]
        by = np.lexsort((second, first))
        at, first, second = at[by], first[by], second[by]
        order[tied] = at
        head = np.append(True, (first[1:] != first[:-1]) | (second[1:] != second[:-1]))
        rank[at] = tied[np.maximum.accumulate(np.where(head, np.arange(len(at)), 0))]
        tied = tied[~(head & np.append(head[1:], True))]
        depth *= 2
    return order


class WaveletMatrix:
    """Number of a symbol's occurrences before a place, for arrays of symbols and places."""

    def __init__(self, symbols: np.ndarray):
        self.levels = max(1, int(symbols.max()).bit_length())
        self.ones: list[np.ndarray] = []
        for level in reversed(range(self.levels)):
            bit = (symbols >> level & 1).astype(bool)
            self.ones.append(np.concatenate([[0], np.cumsum(bit, dtype=np.int32)]).astype(np.int32))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        start = np.zeros_like(place)
        for level, ones in zip(reversed(range(self.levels)), self.ones, strict=True):
            bit = (symbol >> level & 1).astype(bool)
            zeros = len(ones) - 1 - ones[-1]
            start = np.where(bit, zeros + ones[start], start - ones[start])
            place = np.where(bit, zeros + ones[place], place - ones[place])
        return place - start


class FMIndex:
    def __init__(self, symbols: np.ndarray):
        order = suffix_array(symbols)
        self.last = symbols[order - 1]  # the symbol before each suffix; a separator before the first
        self.before = np.concatenate([[0], np.cumsum(np.bincount(symbols))])  # symbols less than each
        self.tree = WaveletMatrix(self.last)
        kept = (order % SAMPLE_EVERY == 0) | (self.last == 0)
        self.sampled = kept
        self.sample_of = np.cumsum(kept) - 1
        self.samples = order[kept]

    def _back(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        return self.before[symbol] + self.tree.rank(symbol, row)

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the suffixes that begin with each pattern (a row of symbols), as first and end."""
        known = (patterns < len(self.before) - 1).all(1)
        first, end = np.zeros(len(patterns), np.int64), np.zeros(len(patterns), np.int64)
        alive = np.flatnonzero(known)
        symbol = patterns[alive, -1]
        first[alive], end[alive] = self.before[symbol], self.before[symbol + 1]
        for k in reversed(range(patterns.shape[1] - 1)):
            alive = alive[first[alive] < end[alive]]
            symbol = patterns[alive, k]
            first[alive], end[alive] = self._back(symbol, first[alive]), self._back(symbol, end[alive])
        return first, np.maximum(first, end)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Position in the sequence of each row's suffix."""
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        walking = np.flatnonzero(~self.sampled[rows])
        while len(walking):
            rows[walking] = self._back(self.last[rows[walking]], rows[walking])
            steps[walking] += 1
            walking = walking[~self.sampled[rows[walking]]]
        return self.samples[self.sample_of[rows]] + steps
