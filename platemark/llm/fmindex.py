"""FM-index over a sequence of symbols: suffix array, wavelet ranks, sampled positions."""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix array of a sequence of small non-negative integers, by prefix doubling.

    After the first sort by several symbols at once only suffixes that are
    still tied are sorted again, by the rank of what follows them.
    """
    n = len(text)
    if n < 2:
        return np.arange(n)
    bits = max(1, int(text.max() + 1).bit_length())
    width = max(1, min(62 // bits, n))
    padded = np.concatenate((text.astype(np.int64) + 1, np.zeros(width, np.int64)))
    key = np.zeros(n, np.int64)
    for j in range(width):
        key = (key << bits) | padded[j : j + n]
    sa = np.argsort(key, kind="stable")
    rank = np.empty(n, np.int64)
    ordered = key[sa]
    heads = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    rank[sa] = np.maximum.accumulate(np.where(heads, np.arange(n), 0))
    step = width
    while True:
        start = np.flatnonzero(heads)
        size = np.diff(np.concatenate((start, [n])))
        tied = np.repeat(size > 1, size)
        at = np.flatnonzero(tied)
        if not len(at):
            return sa
        suffix = sa[at]
        follow = np.where(suffix + step < n, rank[np.minimum(suffix + step, n - 1)] + 1, 0)
        group = rank[suffix]
        by = np.lexsort((follow, group))
        suffix, follow, group = suffix[by], follow[by], group[by]
        sa[at] = suffix
        new = np.concatenate(([True], (group[1:] != group[:-1]) | (follow[1:] != follow[:-1])))
        heads[at] = new
        rank[suffix] = np.maximum.accumulate(np.where(new, at, 0))
        step *= 2


class WaveletRanks:
    """rank(symbol, i): how often a symbol occurs among the first i, by bit planes of a wavelet matrix."""

    def __init__(self, text: np.ndarray, symbols: int) -> None:
        self.levels = max(1, int(symbols - 1).bit_length()) if symbols > 1 else 1
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        now = text.astype(np.int64)
        for level in range(self.levels - 1, -1, -1):
            bit = (now >> level) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(bit, dtype=np.int32))).astype(np.int32))
            self.zeros.append(int(len(bit) - bit.sum()))
            now = np.concatenate((now[bit == 0], now[bit == 1]))

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Vectorised over pairs (symbol, i)."""
        low, high = np.zeros(len(symbol), np.int64), np.asarray(i, np.int64).copy()
        for level, ones, zeros in zip(range(self.levels - 1, -1, -1), self.ones, self.zeros, strict=True):
            bit = (symbol >> level) & 1
            low1, high1 = ones[low], ones[high]
            low = np.where(bit == 1, zeros + low1, low - low1)
            high = np.where(bit == 1, zeros + high1, high - high1)
        return high - low


class FMIndex:
    """Finds phrases in a sequence of symbols 1..symbols-1; 0 is kept for the end."""

    def __init__(self, text: np.ndarray, symbols: int, sample: int = 8) -> None:
        text = np.concatenate((np.asarray(text, np.int64), [0]))
        sa = suffix_array(text)
        self.bwt = text[sa - 1]
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=symbols))))[:symbols]
        self.count = np.bincount(text, minlength=symbols)
        self.ranks = WaveletRanks(self.bwt, symbols)
        sampled = sa % sample == 0
        self.sampled_rank = np.concatenate(([0], np.cumsum(sampled)))
        self.is_sampled = sampled
        self.positions = sa[sampled]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search of equally long phrases (one a row): the rows [low, high) of the suffix array."""
        symbol = phrases[:, -1]
        low = self.before[symbol].astype(np.int64)
        high = low + self.count[symbol]
        for column in range(phrases.shape[1] - 2, -1, -1):
            live = np.flatnonzero(low < high)
            s = phrases[live, column]
            base = self.before[s]
            low[live], high[live] = base + self.ranks.rank(s, low[live]), base + self.ranks.rank(s, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of suffix-array rows: steps back to the next sampled one."""
        rows = np.asarray(rows, np.int64).copy()
        out, steps = np.full(len(rows), -1, np.int64), np.zeros(len(rows), np.int64)
        live = np.arange(len(rows))
        while len(live):
            here = self.is_sampled[rows[live]]
            done = live[here]
            out[done] = self.positions[self.sampled_rank[rows[done]]] + steps[done]
            live = live[~here]
            s = self.bwt[rows[live]]
            rows[live] = self.before[s] + self.ranks.rank(s, rows[live])
            steps[live] += 1
        return out
