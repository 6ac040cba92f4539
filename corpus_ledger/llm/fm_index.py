"""Full-text index of one shard: suffix order, Burrows-Wheeler transform, wavelet ranks, sampled positions."""

from __future__ import annotations

import numpy as np


def suffix_order(symbols: np.ndarray, depth: int | None = None) -> np.ndarray:
    """Suffixes in order, by prefix doubling; with ``depth``, by their first ``depth`` symbols at least.

    The end sorts below every symbol, so symbols must be positive.
    """
    n = len(symbols)
    rank, width = np.unique(symbols, return_inverse=True)[1].astype(np.int64) + 1, 1
    order = np.argsort(rank, kind="stable")
    while n and rank[order[-1]] < n and width < (n if depth is None else depth):
        key = rank * (n + 1)
        key[: n - width] += rank[width:]
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[1], 1 + np.cumsum(ordered[1:] != ordered[:-1])])
        width *= 2
    return order


class WaveletMatrix:
    """Ranks and access over a sequence of small non-negative integers, for arrays of queries."""

    def __init__(self, sequence: np.ndarray, largest: int):
        self.n = len(sequence)
        self.levels = range(max(1, int(largest).bit_length()) - 1, -1, -1)
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        now = np.asarray(sequence)
        for level in self.levels:
            bit = ((now >> level) & 1).astype(bool)
            ones = np.zeros(self.n + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(self.n - int(ones[-1]))
            now = np.concatenate([now[~bit], now[bit]])

    def _down(self, level: int, at: np.ndarray, bit: np.ndarray) -> np.ndarray:
        ones = self.ones[level][at]
        return np.where(bit, self.zeros[level] + ones, at - ones)

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs in the first ``at`` places."""
        low = np.zeros(len(at), np.int64)
        for k, level in enumerate(self.levels):
            bit = (symbol >> level) & 1 == 1
            low, at = self._down(k, low, bit), self._down(k, at, bit)
        return at - low

    def at_with_rank(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol in each place, and how often it occurs before that place."""
        symbol, low = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        for k, _ in enumerate(self.levels):
            bit = self.ones[k][at + 1] > self.ones[k][at]
            symbol = symbol * 2 + bit
            low, at = self._down(k, low, bit), self._down(k, at, bit)
        return symbol, at - low

    def children(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct symbols of each range: the range's number, the symbol, and its ranks at both ends."""
        own, symbol = np.arange(len(low)), np.zeros(len(low), np.int64)
        base = np.zeros(len(low), np.int64)
        for k, _ in enumerate(self.levels):
            ones = self.ones[k]
            lo1, hi1, b1 = ones[low], ones[high], ones[base]
            lo0, hi0, b0 = low - lo1, high - hi1, base - b1
            zero, one = hi0 > lo0, hi1 > lo1
            z = self.zeros[k]
            own = np.concatenate([own[zero], own[one]])
            symbol = np.concatenate([symbol[zero] * 2, symbol[one] * 2 + 1])
            low, high, base = (
                np.concatenate([lo0[zero], lo1[one] + z]),
                np.concatenate([hi0[zero], hi1[one] + z]),
                np.concatenate([b0[zero], b1[one] + z]),
            )
        return own, symbol, low - base, high - base


class FMIndex:
    """Backward search for many phrases at once, and where they occur.

    Symbol 0 ends the sequence and 1 separates its parts; words start at 2.
    """

    def __init__(self, symbols: np.ndarray, largest: int, sample: int = 8):
        closed = np.concatenate([symbols, [0]]).astype(np.int64)
        order = suffix_order(closed + 1)
        self.n, self.sample = len(closed), sample
        self.before = WaveletMatrix(closed[order - 1], largest)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(closed, minlength=largest + 1))])
        marked = order % sample == 0
        self.marked = np.concatenate([[0], np.cumsum(marked)])
        self.position = order[marked]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Phrases (right-aligned rows of symbols) that occur, and the rows of the suffix order they span."""
        own = np.flatnonzero(lengths > 0)
        low, high = np.zeros(len(own), np.int64), np.full(len(own), self.n, np.int64)
        width, done = phrases.shape[1], []
        for step in range(1, width + 1):
            full = lengths[own] < step
            done.append((own[full], low[full], high[full]))
            own, low, high = own[~full], low[~full], high[~full]
            symbol = phrases[own, width - step]
            low = self.first[symbol] + self.before.rank(symbol, low)
            high = self.first[symbol] + self.before.rank(symbol, high)
            some = high > low
            own, low, high = own[some], low[some], high[some]
        done.append((own, low, high))
        return tuple(np.concatenate(parts) for parts in zip(*done, strict=True))

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: step back through the text to the next sampled position."""
        found = np.zeros(len(rows), np.int64)
        left, steps = np.arange(len(rows)), 0
        while len(left):
            hit = self.marked[rows + 1] > self.marked[rows]
            found[left[hit]] = self.position[self.marked[rows[hit]]] + steps
            left, rows, steps = left[~hit], rows[~hit], steps + 1
            symbol, rank = self.before.at_with_rank(rows)
            rows = self.first[symbol] + rank
        return found
