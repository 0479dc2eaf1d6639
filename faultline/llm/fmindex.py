"""FM-index of an integer sequence: wavelet-matrix ranks over the Burrows-Wheeler transform, sampled suffix positions.

All steps work on arrays of patterns or rows at once.
"""

from __future__ import annotations

import numpy as np


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order, by prefix doubling; a suffix that ends first is smaller."""
    n = len(s)
    rank = np.unique(s, return_inverse=True)[1].astype(np.int64)
    order, width = np.argsort(rank, kind="stable"), 1
    while n:
        key = rank * (n + 1)
        key[:max(n - width, 0)] += rank[width:] + 1
        order = np.argsort(key, kind="stable")
        held = key[order]
        new = np.zeros(n, np.int64)
        new[order] = np.cumsum(np.r_[False, held[1:] != held[:-1]])
        rank, width = new, 2 * width
        if rank[order[-1]] == n - 1 or width >= n:
            break
    return order


class FMIndex:
    """Symbols are 0 < x < sigma; 0 is the end of the sequence and is added here."""

    def __init__(self, symbols: np.ndarray, sigma: int, every: int = 16):
        s = np.append(symbols, 0).astype(np.int64)
        order = suffix_array(s)
        n, self.levels = len(s), max(1, int(sigma - 1).bit_length())
        marked = order % every == 0
        self.marks = _Bits(marked)
        self.sampled = order[marked]
        row = s[order - 1]  # the symbol before each suffix; position -1 is the end symbol
        smaller = np.r_[0, np.cumsum(np.bincount(s, minlength=sigma))[:-1]]
        self.bits, self.zeros = [], []
        for level in reversed(range(self.levels)):
            one = (row >> level) & 1 == 1
            self.bits.append(_Bits(one))
            self.zeros.append(n - int(one.sum()))
            row = np.concatenate([row[~one], row[one]])
        self.n = n
        symbols_ = np.arange(sigma)
        self.base = smaller - self._down(symbols_, np.zeros(sigma, np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, (bits, zeros) in enumerate(zip(self.bits, self.zeros)):
            ones = bits.rank(at)
            at = np.where((symbol >> (self.levels - 1 - level)) & 1 == 1, zeros + ones, at - ones)
        return at

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [low, high) of the suffixes that start with each pattern (a row of equal length each)."""
        m = len(patterns)
        low, high = np.zeros(m, np.int64), np.full(m, self.n, np.int64)
        alive = np.arange(m)
        for j in reversed(range(patterns.shape[1])):
            c = patterns[alive, j]
            low[alive] = self._down(c, low[alive]) + self.base[c]
            high[alive] = self._down(c, high[alive]) + self.base[c]
            alive = alive[high[alive] > low[alive]]
            if not len(alive):
                break
        dead = high <= low
        low[dead] = high[dead] = 0
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Position in the sequence of the suffix in each row: steps back to the next sampled one."""
        out, steps = np.zeros(len(rows), np.int64), 0
        waiting, at = np.arange(len(rows)), rows.astype(np.int64)
        while len(waiting):
            found = self.marks.get(at)
            out[waiting[found]] = self.sampled[self.marks.rank(at[found])] + steps
            waiting, at, steps = waiting[~found], at[~found], steps + 1
            symbol, down = np.zeros(len(at), np.int64), at
            for bits, zeros in zip(self.bits, self.zeros):
                one, ones = bits.get(down), bits.rank(down)
                symbol = symbol * 2 + one
                down = np.where(one, zeros + ones, down - ones)
            at = down + self.base[symbol]
        return out


class _Bits:
    """A bit vector with counts before each 64-bit word."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.words.view(np.uint8)[:len(packed)] = packed
        self.before = np.zeros(len(self.words), np.int64)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        return self.before[word] + np.bitwise_count(self.words[word] & ((np.uint64(1) << bit) - np.uint64(1)))

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
