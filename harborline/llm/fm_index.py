"""FM-index over word ids: suffix array, wavelet matrix of the Burrows-Wheeler transform, sampled suffix positions.

All steps work on arrays, so that many patterns are searched at once.
"""

from __future__ import annotations

import numpy as np


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling, in which only suffixes that aren't told apart yet are sorted again.

    The rank of a suffix is the place of the first of its group, so that groups are refined in place.
    """
    n = len(s)
    order = np.argsort(s, kind="stable")
    head = np.ones(n, bool)
    head[1:] = s[order[1:]] != s[order[:-1]]
    slots = np.arange(n)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, slots, 0))
    slots, k = slots[~(head & np.append(head[1:], True))], 1
    while len(slots):
        open_ = order[slots]
        after = np.where(open_ + k < n, rank[np.minimum(open_ + k, n - 1)] + 1, 0)
        key = rank[open_] * (n + 1) + after
        by = np.argsort(key, kind="stable")
        open_, key = open_[by], key[by]
        order[slots] = open_
        head = np.ones(len(slots), bool)
        head[1:] = key[1:] != key[:-1]
        rank[open_] = np.maximum.accumulate(np.where(head, slots, 0))
        slots, k = slots[~(head & np.append(head[1:], True))], k * 2
    return order


class WaveletMatrix:
    """Rank and access over a sequence of small integers, one bit vector with counts per level."""

    def __init__(self, s: np.ndarray, alphabet: int):
        self.n, self.levels = len(s), max(1, int(alphabet - 1).bit_length())
        self.counts, self.zeros = [], []
        for level in range(self.levels - 1, -1, -1):
            bit = (s >> level) & 1
            counts = np.zeros(self.n + 1, np.int32)
            np.cumsum(bit, out=counts[1:])
            self.counts.append(counts)
            self.zeros.append(self.n - int(counts[-1]))
            s = np.concatenate([s[bit == 0], s[bit == 1]])

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often c stands before position i, for arrays of both."""
        left, right = np.zeros_like(i), i.copy()
        for level, counts, zeros in zip(range(self.levels - 1, -1, -1), self.counts, self.zeros):
            one = ((c >> level) & 1).astype(bool)
            a, b = counts[left], counts[right]
            left, right = np.where(one, zeros + a, left - a), np.where(one, zeros + b, right - b)
        return right - left

    def access(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at positions i and their ranks there."""
        c, left, at = np.zeros_like(i), np.zeros_like(i), i.copy()
        for counts, zeros in zip(self.counts, self.zeros):
            bit = counts[at + 1] - counts[at]
            a, b = counts[at], counts[left]
            at, left = np.where(bit == 1, zeros + a, at - a), np.where(bit == 1, zeros + b, left - b)
            c = c * 2 + bit
        return c, at - left


class FMIndex:
    """Index of a sequence of ids from 1 on; 0 is the end mark and must not occur."""

    def __init__(self, s: np.ndarray, alphabet: int, sample: int = 16):
        s = np.append(np.asarray(s, np.int64), 0)
        self.n = len(s)
        order = suffix_array(s)
        self.wavelet = WaveletMatrix(s[order - 1], alphabet)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(s, minlength=alphabet))]).astype(np.int64)
        self.sampled = order % sample == 0
        self.positions, self.index = order[self.sampled], np.cumsum(self.sampled) - 1

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Backward search of patterns (a row each): (row, low, high) of those that occur."""
        rows = np.arange(len(patterns))
        low, high = np.zeros(len(rows), np.int64), np.full(len(rows), self.n, np.int64)
        for k in range(patterns.shape[1] - 1, -1, -1):
            c = patterns[rows, k]
            low, high = self.first[c] + self.wavelet.rank(c, low), self.first[c] + self.wavelet.rank(c, high)
            found = low < high
            rows, low, high = rows[found], low[found], high[found]
            if not len(rows):
                break
        return rows, low, high

    def locate(self, rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pattern row, position) of every occurrence, by walking back to the nearest sampled suffix."""
        sizes = high - low
        owner = np.repeat(rows, sizes)
        at = np.arange(int(sizes.sum()), dtype=np.int64) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(low, sizes)
        steps, result, open_ = np.zeros(len(at), np.int64), np.full(len(at), -1, np.int64), np.arange(len(at))
        while len(open_):
            here = at[open_]
            done = self.sampled[here]
            result[open_[done]] = self.positions[self.index[here[done]]] + steps[open_[done]]
            open_ = open_[~done]
            c, rank = self.wavelet.access(at[open_])
            at[open_] = self.first[c] + rank
            steps[open_] += 1
        return owner, result
