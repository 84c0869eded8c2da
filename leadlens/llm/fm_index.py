"""FM-index of a sequence of small integers: suffix array, Burrows-Wheeler
transform in a wavelet matrix, backward search and sampled locate.

Everything works on arrays of queries at once.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 8      # every so many text positions are kept for locate


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Prefix doubling; only suffixes that are still tied are sorted again."""
    n = len(t)
    order = np.argsort(t, kind="stable")
    first = np.ones(n, dtype=bool)
    first[1:] = t[order][1:] != t[order][:-1]
    group = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    rank = np.empty(n, dtype=np.int64)
    rank[order] = group
    step = 1
    while True:
        tied = ~first | ~np.append(first[1:], True)       # slots in groups of two or more
        slots = np.flatnonzero(tied)
        if not len(slots):
            return order
        at = order[slots]
        after = np.where(at + step < n, rank[np.minimum(at + step, n - 1)], -1)
        sorting = np.lexsort((after, rank[at]))
        at, after = at[sorting], after[sorting]
        order[slots] = at
        old = rank[at]
        fresh = np.ones(len(at), dtype=bool)
        fresh[1:] = (old[1:] != old[:-1]) | (after[1:] != after[:-1])
        first[slots] = fresh
        rank[at] = np.maximum.accumulate(np.where(fresh, slots, 0))
        step *= 2


class _Bits:
    """A bit vector with constant-time rank."""

    def __init__(self, bits: np.ndarray):
        words = np.zeros(len(bits) // 64 + 1, dtype=np.uint64)
        packed = np.packbits(bits, bitorder="little")
        words.view(np.uint8)[:len(packed)] = packed
        self.words = words
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))
        self.ones = int(self.before[-1])

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before position i."""
        low = (i & 63).astype(np.uint64)
        mask = (np.uint64(1) << low) - np.uint64(1)
        return self.before[i >> 6] + np.bitwise_count(self.words[i >> 6] & mask).astype(np.int64)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


class Wavelet:
    """Ranks and access over symbols by one bit vector a bit of the symbol."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.n, self.levels = len(symbols), []
        for bit in reversed(range(max(1, int(sigma - 1).bit_length()))):
            on = (symbols >> bit & 1).astype(bool)
            self.levels.append((bit, _Bits(on), len(on) - int(on.sum())))
            symbols = np.concatenate((symbols[~on], symbols[on]))

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of symbol c before position i."""
        lo = np.zeros_like(i)
        for bit, bits, zeros in self.levels:
            on = (c >> bit & 1).astype(bool)
            r_i, r_lo = bits.rank(i), bits.rank(lo)
            i = np.where(on, zeros + r_i, i - r_i)
            lo = np.where(on, zeros + r_lo, lo - r_lo)
        return i - lo

    def get(self, i: np.ndarray) -> np.ndarray:
        c = np.zeros_like(i)
        for bit, bits, zeros in self.levels:
            on, r = bits.get(i), bits.rank(i)
            c |= on.astype(np.int64) << bit
            i = np.where(on, zeros + r, i - r)
        return c


class FMIndex:
    def __init__(self, text: np.ndarray, sigma: int):
        text, sigma = np.append(np.asarray(text, dtype=np.int64) + 1, 0), sigma + 1   # 0: the end, found once
        sa = suffix_array(text)
        self.n = len(text)
        self.less = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=sigma))))
        self.bwt = Wavelet(text[sa - 1], sigma)
        kept = sa % SAMPLE == 0
        self.kept, self.samples = _Bits(kept), sa[kept]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [lo, hi) of suffixes that start with each pattern (k x m)."""
        lo = np.zeros(len(patterns), dtype=np.int64)
        hi = np.full(len(patterns), self.n, dtype=np.int64)
        live = np.arange(len(patterns))
        for c in patterns.T[::-1] + 1:
            if not len(live):
                break
            c = c[live]
            lo[live] = self.less[c] + self.bwt.rank(c, lo[live])
            hi[live] = self.less[c] + self.bwt.rank(c, hi[live])
            live = live[lo[live] < hi[live]]
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix-array rows: step back to a kept position."""
        rows, out = rows.copy(), np.zeros(len(rows), dtype=np.int64)
        open_ = np.arange(len(rows))
        steps = 0
        while len(open_):
            here = self.kept.get(rows[open_])
            done = open_[here]
            out[done] = self.samples[self.kept.rank(rows[done])] + steps
            open_ = open_[~here]
            c = self.bwt.get(rows[open_])
            rows[open_] = self.less[c] + self.bwt.rank(c, rows[open_])
            steps += 1
        return out
