"""A compressed FM-index over word sequences, in numpy, for one shard at a time.

The Burrows-Wheeler transform of the shard is held as a wavelet matrix of packed bits with block
ranks; suffixes and texts aren't kept, the LCP values take a byte each and their intervals 32 bits.
``matching`` walks queries in step: each goes from its last word to its first, extends
its match to the left by backward search while the match occurs often enough, and otherwise
drops to the longest shorter match from the LCP intervals.
"""

from __future__ import annotations

import numpy as np


class BitRank:
    """Packed bits; ``rank(i)`` counts the ones before ``i``."""

    def __init__(self, bits: np.ndarray) -> None:
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.zeros(len(self.words), np.int32)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])

    def rank(self, i: np.ndarray) -> np.ndarray:
        block = i >> 6
        below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[block] + np.bitwise_count(self.words[block] & below)


class FMIndex:
    """Index of sequences of words 1.. that end with 0. ``weights`` says how often each sequence counts.

    Matches of up to ``depth`` words (120 at most) are exact; sequences are no longer than that.
    """

    def __init__(self, sequences: list[np.ndarray], weights: np.ndarray, depth: int) -> None:
        lengths = np.array([len(s) for s in sequences])
        text = np.zeros(int(lengths.sum()) + len(sequences), np.int64)
        inside = np.ones(len(text), bool)
        inside[np.cumsum(lengths + 1) - 1] = False
        text[inside] = np.concatenate(sequences)
        n = self.n = len(text)
        # ranks of the suffixes by their first 1, 2, 4, .. words
        ranks, k = [text.astype(np.int32)], 1
        order = np.argsort(text, kind="stable")
        while k <= depth:
            r = ranks[-1]
            shifted = np.zeros(n, np.int64)
            shifted[: max(0, n - k)] = r[k:] + 1
            key = r * np.int64(n + 2) + shifted
            order = np.argsort(key, kind="stable")
            new = np.zeros(n, np.int32)
            new[order[1:]] = np.cumsum(key[order[1:]] != key[order[:-1]])
            ranks.append(new)
            k *= 2
        # LCP of neighbours, from the ranks of doubling lengths
        a, b = order[:-1], order[1:]
        lcp = np.zeros(n - 1, np.int64)
        for level in range(len(ranks) - 1, -1, -1):
            r = ranks[level]
            ia, ib = a + lcp, b + lcp
            inside = (ia < n) & (ib < n)
            same = np.zeros(n - 1, bool)
            same[inside] = r[ia[inside]] == r[ib[inside]]
            lcp += same.astype(np.int64) << level
        self.lcp = np.concatenate([[-1], np.minimum(lcp, depth), [-1]]).astype(np.int8)
        self._intervals()
        of = np.cumsum(text == 0) - (text == 0)
        self.weight = np.concatenate([[0], np.cumsum(weights[of[order]])])
        self._wavelet(text[order - 1], int(text.max()) + 1)

    def _intervals(self) -> None:
        """For each place the nearest places before and after with a smaller LCP."""
        lcp, n = self.lcp, self.n
        self.smaller_before, self.smaller_after = np.zeros(n + 1, np.int32), np.full(n + 1, n, np.int32)
        for v in np.unique(lcp):
            own = np.flatnonzero(lcp == v)
            low = np.flatnonzero(lcp < v)
            if v < 0 or not len(low):
                continue
            at = np.searchsorted(low, own)
            self.smaller_before[own] = low[at - 1]
            self.smaller_after[own] = low[np.minimum(at, len(low) - 1)]

    def _wavelet(self, bwt: np.ndarray, symbols: int) -> None:
        self.levels, self.zeros = [], []
        counts = np.bincount(bwt, minlength=symbols)
        first = np.concatenate([[0], np.cumsum(counts)[:-1]])
        start, seq, symbol = np.zeros(symbols, np.int64), bwt, np.arange(symbols)
        self.bits = max(1, (symbols - 1).bit_length())
        for level in range(self.bits - 1, -1, -1):
            bit = (seq >> level & 1).astype(bool)
            rank = BitRank(bit)
            zeros = len(seq) - int(bit.sum())
            ones = rank.rank(start)
            start = np.where(symbol >> level & 1, zeros + ones, start - ones)
            self.levels.append(rank)
            self.zeros.append(zeros)
            seq = np.concatenate([seq[~bit], seq[bit]])
        self.base = (first - start).astype(np.int32)

    def extend(self, lo: np.ndarray, hi: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward step: the interval of ``c`` followed by what [lo, hi) stands for."""
        both, symbol = np.concatenate([lo, hi]), np.concatenate([c, c])
        for j, rank in enumerate(self.levels):
            ones = rank.rank(both)
            both = np.where(symbol >> (self.bits - 1 - j) & 1, self.zeros[j] + ones, both - ones)
        both += self.base[symbol]
        return both[: len(lo)], both[len(lo) :]

    def matching(self, queries: list[np.ndarray], least: int = 2) -> list[np.ndarray]:
        """For each query (words that the index knows) and each of its places: words of the longest match beginning there that counts ``least`` or more."""
        lengths = np.array([len(q) for q in queries], np.int64)
        text = np.concatenate(queries) if queries else np.zeros(0, np.int32)
        ends = np.cumsum(lengths)
        out = np.zeros(len(text), np.int64)
        pos, stop = ends.copy(), ends - lengths
        lo, hi, size = np.zeros(len(queries), np.int64), np.full(len(queries), self.n, np.int64), np.zeros(len(queries), np.int64)
        live = np.flatnonzero(pos > stop)
        while len(live):
            c = text[pos[live] - 1]
            new_lo, new_hi = self.extend(lo[live], hi[live], c)
            good = (new_hi > new_lo) & (self.weight[np.maximum(new_hi, 0)] - self.weight[np.maximum(new_lo, 0)] >= least)
            yes, no = live[good], live[~good]
            lo[yes], hi[yes] = new_lo[good], new_hi[good]
            size[yes] += 1
            pos[yes] -= 1
            out[pos[yes]] = size[yes]
            empty = no[size[no] == 0]
            pos[empty] -= 1
            short = no[size[no] > 0]
            k = np.where(self.lcp[lo[short]] >= self.lcp[hi[short]], lo[short], hi[short])
            size[short] = np.maximum(self.lcp[k], 0)
            whole = self.lcp[k] <= 0
            lo[short] = np.where(whole, 0, self.smaller_before[k])
            hi[short] = np.where(whole, self.n, self.smaller_after[k])
            live = live[pos[live] > stop[live]]
        return np.split(out, ends[:-1]) if queries else []
