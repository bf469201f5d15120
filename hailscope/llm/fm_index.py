"""A compressed full-text index over word numbers: backward search on a wavelet matrix."""

from __future__ import annotations

import numpy as np

_U = np.uint64


class _Bits:
    """Packed bits with a running count per 64, for the number of ones before a place."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, _U)
        self.words.view(np.uint8)[: len(packed)] = packed
        ones = np.bitwise_count(self.words).astype(np.int32)
        self.before = np.concatenate([[0], np.cumsum(ones[:-1], dtype=np.int32)]).astype(np.int32)
        self.zeros = int(len(bits) - ones.sum())

    def ones(self, at: np.ndarray) -> np.ndarray:
        word, low = at >> 6, (at & 63).astype(_U)
        part = self.words[word] & ((_U(1) << low) - _U(1))
        return self.before[word] + np.bitwise_count(part).astype(np.int64)


class FMIndex:
    """Index of several word sequences.

    ``symbols`` holds numbers from 1 on; every sequence ends with a 0. The zeros
    count as different from each other, so no match crosses a sequence.
    """

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        order = self._suffixes(symbols)
        last = symbols[order - 1]  # the symbol before each suffix
        self.counts = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=1))])
        self.levels: list[tuple[int, _Bits]] = []
        top = int(symbols.max(initial=1)).bit_length()
        kinds = np.arange(len(self.counts) - 1)
        start = np.zeros(len(kinds), np.int64)
        for level in reversed(range(top)):
            one = (last >> level & 1).astype(bool)
            bits = _Bits(one)
            self.levels.append((level, bits))
            ones = bits.ones(start)
            start = np.where(kinds >> level & 1, bits.zeros + ones, start - ones)
            last = np.concatenate([last[~one], last[one]])
        self.shift = self.counts[:-1] - start
        self.size = n

    @staticmethod
    def _suffixes(symbols: np.ndarray) -> np.ndarray:
        """Suffix array by doubling; ends of sequences are told apart by their place."""
        n = len(symbols)
        zeros = symbols == 0
        rank = symbols + zeros.sum()
        rank[zeros] = np.arange(zeros.sum())
        reach = 1
        while True:
            after = np.zeros(n, np.int64)
            after[:-reach] = rank[reach:] + 1
            key = rank * (n + 1) + np.where(rank < zeros.sum(), 0, after)
            order = np.argsort(key)
            found = key[order]
            fresh = np.concatenate([[0], np.cumsum(found[1:] != found[:-1])])
            rank = np.empty(n, np.int64)
            rank[order] = fresh
            reach *= 2
            if fresh[-1] == n - 1 or reach >= n:
                return order

    def step(self, low: np.ndarray, high: np.ndarray, symbol: np.ndarray):
        """Intervals of the suffixes that begin with ``symbol`` before those of the old intervals."""
        for level, bits in self.levels:
            one = (symbol >> level & 1).astype(bool)
            a, b = bits.ones(low), bits.ones(high)
            low = np.where(one, bits.zeros + a, low - a)
            high = np.where(one, bits.zeros + b, high - b)
        shift = self.shift[symbol]
        return low + shift, high + shift

    def repeats(self, symbols: np.ndarray, begin: np.ndarray, end: np.ndarray, least: int):
        """Matching statistics of the sequences ``symbols[begin:end]``, all searched side by side.

        From each end word a search goes backward as long as the match still occurs
        twice in the index. Gives (number of sequence, from, to) of every such
        longest match of at least ``least`` words.

        A search that breaks off too early at a word shows that no match holds all from
        there to its end. A second, short search then ends at that very word: where it
        breaks off as well, it rules out all ends in between at once.
        """
        lane = np.flatnonzero(end - begin >= least)
        first, stop = begin[lane], end[lane].copy()
        at, low, high = stop.copy(), np.zeros(len(lane), np.int64), np.full(len(lane), self.size)
        # The word that a second search is about (or -1), the ends up to `out` that are ruled out,
        # and the end to go on from below them.
        broke = np.full(len(lane), -1)
        out, below = np.full(len(lane), -1), np.full(len(lane), -1)
        found = []
        while len(lane):
            second = broke >= 0
            go = (at > first) & ~(second & (broke + 1 - at >= least))
            a, b = self.step(low, high, symbols[np.maximum(at - 1, 0)])
            go &= b - a >= 2
            at, low, high = np.where(go, at - 1, at), np.where(go, a, low), np.where(go, b, high)
            done = ~go
            if not done.any():
                continue
            hit = done & ~second & (stop - at >= least)
            found.append((lane[hit], at[hit], stop[hit]))
            # A longer match is not possible from this end: the next one ends before it, and
            # takes in a word that this match has not.
            after = np.where(hit, at + least - 1, stop - 1)
            # The second search: at its own break no match of `least` words holds all up to the first one's.
            ended = done & second
            last_out = np.where(at > first, at - 1 + least, -1)
            out, below = np.where(ended, last_out, out), np.where(ended, broke, below)
            broke = np.where(ended, -1, broke)
            skip = done & (after <= out) & (after > below)
            after = np.where(skip, below, after)
            ask = done & ~second & ~hit & (at - 1 < stop - 1) & (at > first) & ~skip
            broke = np.where(ask, at - 1, broke)
            move = done & ~ask
            stop = np.where(move, after, stop)
            at = np.where(move, stop, at)  # a second search begins where the first one broke off
            low, high = np.where(done, 0, low), np.where(done, self.size, high)
            keep = stop - first >= least
            lane, first, stop, at, low, high, broke, out, below = (
                x[keep] for x in (lane, first, stop, at, low, high, broke, out, below)
            )
        if not found:
            return tuple(np.zeros(0, np.int64) for _ in range(3))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))
