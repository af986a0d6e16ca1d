"""A compressed full-text index over word numbers: wavelet matrix, backward search, matching statistics.

The text is a concatenation of pieces, each ended by a separator (number 0) that
sorts by its place, so no match runs over a border.  Every piece has a weight,
how often it stands in the corpus; a match counts the weights of its pieces.
All steps are array operations over many pieces at once.
"""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order and the common prefix of each with the one before, by doubling.

    ``longest`` bounds the pieces with their separators.
    """
    n = len(symbols)
    separator = symbols == 0
    rank = np.where(separator, np.cumsum(separator) - 1, symbols + int(separator.sum()) - 1).astype(np.int64)
    order, ranks, width = np.arange(n), [rank], 1
    while width < longest:
        after = np.zeros(n, np.int64)
        after[: n - width] = rank[width:] + 1
        key = rank * (int(rank.max(initial=0)) + 2) + after
        order = np.argsort(key)
        placed = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.r_[False, placed[1:] != placed[:-1]])
        ranks.append(rank)
        width *= 2
    order = np.argsort(rank)
    a, b, common = order[:-1].copy(), order[1:].copy(), np.zeros(max(n - 1, 0), np.int64)
    for k in reversed(range(len(ranks))):
        level = np.append(ranks[k], -1)
        equal = (level[np.minimum(a, n)] == level[np.minimum(b, n)]) & (b < n) & (a < n)
        step = equal * (1 << k)
        a, b, common = a + step, b + step, common + step
    return order, np.r_[0, common, 0].astype(np.uint8 if longest < 256 else np.int32)


class Bits:
    """A bit vector with rank: packed words and the ones before each."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.r_[packed, np.zeros(16 - len(packed) % 8, np.uint8)].view(np.uint64)
        self.before = np.r_[0, np.cumsum(np.bitwise_count(self.words))[:-1]].astype(np.int64)

    def ones(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class FMIndex:
    """Backward search over the pieces of one shard."""

    def __init__(self, symbols: np.ndarray, weights: np.ndarray, longest: int):
        """``symbols``: word numbers from 1, a 0 after each piece; ``weights``: of each position's piece."""
        order, lcp = suffix_array(symbols, longest)
        self.n = len(symbols)
        self.weight = np.r_[0, np.cumsum(weights[order])]
        self.lcp = [lcp]  # the least of the 2**k values that end at a place
        while 1 << len(self.lcp) <= self.n:
            last, step = self.lcp[-1], 1 << (len(self.lcp) - 1)
            self.lcp.append(np.minimum(last, np.r_[np.zeros(step, last.dtype), last[:-step]]))
        column = symbols[order - 1]  # before the first suffix stands the last separator
        top = int(symbols.max(initial=0))
        self.levels = []
        for shift in reversed(range(max(1, top.bit_length()))):
            bit = (column >> shift & 1).astype(bool)
            self.levels.append((shift, Bits(bit), len(bit) - int(bit.sum())))
            column = np.r_[column[~bit], column[bit]]
        every = np.arange(top + 1)
        self.base = np.zeros(top + 1, np.int64)
        counts = np.bincount(symbols, minlength=top + 1)
        self.base = np.cumsum(counts) - counts - self._descend(every, np.zeros(top + 1, np.int64))

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, bits, zeros in self.levels:
            ones = bits.ones(at)
            at = np.where(symbol >> shift & 1, zeros + ones, at - ones)
        return at

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows that begin with the symbol and then with what the given rows begin with."""
        both = self._descend(np.r_[symbol, symbol], np.r_[low, high]) + np.tile(self.base[symbol], 2)
        return both[: len(low)], both[len(low) :]

    def widen(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The next larger rows, of a shorter match: its length, and the rows."""
        first = self.lcp[0]
        depth = np.maximum(first[low], first[high])
        bound = np.maximum(depth, 1)  # the first and last value are 0
        low, high = low.copy(), high.copy()
        for k in reversed(range(len(self.lcp))):
            low -= (self.lcp[k][low] >= bound).astype(np.int64) << k
            end = high + (1 << k) - 1
            high += ((end <= self.n) & (self.lcp[k][np.minimum(end, self.n)] >= bound)).astype(np.int64) << k
        whole = depth == 0
        return depth.astype(np.int64), np.where(whole, 0, low), np.where(whole, self.n, high)

    def statistics(self, symbols: np.ndarray, start: np.ndarray, end: np.ndarray, least: int, times: int = 2) -> np.ndarray:
        """Matching statistics of streamed pieces [start, end) of ``symbols``.

        Per place the longest stretch from there on that the index holds at least
        ``times`` times; 0 where no stretch of ``least`` words can cover it any more.
        """
        found = np.zeros(len(symbols), np.int64)
        at, start = end.astype(np.int64), start.astype(np.int64)
        low, high, depth = np.zeros(len(at), np.int64), np.full(len(at), self.n), np.zeros(len(at), np.int64)
        while len(at):
            live = (at > start) & (at + depth - start >= least)
            if not live.all():
                at, start, low, high, depth = at[live], start[live], low[live], high[live], depth[live]
                continue
            new_low, new_high = self.extend(symbols[at - 1], low, high)
            longer = self.weight[new_high] - self.weight[new_low] >= times
            none = ~longer & (depth == 0)
            shorter = ~longer & ~none
            if shorter.any():
                depth[shorter], low[shorter], high[shorter] = self.widen(low[shorter], high[shorter])
            low, high = np.where(longer, new_low, low), np.where(longer, new_high, high)
            depth += longer
            at = at - (longer | none)
            found[at[longer]] = depth[longer]
        return found
