"""An FM-index over the words of one shard: backward search by wavelet ranks, sampled positions.

Symbol 0 is a break (end of a text, or words no query holds) and never part of a query.
Breaks count as distinct letters in order of position, so suffix comparison stops at the
first one and copies of whole texts cost no more than their runs. A walk back from a row
never crosses a break: the position after each break is always sampled.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 8


def suffix_order(symbols: np.ndarray, bits: int) -> np.ndarray:
    """Positions of ``symbols`` (the last is 0) in the order of their suffixes, by prefix doubling.

    The first round sorts as many symbols as fit one machine word; later ones only what is
    still tied.
    """
    n, depth = len(symbols), max(1, 62 // bits)
    padded = np.concatenate([symbols.astype(np.int64), np.zeros(depth, np.int64)])
    key, live = np.zeros(n, np.int64), np.ones(n, bool)
    for j in range(depth):
        here = padded[j : j + n]
        key = (key << bits) | np.where(live, here, 0)
        live &= here != 0
    order = np.argsort(key)
    sorted_key = key[order]
    rank = np.empty(n, np.int64)
    at = np.arange(n)
    height = depth
    while True:
        # Groups of equal keys start where the key changes.
        new = np.ones(len(order), bool)
        np.not_equal(sorted_key[1:], sorted_key[:-1], out=new[1:])
        first = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
        tied = ~new
        tied[:-1] |= ~new[1:]
        if (done := tied & ~live[order]).any():
            # Tied up to a break: the earlier position comes first.
            where = np.flatnonzero(done)
            again = where[np.lexsort((order[where], first[where]))]
            order[where] = order[again]
            first[where] = where
            tied[where] = False
        rank[order] = at[first]
        if height == depth:
            result = order
        else:
            result[at] = order
        if not tied.any():
            return result
        at, order = at[tied], order[tied]
        sorted_key = rank[order] * n + rank[order + height]
        # A suffix stays live while no break lies in its first 2 * height symbols.
        live[order] &= live[order + height]
        again = np.lexsort((order, sorted_key)) if len(order) < 64 else np.argsort(sorted_key)
        order, sorted_key = order[again], sorted_key[again]
        height *= 2


class Wavelet:
    """Rank and access on a sequence of ``bits``-bit symbols, one bit vector a level, high bit first."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels = []
        for level in range(bits - 1, -1, -1):
            ones = (symbols >> level) & 1 == 1
            packed = np.packbits(ones, bitorder="little")
            packed = np.concatenate([packed, np.zeros(16 - len(packed) % 8, np.uint8)]).view(np.uint64)
            before = np.zeros(len(packed) + 1, np.int64)
            np.cumsum(np.bitwise_count(packed), out=before[1:])
            self.levels.append((packed, before, int(len(symbols) - np.count_nonzero(ones))))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    @staticmethod
    def _ones(level, at: np.ndarray) -> np.ndarray:
        packed, before, _ = level
        block, inside = at >> 6, (at & 63).astype(np.uint64)
        return before[block] + np.bitwise_count(packed[block] & ((np.uint64(1) << inside) - np.uint64(1)))

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        start = np.zeros_like(at)
        for k, level in enumerate(self.levels):
            bit = (symbol >> (len(self.levels) - 1 - k)) & 1 == 1
            low, high = self._ones(level, start), self._ones(level, at)
            start = np.where(bit, level[2] + low, start - low)
            at = np.where(bit, level[2] + high, at - high)
        return at - start

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and how often it occurs before it."""
        symbol, start = np.zeros_like(at), np.zeros_like(at)
        for level in self.levels:
            bit = (level[0][at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
            low, high = self._ones(level, start), self._ones(level, at)
            start = np.where(bit, level[2] + low, start - low)
            at = np.where(bit, level[2] + high, at - high)
            symbol = symbol * 2 + bit
        return symbol, at - start


class FMIndex:
    def __init__(self, symbols: np.ndarray, size: int):
        """Over ``symbols`` below ``size``; the last one must be 0."""
        bits = max(1, (size - 1).bit_length())
        order = suffix_order(symbols, bits)
        self.n = len(symbols)
        self.wavelet = Wavelet(symbols[order - 1], bits)
        counts = np.bincount(symbols, minlength=size)
        self.before = np.concatenate([[0], np.cumsum(counts)])[:size].astype(np.int64)
        after_break = np.ones(self.n, bool)
        after_break[1:] = symbols[:-1] == 0
        sampled = (order % SAMPLE == 0) | after_break[order]
        self.sampled, self.sample_at = sampled, np.cumsum(sampled) - 1
        self.samples = order[sampled]

    def search(self, queries: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range of rows whose suffixes begin with each query (rows of ``queries``, padded on the left)."""
        low, high = np.zeros(len(queries), np.int64), np.full(len(queries), self.n, np.int64)
        alive = np.arange(len(queries))
        for step in range(queries.shape[1]):
            alive = alive[(step < lengths[alive]) & (low[alive] < high[alive])]
            if not len(alive):
                break
            symbol = queries[alive, queries.shape[1] - 1 - step]
            low[alive] = self.before[symbol] + self.wavelet.rank(symbol, low[alive])
            high[alive] = self.before[symbol] + self.wavelet.rank(symbol, high[alive])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The position of each row's suffix: step back to a sampled one and count the steps."""
        rows, out = rows.copy(), np.zeros(len(rows), np.int64)
        steps, away = np.zeros(len(rows), np.int64), np.arange(len(rows))
        while len(away):
            here = self.sampled[rows[away]]
            found = away[here]
            out[found] = self.samples[self.sample_at[rows[found]]] + steps[found]
            away = away[~here]
            symbol, before = self.wavelet.access(rows[away])
            rows[away] = self.before[symbol] + before
            steps[away] += 1
        return out
