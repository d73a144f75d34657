"""A run-length grammar of a string by recompression, and longest common extensions on it.

Rounds alternate two steps until every part of the string between separators is one symbol. Block
compression gives each maximal repetition of one symbol a symbol of its own, named by symbol and length. Pair
compression puts every symbol on the left or right side by a bit of its hash, and names each neighbouring pair of
a left and a right symbol. Either step reads a string only through a neighbourhood of one symbol, so equal
substrings are cut in the same way but for a symbol at each of their ends, and that is what an
extension query uses: it climbs the levels as long as both positions begin a symbol of the next level, takes the
one symbol in between where they do not, and after the first difference comes down again, taking
at each level the one symbol (or the shorter of two blocks) that still agrees.

Queries are answered many at a time, level by level. Everything is exact: names come from sorting, not hashing.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from cohortmill.llm.texts import mix

_SEED = np.uint64(0xA24BAED4963EE407)


@dataclass
class Level:
    """A string, and how the next level's symbols cover it."""

    symbols: np.ndarray
    #: First position of each symbol of the next level, and one past the last position of all.
    first: np.ndarray
    #: The next level's symbol that covers a position.
    parent: np.ndarray
    blocks: bool


def _names(keys: np.ndarray, above: int) -> np.ndarray:
    """Equal numbers from ``above`` on for equal keys."""
    return np.unique(keys, return_inverse=True)[1].reshape(-1) + above


class Grammar:
    """Levels of a string; its symbols from ``separators`` on occur once each, stay alone, and begin and end it."""

    def __init__(self, symbols: np.ndarray, separators: int):
        self.levels: list[Level] = []
        self.lengths: list[np.ndarray] = []
        symbols = np.asarray(symbols, np.int64)
        fresh = int(symbols.max(initial=0)) + 1
        alone = symbols >= separators
        lengths = np.ones(len(symbols), np.int64)
        turn = 0
        while True:
            together = ~alone[1:] & ~alone[:-1]
            if not together.any():
                break
            if turn % 2 == 0:
                joined = together & (symbols[1:] == symbols[:-1])
            else:
                right = (mix(symbols.astype(np.uint64) * _SEED + np.uint64(turn)) & np.uint64(1)).astype(bool)
                joined = together & ~right[:-1] & right[1:]
            turn += 1
            if not joined.any():
                continue
            starts = np.flatnonzero(np.concatenate([[True], ~joined]))
            ends = np.append(starts[1:], len(symbols))
            wide = np.flatnonzero(ends - starts > 1)
            after = symbols[starts]
            if turn % 2:
                keys = after[wide] * np.int64(len(symbols) + 1) + (ends - starts)[wide]
            else:
                keys = after[wide] * np.int64(fresh) + symbols[starts[wide] + 1]
            after[wide] = _names(keys, fresh)
            parent = np.cumsum(np.concatenate([[0], ~joined])).astype(np.int32)
            self.levels.append(Level(symbols, np.append(starts, len(symbols)), parent, bool(turn % 2)))
            self.lengths.append(lengths)
            fresh = int(after.max()) + 1
            # Few symbols are left of those named so far: number them anew, so keys stay small.
            if fresh > 4 * len(symbols) + 16:
                after = _names(after, 0)
                fresh = int(after.max()) + 1
            alone, lengths, symbols = alone[starts], np.add.reduceat(lengths, starts), after
        self.levels.append(Level(symbols, np.zeros(0, np.int64), np.zeros(0, np.int32), False))
        self.lengths.append(lengths)

    def extend(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols agree from positions ``i`` and ``j`` (different ones) on."""
        return self._agree(i, j, forward=True)

    def extend_back(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols agree from positions ``i`` and ``j`` (different ones) backwards, themselves included."""
        return self._agree(i, j, forward=False)

    def _agree(self, i: np.ndarray, j: np.ndarray, forward: bool) -> np.ndarray:
        x, y = np.asarray(i, np.int64).copy(), np.asarray(j, np.int64).copy()
        total = np.zeros(len(x), np.int64)
        # Queries by the level at which they met a difference.
        turned: list[np.ndarray] = []
        climbing = np.arange(len(x))
        for depth, level in enumerate(self.levels):
            at, to = x[climbing], y[climbing]
            same = level.symbols[at] == level.symbols[to]
            if depth == len(self.levels) - 1:
                # Whole parts between separators; behind equal ones come two separators.
                self._take(depth, climbing[same], x, y, total, forward)
                turned.append(climbing)
                break
            begin = self._begins(level, at, forward) & self._begins(level, to, forward)
            step = ~begin & same
            begin &= same
            taken = self._take(depth, climbing[step], x, y, total, forward)
            if level.blocks:
                # Behind blocks of which one has more left, the symbols differ.
                begin[step] = taken
            else:
                begin[step] = True
            turned.append(climbing[~begin])
            climbing = climbing[begin]
            x[climbing], y[climbing] = level.parent[x[climbing]], level.parent[y[climbing]]
        falling = np.zeros(0, np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            level = self.levels[depth]
            if len(falling):
                if forward:
                    x[falling], y[falling] = level.first[x[falling]], level.first[y[falling]]
                else:
                    x[falling], y[falling] = level.first[x[falling] + 1] - 1, level.first[y[falling] + 1] - 1
                same = level.symbols[x[falling]] == level.symbols[y[falling]]
                self._take(depth, falling[same], x, y, total, forward)
            if depth < len(turned):
                falling = np.concatenate([falling, turned[depth]])
        return total

    @staticmethod
    def _begins(level: Level, at: np.ndarray, forward: bool) -> np.ndarray:
        own = level.parent[at]
        return at == (level.first[own] if forward else level.first[own + 1] - 1)

    def _take(self, depth: int, which: np.ndarray, x: np.ndarray, y: np.ndarray, total: np.ndarray, forward: bool) -> np.ndarray:
        """Pass a common symbol, or what two blocks have in common; whether both blocks end there."""
        level, at, to = self.levels[depth], x[which], y[which]
        if level.blocks:
            if forward:
                left, other = level.first[level.parent[at] + 1] - at, level.first[level.parent[to] + 1] - to
            else:
                left, other = at - level.first[level.parent[at]] + 1, to - level.first[level.parent[to]] + 1
            steps = np.minimum(left, other)
            both = left == other
        else:
            steps, both = np.ones(len(which), np.int64), np.ones(len(which), bool)
        total[which] += steps * self.lengths[depth][at]
        if forward:
            x[which] += steps
            y[which] += steps
        else:
            x[which] -= steps
            y[which] -= steps
        return both
