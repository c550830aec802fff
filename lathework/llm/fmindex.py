"""FM-index over a sequence of small integers: wavelet ranks, backward search, sampled positions."""

from __future__ import annotations

import numpy as np

from lathework.llm.suffix import suffix_array


class Wavelet:
    """Ranks of symbols by a wavelet matrix: a bit a level, the zeros of a level before its ones on the next."""

    def __init__(self, text: np.ndarray, bits: int):
        self.bits, self.ones, self.zeros = bits, [], []
        for k in range(bits - 1, -1, -1):
            bit = ((text >> k) & 1).astype(np.int32)
            self.ones.append(np.concatenate((np.zeros(1, np.int32), np.cumsum(bit, dtype=np.int32))))
            self.zeros.append(len(text) - int(self.ones[-1][-1]))
            text = np.concatenate((text[bit == 0], text[bit == 1]))

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` before position ``at``."""
        start, at = np.zeros(len(at), np.int64), at.astype(np.int64)
        for k, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            bit = (symbol >> (self.bits - 1 - k)) & 1
            start = np.where(bit, zeros + ones[start], start - ones[start])
            at = np.where(bit, zeros + ones[at], at - ones[at])
        return at - start


class FMIndex:
    """Index of ``text``, symbols from 1 on; positions are sampled at every ``step``-th symbol."""

    def __init__(self, text: np.ndarray, step: int = 8):
        text = np.append(text, 0).astype(np.int64)
        n = len(text)
        order = suffix_array(text.astype(np.uint64), 1)
        self.n, self.last = n, text[order - 1]
        top = int(text.max())
        self.less = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=top + 1))))
        self.ranks = Wavelet(self.last, max(1, top.bit_length()))
        marked = order % step == 0
        self.marked = marked
        self.before = np.concatenate(([0], np.cumsum(marked)))
        self.sample = order[marked]

    def _map(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        return self.less[symbol] + self.ranks.rank(symbol, row)

    def search(self, patterns: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of the suffixes that begin with each pattern; ``patterns`` are right-aligned."""
        m, width = patterns.shape
        low, high = np.zeros(m, np.int64), np.full(m, self.n, np.int64)
        known = len(self.less) - 1
        for k in range(width - 1, -1, -1):
            go = np.flatnonzero((width - k <= length) & (low < high))
            c = patterns[go, k]
            ok = c < known
            high[go[~ok]] = low[go[~ok]]
            go, c = go[ok], c[ok]
            low[go], high[go] = self._map(c, low[go]), self._map(c, high[go])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each row: steps back to the next sampled one."""
        out, at, walked = np.zeros(len(rows), np.int64), rows.copy(), 0
        open_ = np.arange(len(rows))
        while len(open_):
            hit = self.marked[at]
            out[open_[hit]] = self.sample[self.before[at[hit]]] + walked
            open_, at = open_[~hit], at[~hit]
            at = self._map(self.last[at], at)
            walked += 1
        return out
