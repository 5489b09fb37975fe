"""A full-text index (FM-index) over the word symbols of one shard.

The text is a sequence of symbols; 0 ends a segment. Suffixes are sorted as if every 0 were a symbol of its own,
ordered by place, so no comparison goes beyond a segment. The last column of the sorted rotations is kept in a
wavelet matrix, whose ranks answer backward search for many patterns at once; positions are kept for every
``rate``-th symbol and for the first of each segment, and found from other rows by walking back.
"""

from __future__ import annotations

import numpy as np


def suffix_order(t: np.ndarray, bits: int) -> np.ndarray:
    """Start positions of the sorted suffixes of ``t`` (symbols below 2**bits, the last one 0)."""
    n, packed = len(t), 63 // bits
    key = np.zeros(n, np.int64)
    open_ = np.ones(n, bool)  # no 0 among the symbols packed so far
    for k in range(packed):
        symbol = np.zeros(n, np.int64)
        symbol[: max(n - k, 0)] = t[k:]
        symbol *= open_
        key = (key << bits) | symbol
        open_ &= symbol != 0
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    head = np.ones(n, bool)
    head[1:] = (sorted_key[1:] != sorted_key[:-1]) | ~open_[order[1:]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    width = packed
    while True:  # prefix doubling, on the rows that still tie
        tied = ~head
        tied[:-1] |= ~head[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            return order
        start = order[at]
        pair = rank[start] * n + rank[start + width]
        within = np.argsort(pair, kind="stable")
        start, pair = start[within], pair[within]
        order[at] = start
        new = np.ones(len(at), bool)
        new[1:] = pair[1:] != pair[:-1]
        head[at] = new
        rank[start] = np.maximum.accumulate(np.where(new, at, 0))
        width *= 2


class WaveletMatrix:
    """Ranks over symbols below 2**bits: one bit-plane with running counts for each bit, highest first."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.ones, self.zeros = bits, [], []
        current = symbols
        for level in range(bits - 1, -1, -1):
            bit = ((current >> level) & 1).astype(bool)
            count = np.zeros(len(current) + 1, np.int32)
            np.cumsum(bit, out=count[1:])
            self.ones.append(count)
            self.zeros.append(len(current) - int(count[-1]))
            current = np.concatenate([current[~bit], current[bit]])

    def rank(self, symbol: np.ndarray, *ends: np.ndarray) -> list[np.ndarray]:
        """How many of the first ``end`` symbols equal ``symbol``, for each array of ends."""
        places = [np.zeros(len(symbol), np.int64), *ends]
        for level, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            bit = ((symbol >> (self.bits - 1 - level)) & 1).astype(bool)
            for k, place in enumerate(places):
                up = ones[place]
                places[k] = np.where(bit, zeros + up, place - up)
        return [p - places[0] for p in places[1:]]


class FMIndex:
    def __init__(self, text: np.ndarray, alphabet: int, rate: int = 8):
        """``text``: symbols below ``alphabet``; a closing 0 is added."""
        t = np.append(text, 0).astype(np.int64)
        self.bits = max(1, int(alphabet - 1).bit_length())
        order = suffix_order(t, self.bits)
        self.last = t[order - 1]  # of the first suffix: the closing 0
        self.before = np.concatenate([[0], np.cumsum(np.bincount(t, minlength=alphabet))])
        self.matrix = WaveletMatrix(self.last, self.bits)
        self.sampled = (order % rate == 0) | (self.last == 0)
        self.sample = order[self.sampled]
        self.sample_at = np.cumsum(self.sampled) - 1
        self.size = len(t)

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [low, high) of the suffixes that begin with each pattern.

        ``patterns`` holds a pattern a row, set against the right edge; all its ``lengths`` symbols are non-zero.
        """
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.size, np.int64)
        width = patterns.shape[1]
        for k in range(width):
            active = np.flatnonzero((lengths > k) & (low < high))
            if not len(active):
                break
            symbol = patterns[active, width - 1 - k]
            a, b = self.matrix.rank(symbol, low[active], high[active])
            low[active], high[active] = self.before[symbol] + a, self.before[symbol] + b
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of the suffixes in ``rows``."""
        rows = rows.copy()
        out = np.empty(len(rows), np.int64)
        todo, steps = np.arange(len(rows)), 0
        while len(todo):
            here = rows[todo]
            known = self.sampled[here]
            out[todo[known]] = self.sample[self.sample_at[here[known]]] + steps
            todo = todo[~known]
            here = here[~known]
            symbol = self.last[here]
            rows[todo] = self.before[symbol] + self.matrix.rank(symbol, here)[0]
            steps += 1
        return out
