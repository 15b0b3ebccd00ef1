"""FM-index over integer sequences: suffix order, Burrows-Wheeler transform, wavelet matrix, backward search.

All searches of a batch go in lockstep through numpy arrays.  Bits are packed 64 to a word with one
count per word; the index holds about ``n * log2(symbols)`` bits and the arrays of the intervals.
"""

from __future__ import annotations

import numpy as np


class FmIndex:
    """Index of sequences ``symbols[bounds[i]:bounds[i + 1]]`` for matches of ``depth`` symbols."""

    def __init__(self, symbols: np.ndarray, bounds: np.ndarray, depth: int):
        sizes, count = np.diff(bounds), len(bounds) - 1
        names, dense = np.unique(symbols, return_inverse=True)
        # each sequence is followed by a mark of its own; marks sort before all symbols
        self.starts = bounds[:-1] + np.arange(count)
        self.sizes = sizes
        n = len(symbols) + count
        marks = self.starts + sizes
        inner = np.ones(n, bool)
        inner[marks] = False
        self.text = np.zeros(n, np.int64)
        self.text[inner] = dense + 1
        rank = self.text + count - 1
        rank[marks] = np.arange(count)
        order, self.group = _suffixes(rank, depth)
        self.levels = max(1, int(len(names)).bit_length())
        before = self.text[order - 1]  # the symbol before the first is the last mark
        self.bits, self.counts, self.zeros = [], [], []
        column = before
        for level in reversed(range(self.levels)):
            bit = (column >> level & 1).astype(bool)
            packed = np.packbits(np.append(bit, np.zeros(-len(bit) % 64 + 64, bool)), bitorder="little").view(np.uint64)
            self.bits.append(packed)
            self.counts.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed))]).astype(np.int64))
            self.zeros.append(len(bit) - int(bit.sum()))
            column = np.concatenate([column[~bit], column[bit]])
        sizes_by_symbol = np.bincount(self.text, minlength=len(names) + 1)
        self.first = np.concatenate([[0], np.cumsum(sizes_by_symbol)])[:-1]
        self.base = self._walk(np.zeros(len(names) + 1, np.int64), np.arange(len(names) + 1))
        # rows of equal first ``depth`` symbols are neighbours
        edges = np.flatnonzero(np.diff(self.group, prepend=-1))
        self.row_group = np.repeat(np.arange(len(edges)), np.diff(np.append(edges, n)))
        self.group_start, self.group_end = edges, np.append(edges[1:], n)
        self.order, self.depth = order, depth

    def _walk(self, at: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Where a position of the transform ends up below all levels, following ``symbol``."""
        for i, level in enumerate(reversed(range(self.levels))):
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            ones = self.counts[i][word] + np.bitwise_count(self.bits[i][word] & ((np.uint64(1) << bit) - np.uint64(1)))
            at = np.where(symbol >> level & 1, self.zeros[i] + ones, at - ones)
        return at

    def step(self, low: np.ndarray, high: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of ``symbol`` followed by what rows ``low`` to ``high`` begin with."""
        shift = self.first[symbol] - self.base[symbol]
        return self._walk(low, symbol) + shift, self._walk(high, symbol) + shift

    def matching(self, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Matching statistics of all sequences, cut at ``depth``.

        For each place of a sequence with ``depth`` symbols from it on: the smallest ``value`` (one per
        sequence) among all places that go on with the same ``depth`` symbols.  Places are listed by sequence;
        returns the minima and their bounds.
        """
        owner = np.repeat(np.arange(len(self.sizes)), self.sizes + 1)
        smallest = np.minimum.reduceat(value[owner][self.order], self.group_start) if len(self.group_start) else value[:0]
        places = np.maximum(self.sizes - self.depth + 1, 0)
        bounds = np.concatenate([[0], np.cumsum(places)])
        out = np.zeros(bounds[-1], value.dtype)
        longest = np.argsort(-self.sizes, kind="stable")
        lengths = self.sizes[longest]
        ends = self.starts[longest] + lengths
        low, high = np.zeros(len(longest), np.int64), np.full(len(longest), len(self.text), np.int64)
        for t in range(int(lengths[0]) if len(lengths) else 0):
            k = int(np.searchsorted(-lengths, -t))  # sequences longer than t
            low, high = self.step(low[:k], high[:k], self.text[ends[:k] - 1 - t])
            if t + 1 > self.depth:
                # one symbol too many matched: widen to the rows that agree in ``depth`` symbols
                low, high = self.group_start[self.row_group[low]], self.group_end[self.row_group[high - 1]]
            if t + 1 >= self.depth:
                at = lengths[:k] - 1 - t
                out[bounds[longest[:k]] + at] = smallest[self.row_group[low]]
        return out, bounds


def _suffixes(rank: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of all suffixes by prefix doubling, and in this order a label of their first ``depth`` symbols.

    Labels differ where the symbols differ; a prefix that runs over a mark has a label of its own.
    """
    n, span, kept = len(rank), 1, None
    while True:
        if span * 2 > depth and kept is None:
            kept = (rank, span)
        later = np.full(n, -1, np.int64)
        later[:n - span] = rank[span:]
        key = rank * (n + 1) + later + 1
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        fresh = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])]) if n else sorted_key
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        span *= 2
        if not n or fresh[-1] == n - 1:
            break
    if kept is None:  # all differ before ``depth``
        return order, np.arange(n)
    half, width = kept
    label = half.copy()
    tail = np.full(n, -1, np.int64)
    shift = depth - width
    tail[:n - shift] = half[shift:]
    pair = (label * (n + 1) + tail + 1)[order]
    return order, np.concatenate([[0], np.cumsum(pair[1:] != pair[:-1])]) if n else pair
