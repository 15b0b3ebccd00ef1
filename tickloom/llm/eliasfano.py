"""Monotone sequences in Elias-Fano form and a two-level n-gram trie out of them, in flat arrays that can be memory-mapped."""

from __future__ import annotations

import numpy as np

_U = np.uint64
_KINDS = [np.dtype(x) for x in ("u1", "u2", "u4", "u8", "i8", "f8")]


def pack(arrays: list[np.ndarray]) -> bytes:
    """Arrays behind a head of kinds and lengths, each from a multiple of eight bytes on."""
    head = np.array([len(arrays), *[x for a in arrays for x in (_KINDS.index(a.dtype), len(a))]], np.int64)
    return b"".join([head.tobytes(), *[a.tobytes() + bytes(-a.nbytes % 8) for a in arrays]])


def unpack(data: np.ndarray) -> list[np.ndarray]:
    """Views of the packed arrays in a byte array, which may be a memory map."""
    head = data[:8].view(np.int64)
    head = data[8:8 + 16 * int(head[0])].view(np.int64).reshape(-1, 2)
    at, out = 8 + 16 * len(head), []
    for kind, n in head.tolist():
        size = _KINDS[kind].itemsize * n
        out.append(data[at:at + size].view(_KINDS[kind]))
        at += size + -size % 8
    return out


def _select(words: np.ndarray, before: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Place of the k-th (from 0) bit that is set; ``before`` counts those in front of each word."""
    at = np.searchsorted(before, k, side="right") - 1
    left = (k - before[at]).astype(np.int64)
    word, place = words[at], at.astype(np.int64) * 64
    for width in (32, 16, 8, 4, 2, 1):
        count = np.bitwise_count(word & _U((1 << width) - 1)).astype(np.int64)
        over = left >= count
        left -= np.where(over, count, 0)
        place += np.where(over, width, 0)
        word = np.where(over, word >> _U(width), word)
    return place


class EliasFano:
    """A sorted sequence of n different or equal values below 2**64: low bits packed, high parts as a bit vector.

    A value of high part h is bit ``h + i`` of the vector; the zeros end the buckets of one high part.
    """

    def __init__(self, parts: list[np.ndarray]):
        meta, self.low, self.high, self.ones, self.zeros = parts
        self.n, self.bits = int(meta[0]), int(meta[1])
        self.buckets = int(meta[2])

    @staticmethod
    def build(values: np.ndarray) -> list[np.ndarray]:
        n = len(values)
        top = int(values[-1]) + 1 if n else 1
        bits = max((top // max(n, 1)).bit_length() - 1, 0)
        high = (values >> _U(bits)).astype(np.int64)
        buckets = (top >> bits) + 1
        marks = np.zeros((n + buckets + 63) // 64 * 64, np.uint8)
        marks[high + np.arange(n)] = 1
        vector = np.packbits(marks, bitorder="little").view(np.uint64)
        count = np.bitwise_count(vector).astype(np.int64)
        ones = np.concatenate([[0], np.cumsum(count)[:-1]]).astype(np.uint32)
        zeros = np.concatenate([[0], np.cumsum(64 - count)[:-1]]).astype(np.uint32)
        low = np.zeros(n * bits // 64 + 2, np.uint64)
        if bits and n:
            kept = values & _U((1 << bits) - 1)
            at = np.arange(n, dtype=np.uint64) * _U(bits)
            word, shift = (at >> _U(6)).astype(np.int64), at & _U(63)
            first = np.flatnonzero(np.diff(word, prepend=-1))
            low[word[first]] = np.bitwise_or.reduceat(kept << shift, first)
            spill = np.flatnonzero(shift + _U(bits) > _U(64))  # a value that goes on in the next word: one a word at most
            low[word[spill] + 1] |= kept[spill] >> (_U(64) - shift[spill])
        return [np.array([n, bits, buckets], np.int64), low, vector, ones, zeros]

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), np.uint64)
        at = i.astype(np.uint64) * _U(self.bits)
        word, shift = (at >> _U(6)).astype(np.int64), at & _U(63)
        over = np.where(shift == 0, _U(0), self.low[word + 1] << ((_U(64) - shift) & _U(63)))
        return ((self.low[word] >> shift) | over) & _U((1 << self.bits) - 1)

    def value(self, i: np.ndarray) -> np.ndarray:
        return (_select(self.high, self.ones, i) - i).astype(np.uint64) << _U(self.bits) | self._low(i)

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the first value that is not below ``x`` (n if none), and whether it equals ``x``."""
        high = np.minimum((x >> _U(self.bits)).astype(np.int64), self.buckets - 1)
        beyond = (x >> _U(self.bits)) >= _U(self.buckets)
        flipped = ~self.high
        end = _select(flipped, self.zeros, high) - high
        begin = np.where(high > 0, _select(flipped, self.zeros, np.maximum(high - 1, 0)) - high + 1, 0)
        low, stop = x & _U((1 << self.bits) - 1), end
        lo, hi = begin, end
        while (open_ := lo < hi).any():  # binary search inside the bucket
            mid = (lo + hi) >> 1
            less = open_ & (self._low(np.minimum(mid, max(self.n - 1, 0))) < low)
            lo, hi = np.where(less, mid + 1, lo), np.where(open_ & ~less, mid, hi)
        same = (lo < stop) & ~beyond
        same[same] = self._low(lo[same]) == low[same]
        return np.where(beyond, self.n, lo), same


class Trie:
    """Words with counts, and below each word the contexts it was seen in with a probability code of a byte.

    ``grams`` is one monotone sequence: a context counts from the pointer of its word, and pointers grow by the largest context
    of the word before.  A lookup is a successor search for the word, then for pointer + context.
    """

    def __init__(self, data: np.ndarray):
        parts = unpack(data)
        self.first = int(parts[0][0])
        self.counts, self.codes, self.book = parts[1:4]
        self.words, self.pointers, self.grams = (EliasFano(parts[i:i + 5]) for i in (4, 9, 14))
        self.top = int(parts[0][1])

    @staticmethod
    def build(words: np.ndarray, counts: np.ndarray, kids: np.ndarray, contexts: np.ndarray, values: np.ndarray) -> bytes:
        """``words`` sorted and at least one; ``kids`` contexts of each, sorted; ``values`` are put into 256 equal steps."""
        bounds = np.concatenate([[0], np.cumsum(kids)]).astype(np.int64)
        steps = np.concatenate([[0], np.cumsum(contexts[bounds[1:] - 1].astype(np.uint64) + _U(1))]).astype(np.uint64)
        low, width = values.min(), max(np.ptp(values), 1e-9)
        codes = np.minimum((values - low) * (256 / width), 255).astype(np.int64)
        used = np.bincount(codes, minlength=256)
        book = np.bincount(codes, values, 256) / np.maximum(used, 1)
        head = np.array([words[0], words[-1]], np.uint64)
        return pack([head, counts.astype(np.uint64 if counts.max() >> 32 else np.uint32), codes.astype(np.uint8), book,
                     *EliasFano.build(words - words[0]), *EliasFano.build(steps[:-1]), *EliasFano.build(np.repeat(steps[:-1], kids) + contexts.astype(np.uint64))])

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Node and whether it is there, of each of the ``words``."""
        inside = (words >= _U(self.first)) & (words <= _U(self.top))
        node, there = self.words.successor(np.where(inside, words - _U(self.first), _U(0)))
        there &= inside
        return np.where(there, node, 0), there

    def look(self, node: np.ndarray, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Value (the step of its code) and whether the context was seen below the node."""
        place, there = self.grams.successor(self.pointers.value(node) + contexts.astype(np.uint64))
        # a context larger than all of the node's would run into the next node
        after = np.minimum(node + 1, self.pointers.n - 1)
        limit = np.where(node + 1 < self.pointers.n, self.pointers.value(after), _U(0xFFFFFFFFFFFFFFFF))
        there &= self.pointers.value(node) + contexts.astype(np.uint64) < limit
        return self.book[self.codes[np.where(there, place, 0)]], there
