"""An FM-index over integer sequences: packed wavelet matrix of the Burrows-Wheeler transform, all steps vectorised."""

from __future__ import annotations

import numpy as np

_ONE = np.uint64(1)


class BitRank:
    """A packed bit vector with ranks by 64-bit words."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        raw = np.zeros((len(bits) // 64 + 1) * 8, np.uint8)
        raw[: len(packed)] = packed
        self.words = raw.view("<u8")
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)[:-1]))
        self.zeros = int(len(bits) - bits.sum())

    def ones(self, i: np.ndarray) -> np.ndarray:
        """How many bits are set before i."""
        w = i >> 6
        return self.before[w] + np.bitwise_count(self.words[w] & ((_ONE << (i & 63).astype(np.uint64)) - _ONE))

    def select(self, k: np.ndarray) -> np.ndarray:
        """Where the k-th set bit is, counted from 1."""
        w = np.searchsorted(self.before, k, "left") - 1
        word, left, at = self.words[w], (k - self.before[w]).astype(np.int64), w << 6
        for step in (32, 16, 8, 4, 2, 1):
            low = np.bitwise_count(word & ((_ONE << np.uint64(step)) - _ONE)).astype(np.int64)
            far = left > low
            left, at = left - low * far, at + step * far
            word = np.where(far, word >> np.uint64(step), word)
        return at


class WaveletMatrix:
    """rank(c, i) for many (c, i) at once, in one pass over the levels."""

    def __init__(self, seq: np.ndarray, top: int):
        self.levels = max(1, int(top).bit_length())
        self.bits = []
        for shift in range(self.levels - 1, -1, -1):
            b = (seq >> shift) & 1 == 1
            self.bits.append(BitRank(b))
            seq = np.concatenate((seq[~b], seq[b]))

    def walk(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for level, b in enumerate(self.bits):
            one = (c >> (self.levels - 1 - level)) & 1 == 1
            ones = b.ones(i)
            i = np.where(one, b.zeros + ones, i - ones)
        return i


class FMIndex:
    """Index of a sequence of integers >= 1 with 0 between its parts, for patterns of at most `depth` items.

    Suffixes are sorted by their first `depth` items only, which is all that counting such patterns needs. What stays is the
    wavelet matrix of the transform, one bit a suffix for where a class of equal first `depth` items begins, and two numbers a
    symbol; neither the suffixes' order nor their classes are kept."""

    def __init__(self, seq: np.ndarray, depth: int):
        n = len(seq)
        self.depth, self.n = depth, n
        rank = np.unique(seq, return_inverse=True)[1].astype(np.int64) + 1
        size, order = 1, np.argsort(rank, kind="stable")

        def by(rank: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
            far = np.zeros(n, np.int64)
            far[: n - step] = rank[step:]
            key = rank * (n + 2) + far
            order = np.argsort(key, kind="stable")
            key = key[order]
            new = np.empty(n, np.int64)
            new[order] = np.cumsum(np.concatenate(([1], (key[1:] != key[:-1]).astype(np.int64))))
            return new, order

        while size * 2 <= depth and size < n:
            rank, order = by(rank, size)
            size *= 2
        if size < depth and size < n and depth - size < n:
            rank, order = by(rank, depth - size)
        cls = rank[order]
        self.first = BitRank(np.concatenate(([True], cls[1:] != cls[:-1], [True])))
        top = int(seq.max(initial=0))
        self.tree = WaveletMatrix(seq[order - 1].astype(np.int64), top)
        chars = np.arange(top + 1)
        less = np.concatenate(([0], np.cumsum(np.bincount(seq, minlength=top + 1))[:-1]))
        self.shift = less - self.tree.walk(chars, np.zeros(top + 1, np.int64))

    def nbytes(self) -> int:
        """Bytes that the index holds once it is built."""
        return sum(b.words.nbytes + b.before.nbytes for b in [self.first, *self.tree.bits]) + self.shift.nbytes

    def back(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """One step of backward search for interval ends i."""
        return self.shift[c] + self.tree.walk(c, i)

    def repeated(self, seq: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Matching statistics of the parts seq[starts:ends]: for each position whether its longest match of at most `depth`
        items within the part is found at two places or more. The parts are streamed from their ends, all in step; each must
        occur in the index."""
        out = np.zeros(len(seq), bool)
        lo, hi = np.zeros(len(starts), np.int64), np.full(len(starts), self.n, np.int64)
        live, step = np.arange(len(starts)), 0
        while len(live):
            at = ends[live] - 1 - step
            c = seq[at]
            lo, hi = self.back(c, lo), self.back(c, hi)
            step += 1
            if step > self.depth:  # back to `depth` items: the class that the interval lies in
                k = self.first.ones(lo + 1)
                lo, hi = self.first.select(k), self.first.select(k + 1)
            out[at] = hi - lo >= 2
            go = at > starts[live]
            live, lo, hi = live[go], lo[go], hi[go]
        return out
