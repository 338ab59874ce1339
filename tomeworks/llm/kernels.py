"""Vectorised text kernels over flat byte arrays."""

from __future__ import annotations

import numpy as np
import xxhash

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
MASKS = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], dtype=np.uint64)
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_30, _27, _31 = np.uint64(30), np.uint64(27), np.uint64(31)
#: Words beyond this many bytes are hashed one by one.
LONG = 512


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (in place)."""
    x ^= x >> _30
    x *= _B
    x ^= x >> _27
    x *= _C
    x ^= x >> _31
    return x


def words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words [^\\x20\\x09-\\x0D]+ of documents offs[i]:offs[i + 1], and the first word of each (n + 1)."""
    a, b = int(offs[0]), int(offs[-1])
    solid = ~SPACE[data[a:b]]
    if not len(solid):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    rel = offs - a
    before = np.empty_like(solid)
    before[0] = False
    before[1:] = solid[:-1]
    cut = rel[:-1][rel[:-1] < len(solid)]
    before[cut] = False
    starts = np.flatnonzero(solid & ~before)
    after = np.empty_like(solid)
    after[-1] = False
    after[:-1] = solid[1:]
    last = rel[1:][rel[1:] > 0] - 1
    after[last] = False
    ends = np.flatnonzero(solid & ~after) + 1
    return starts + a, ends + a, np.searchsorted(starts, rel)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    n = len(starts)
    h = np.full(n, 0x51ED270B9F3A1C75, np.uint64)
    if not n:
        return h
    lo = int(starts[0])
    padded = np.zeros(int(ends[-1]) - lo + 16, np.uint8)
    padded[: int(ends[-1]) - lo] = data[lo : int(ends[-1])]
    lanes = np.ndarray((len(padded) - 7,), "<u8", padded.data, 0, (1,))
    at, left = starts - lo, ends - starts
    h ^= left.astype(np.uint64) * _C
    live = None
    huge = np.flatnonzero(left > LONG)
    for k in huge:
        h[k] = xxhash.xxh64_intdigest(padded[at[k] : at[k] + left[k]].tobytes())
    if len(huge):
        live = np.flatnonzero(left <= LONG)
        at, left = at[live], left[live]
    while len(at):
        part = lanes[at] & MASKS[np.minimum(left, 8)]
        part *= _A
        if live is None:
            h ^= part
            mix(h)
        else:
            h[live] = mix(h[live] ^ part)
        more = np.flatnonzero(left > 8)
        live = more if live is None else live[more]
        at, left = at[more] + 8, left[more] - 8
    return h


def run_hashes(w: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k consecutive items; as many as len(w) - k + 1."""
    if len(w) < k:
        return np.zeros(0, np.uint64)
    out, left, size, mult = None, k, 1, _A
    base, at = w, 0
    level = w.copy()
    # doubling: level holds the hash of `size` items; the binary digits of k say which to join
    while left:
        if left & 1:
            n = len(w) - k + 1
            part = level[at : at + n]
            out = part.copy() if out is None else mix(out * _B + part)
            at += size
        left >>= 1
        if left:
            level = mix(level[:-size] * mult + level[size:]) if len(level) > size else level[:0]
            size *= 2
    del base
    return out


def short_hash(w: np.ndarray) -> int:
    """Hash of a whole short sequence, apart from those of full runs."""
    h = np.array([0xA0761D6478BD642F + len(w)], np.uint64)
    for x in w:
        h = mix(h * _A + x)
    return int(h[0])


def shingles(data: np.ndarray, offs: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct k-word shingle hashes of each document, one after the other, and the bounds (n + 1).

    A text of fewer words is one shingle; one without words has none."""
    starts, ends, first = words(data, offs)
    w = word_hashes(data, starts, ends)
    runs = run_hashes(w, k)
    parts, bounds = [], np.zeros(len(offs), np.int64)
    for i in range(len(offs) - 1):
        a, b = int(first[i]), int(first[i + 1])
        if b - a >= k:
            s = np.sort(runs[a : b - k + 1])
            if len(s) > 1:
                s = s[np.concatenate(([True], s[1:] != s[:-1]))]
            parts.append(s)
            bounds[i + 1] = len(s)
        elif b > a:
            parts.append(np.array([short_hash(w[a:b])], np.uint64))
            bounds[i + 1] = 1
    np.cumsum(bounds, out=bounds)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), bounds


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return LOWER[data]


def counts_of(keys: np.ndarray) -> np.ndarray:
    """For each item, how often its value occurs."""
    if not len(keys):
        return np.zeros(0, np.int64)
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    edge = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
    size = np.diff(np.append(edge, len(s)))
    out = np.empty(len(keys), np.int64)
    out[order] = np.repeat(size, size)
    return out


class Forest:
    """Union-find over 0..n-1, smaller root wins."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        if a < b:
            self.up[b] = a
        else:
            self.up[a] = b
        return True


def labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Component of each of 0..n-1 (its smallest member), by vectorised hooking and pointer jumping."""
    up = np.arange(n)
    while len(a):
        ra, rb = up[a], up[b]
        live = ra != rb
        if not live.any():
            break
        a, b, ra, rb = a[live], b[live], ra[live], rb[live]
        np.minimum.at(up, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            nxt = up[up]
            if (nxt == up).all():
                break
            up = nxt
    return up
