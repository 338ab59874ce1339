"""Byte-level BPE over rank files, merged from a hierarchical-bitmap rank queue.

The symbols of many pieces lie in one linked list; no link crosses a piece. Each merge rank has a bucket of list positions
whose pair has that rank. Three levels of 64-bit words say which buckets hold something, so find-first-set gives the least
rank in three steps, whatever the length of the piece. The positions of the least rank are merged from the left; what a merge
makes of its neighbours goes to their new buckets, and entries whose pair has changed since are stale and skipped. A merge so costs a
bounded number of steps: a piece of a million bytes takes a million times the work of one byte, not its square. The first buckets
are slices of one sorted array, so memory is a few numbers a byte.

Defined results: null is the empty text, which has no ids; a text of any length is cut only where the pattern itself must cut, and
a piece that is a token is that token; of pairs of equal rank the first in the piece is merged first. Repeated rows, null ids and
equal ids are rows like any other; only ids and texts are read, so further columns play no part; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import PATTERN, BytePairCodec


class RankQueue:
    """Buckets of positions by rank; a three-level bitmap finds the least rank that has any (ranks below 2 ** 18)."""

    def __init__(self, ranks: np.ndarray):
        """Starts with position i in the bucket of ranks[i], for all that aren't negative."""
        at = np.flatnonzero(ranks >= 0)
        order = at[np.argsort(ranks[at], kind="stable")].astype(np.int32)
        some, edge = np.unique(ranks[order], return_index=True)
        self.first = order
        self.edges = dict(zip(some.tolist(), zip(edge.tolist(), [*edge[1:].tolist(), len(order)], strict=True), strict=True))
        self.late: dict[int, array] = {}
        self.low, self.mid, self.top = [0] * 4096, [0] * 64, 0
        for r in self.edges:
            self.mark(r)

    def mark(self, rank: int) -> None:
        a, b = rank >> 6, rank >> 12
        self.low[a] |= 1 << (rank & 63)
        self.mid[b] |= 1 << (a & 63)
        self.top |= 1 << b

    def push(self, rank: int, at: int) -> None:
        bucket = self.late.get(rank)
        if bucket is None:
            self.late[rank] = array("i", (at,))
            self.mark(rank)
        else:
            bucket.append(at)

    def pop(self) -> tuple[int, list[int]] | None:
        """The least rank and its positions from the left; its bucket is empty then."""
        if not self.top:
            return None
        b = (self.top & -self.top).bit_length() - 1
        m = self.mid[b]
        a = b << 6 | (m & -m).bit_length() - 1
        m = self.low[a]
        rank = a << 6 | (m & -m).bit_length() - 1
        self.low[a] = m = m & (m - 1)
        if not m:
            self.mid[b] = m = self.mid[b] & (self.mid[b] - 1)
            if not m:
                self.top &= self.top - 1
        edge = self.edges.pop(rank, None)
        out = self.first[edge[0] : edge[1]].tolist() if edge else []
        more = self.late.pop(rank, None)
        if more:
            out = sorted([*out, *more])
        return rank, out

    def back(self, rank: int, at: list[int]) -> None:
        """Positions that must wait for a lower rank."""
        for x in at:
            self.push(rank, x)


class RankCodec(BytePairCodec):
    """A byte-level BPE tokenizer from a rank file: lines of a token in base64 and its rank, which is its id."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.tokens = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f.read().splitlines())}
        self.size = max(self.tokens.values()) + 1
        self.first = np.array([self.tokens[bytes((b,))] for b in range(256)], np.int64)
        self.bytes = [b""] * self.size
        for t, r in self.tokens.items():
            self.bytes[r] = t
        #: The rank of two neighbouring tokens is that of their bytes.
        self.pairs = {self.tokens[t[:k]] * self.size + self.tokens[t[k:]]: r for t, r in self.tokens.items() for k in range(1, len(t)) if t[:k] in self.tokens and t[k:] in self.tokens}
        self.keys = np.array(sorted(self.pairs), np.int64)
        self.made = np.array([self.pairs[k] for k in self.keys.tolist()], np.int64)
        self.added, self.split = {}, None
        self.pieces = regex.compile(PATTERN)
        self.known, self.old = {}, {}

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, one after the other, and where each begins (n + 1)."""
        size = np.array([len(w) for w in words], np.int64)
        start = np.concatenate(([0], np.cumsum(size)))
        n = int(start[-1])
        sym = self.first[np.frombuffer(b"".join(words), np.uint8)].astype(np.int32)
        whole = np.array([self.tokens.get(w, -1) if w else -1 for w in words], np.int64)
        inside = np.ones(n, bool)
        inside[start[1:][size > 0] - 1] = False  # the last symbol of a piece has no pair
        inside[np.repeat(whole >= 0, size)] = False
        rank = np.full(n, -1, np.int32)
        at = np.flatnonzero(inside)
        key = sym[at].astype(np.int64) * self.size + sym[at + 1]
        found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        rank[at] = np.where(self.keys[found] == key, self.made[found], -1)
        sym = self._run(sym, rank, start[:-1][size > 0], n)
        head = start[:-1][whole >= 0]
        sym[np.repeat(whole >= 0, size)] = -1
        sym[head] = whole[whole >= 0]
        left = np.flatnonzero(sym >= 0)
        return sym[left].astype(np.int64), np.searchsorted(left, start)

    def _run(self, sym: np.ndarray, rank: np.ndarray, heads: np.ndarray, n: int) -> np.ndarray:
        queue = RankQueue(rank)
        after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        before[heads] = -1
        after[heads[1:] - 1] = -1
        after[-1:] = -1
        after, before, sym, rank = (array("i", x.tobytes()) for x in (after, before, sym, rank))
        size, pairs, push = self.size, self.pairs, queue.push
        while (got := queue.pop()) is not None:
            r, places = got
            for n_done, i in enumerate(places, 1):
                if rank[i] != r:
                    continue  # stale: merged away, or its pair is another one now
                j = after[i]
                k, h, least = after[j], before[i], size
                sym[i], sym[j], rank[j], after[i] = r, -1, -1, k
                if k >= 0:
                    before[k] = i
                    rank[i] = new = pairs.get(r * size + sym[k], -1)
                    if new >= 0:
                        push(new, i)
                        least = new
                else:
                    rank[i] = -1
                if h >= 0:
                    rank[h] = new = pairs.get(sym[h] * size + r, -1)
                    if new >= 0:
                        push(new, h)
                        least = min(least, new)
                if least <= r:  # the others wait, as something of this or a lower rank has come up
                    queue.back(r, places[n_done:])
                    break
        return np.frombuffer(sym, np.int32).copy()


@lru_cache(2)
def codec(path: str) -> RankCodec:
    return RankCodec(path)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (the whole token sequence): the operator's general form."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            ids = [c.numbers(parts).astype(np.int32) for parts in c.ids_texts(t.as_py() or "" for t in b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, content (the bytes) of (doc_id, ids); ids of parts of a character give parts of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([c.decode_bytes(np.array(x.as_py() or [], np.int64)) for x in b.column(1)], pa.binary())], names=["doc_id", "content"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, content binary")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: digests of the ids and of the bytes they decode to, in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            counts, ids_sha, text_sha = [], [], []
            for parts in c.ids_texts(t.as_py() or "" for t in b.column(1)):
                a, d, n = hashlib.sha256(), hashlib.sha256(), 0
                for part in parts:
                    a.update(("," if n else "").encode() + part.encode())
                    ids = np.fromstring(part, np.int64, sep=",")
                    n += len(ids)
                    d.update(c.decode_bytes(ids))
                counts.append(n)
                ids_sha.append(a.hexdigest())
                text_sha.append(d.hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
