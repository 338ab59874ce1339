"""Benchmark decontamination by greedy string tiling.

Texts are lower-cased and split into words at ASCII white space and punctuation. Word runs of `min_match` words that a document and
a test item share are the seeds; only they can lie in a tile. Where the seeds of an item reach the threshold, the
two are tiled: running Karp-Rabin searches fingerprints of falling length, and the longest matches of unmarked words
are marked first, so that passages whose parts were reordered are covered by several tiles. A document is
contaminated by an item when its tiles cover `coverage` of the item's words.

The items are the query set. They are read in blocks of at most about BLOCK_WORDS words (one item at least), each
of which is sent to all executors and held against all documents, whole texts.

Defined results: null or empty texts, items with a null id and items of fewer than `min_match` words match nothing; documents
with a null id give their pairs under it; repeated rows give their pairs as often; of equally long matches the first in the
item, then in the document, is marked; empty tables give no rows. Only ids and texts are read, so further columns play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import doc_slices, stash, text_buffers
from .kernels import run_hashes, word_hashes, words

BLOCK_WORDS = 2_000_000
#: ASCII punctuation becomes white space.
PLAIN = np.arange(256, dtype=np.uint8)
PLAIN[[c for c in range(128) if not chr(c).isalnum()]] = 0x20
FILTER_BITS = 20


def token_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, Iterator]:
    """Runs of rows with the hashes of their words: (first row, last row, hashes, first word of each row)."""
    data, offs = text_buffers(pc.utf8_lower(column.cast(pa.string())))
    for i, j in doc_slices(offs):
        d, o = PLAIN[data[offs[i] : offs[j]]], offs[i : j + 1] - offs[i]
        starts, ends, first = words(d, o)
        yield i, j, word_hashes(d, starts, ends), first


def fingerprints(w: np.ndarray, free: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Karp-Rabin fingerprints of the runs of `size` unmarked words, and where they start."""
    taken = np.concatenate(([0], np.cumsum(~free)))
    at = np.flatnonzero(taken[size:] == taken[:-size]) if len(w) >= size else np.zeros(0, np.int64)
    return run_hashes(w, size)[at], at


def _seeded(w: np.ndarray, other: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words that lie in a run of `least` words which `other` has too, with a marked one behind each stretch of them:
    words, which of them are free, and their places."""
    at = np.flatnonzero(np.isin(run_hashes(w, least), run_hashes(other, least)))
    cover = np.zeros(len(w) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + least, -1)
    free = np.cumsum(cover) > 0
    place = np.flatnonzero(free | np.concatenate(([False], free[:-1])))
    return w[np.minimum(place, len(w) - 1)], free[place], place


def tile(p: np.ndarray, t: np.ndarray, min_match: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling of word hashes: tiles (place in p, place in t, length).

    Each is the longest match of words unmarked in both, of equally long ones that of the first place in p, then in t. If
    some match has a length, some has each smaller one, so the longest is found by bisection over Karp-Rabin fingerprints
    of one length at a time: memory is linear in the words, also where all of them are the same."""
    if min(len(p), len(t)) < min_match:
        return []
    (p, free_p, place_p), (t, free_t, place_t), tiles = _seeded(p, t, min_match), _seeded(t, p, min_match), []

    def match(size: int) -> tuple[int, int] | None:
        hp, ip = fingerprints(p, free_p, size)
        ht, it = fingerprints(t, free_t, size)
        found = np.flatnonzero(np.isin(hp, ht))
        return (int(ip[found[0]]), int(it[np.argmax(ht == hp[found[0]])])) if len(found) else None

    most = min(len(p), len(t))
    while most >= min_match:
        best, size, low = match(most), most, min_match - 1
        while best is None and most - low > 1:  # no match of `most` words; `low` has one, or is too short to matter
            mid = (low + most) // 2
            if (got := match(mid)) is None:
                most = mid
            else:
                low, kept = mid, got
                size = mid
        if best is None:
            if low < min_match:
                break
            best = kept
        i, k = best
        free_p[i : i + size] = free_t[k : k + size] = False
        tiles.append((int(place_p[i]), int(place_t[k]), size))
        most = size
    return tiles


class ItemIndex:
    """Seeds of a block of items."""

    def __init__(self, ids: list[int], hashes: list[np.ndarray], min_match: int):
        self.ids, self.words, self.k = ids, hashes, min_match
        seed, item, at = [], [], []
        for n, w in enumerate(hashes):
            h = run_hashes(w, min_match)
            seed.append(h)
            item.append(np.full(len(h), n))
            at.append(np.arange(len(h)))
        seed, item, at = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (seed, item, at))
        order = np.argsort(seed, kind="stable")
        self.seed, self.item, self.at = seed[order].astype(np.uint64), item[order], at[order]
        self.maybe = np.zeros(1 << FILTER_BITS, bool)
        self.maybe[(self.seed & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)] = True

    def search(self, w: np.ndarray, first: np.ndarray, coverage: float) -> Iterator[tuple[int, int, list]]:
        """(row, item, tiles) of the contaminated pairs of a run of documents."""
        h = run_hashes(w, self.k)
        if not len(h) or not len(self.seed):
            return
        pos = np.flatnonzero(self.maybe[(h & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)])
        lo, hi = np.searchsorted(self.seed, h[pos], "left"), np.searchsorted(self.seed, h[pos], "right")
        doc = np.searchsorted(first, pos, "right") - 1
        inside = (hi > lo) & (pos + self.k <= first[doc + 1])
        # a seed that a document repeats counts once
        doc, lo, hi = np.unique(np.stack((doc[inside], lo[inside], hi[inside])), axis=1)
        n = hi - lo
        hit = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        key = np.unique(np.stack((np.repeat(doc, n), self.item[hit], self.at[hit])), axis=1)
        if not key.shape[1]:
            return
        edge = np.flatnonzero(np.concatenate(([True], (key[0, 1:] != key[0, :-1]) | (key[1, 1:] != key[1, :-1]), [True])))
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
            item = int(key[1, a])
            p = self.words[item]
            need = coverage * len(p) - 1e-9
            if (b - a) * self.k < need:
                continue
            at = key[2, a:b]
            if np.minimum(np.diff(at, append=at[-1] + self.k), self.k).sum() < need:  # words in any seed
                continue
            row = int(key[0, a])
            tiles = tile(p, w[first[row] : first[row + 1]], self.k)
            if sum(x[2] for x in tiles) >= need:
                yield row, item, tiles


PAIRS = "doc_id long, item_id long, coverage double, n_tiles int, tiles array<struct<item_at:int,doc_at:int,words:int>>"
_TILES = pa.list_(pa.struct([("item_at", pa.int32()), ("doc_at", pa.int32()), ("words", pa.int32())]))


def _search(docs: DataFrame, index, coverage: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = index.value
        for b in batches:
            doc_ids, out = b.column(0).to_pylist(), []
            for i, _, w, first in token_hashes(b.column(1)):
                for row, item, tiles in own.search(w, first, coverage):
                    out.append((doc_ids[i + row], own.ids[item], sum(x[2] for x in tiles) / len(own.words[item]), len(tiles), [dict(zip(("item_at", "doc_at", "words"), x, strict=True)) for x in tiles]))
            cols = list(zip(*out, strict=True)) or [(), (), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64(), pa.int32(), _TILES), strict=True)], names=["doc_id", "item_id", "coverage", "n_tiles", "tiles"])

    return docs.mapInArrow(run, PAIRS)


def _indexes(spark: SparkSession, bench: DataFrame, min_match: int, block_words: int) -> Iterator:
    """The items' index, block by block, as broadcasts."""
    items = bench.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id is not null and text is not null")
    total = items.agg(F.sum(F.length("text") / 2)).first()[0] or 0
    blocks = max(1, math.ceil(float(total) / block_words))
    for n in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == n) if blocks > 1 else items
        got = part.orderBy("item_id").toArrow()
        ids, hashes = [], []
        own = got["item_id"].to_pylist()
        for i, j, w, first in token_hashes(got["text"].combine_chunks()):
            for r in range(j - i):
                a, b = int(first[r]), int(first[r + 1])
                if b - a >= min_match:
                    ids.append(own[i + r])
                    hashes.append(w[a:b])
        yield spark.sparkContext.broadcast(ItemIndex(ids, hashes, min_match))


def contaminated_pairs(docs: DataFrame, bench: DataFrame, min_match: int = 3, coverage: float = 0.6, id_col: str = "doc_id", text_col: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, item_id, coverage (of the item's words), n_tiles, tiles (places and lengths in words)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    out = None
    for index in _indexes(docs.sparkSession, bench, min_match, block_words):
        found = _search(rows, index, coverage)
        out = found if out is None else out.unionByName(found)
    return out


def clean(docs: DataFrame, bench: DataFrame, min_match: int = 3, coverage: float = 0.6, text_col: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows whose text no item contaminates, each judged on its own, whatever its id. Blocks of items follow each other."""
    at = docs.columns.index(text_col)

    def kept(docs: DataFrame, index) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                ok = np.ones(len(b), bool)
                for i, _, w, first in token_hashes(b.column(at).cast(pa.string())):
                    for row, _, _ in index.value.search(w, first, coverage):
                        ok[i + row] = False
                yield b.filter(pa.array(ok))

        return docs.mapInArrow(run, docs.schema)

    for n, index in enumerate(_indexes(docs.sparkSession, bench, min_match, block_words)):
        docs = kept(stash(docs) if n else docs, index)
    return docs
