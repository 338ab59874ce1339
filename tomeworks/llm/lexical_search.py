"""Ranked lexical search by Block-Max WAND.

The index has segments of documents, each built by one task from the rows it reads, so no posting is shuffled. A segment holds a sorted
dictionary of 64-bit term hashes and, term by term, postings in blocks of BLOCK documents: gaps and frequencies in as few bytes as the
block needs, and beside them, uncompressed, the first and last document and the greatest impact of the block.

A search sends a block of items to all segments. For each item the cursors of its terms are ordered by the next document they can
have; the pivot is the first document at which the terms' greatest impacts can reach the threshold, the score of the item's k-th best
document so far. From the pivot on a range of SPAN documents is considered: shallow moves over the blocks' bounds sum what the range can score,
and a range below the threshold is skipped before anything of it is decompressed. Otherwise its blocks are decompressed and scored.
A task keeps an item's best documents from segment to segment, so thresholds rise as it goes on, and returns k of them; a window ranks what all tasks return.

Scores are exact integers (see `impacts` and `weight`). Blocks of items are bounded by BLOCK_WORDS; each of them reads the index once more.

Defined results: null and empty texts hold no term and don't count among the documents; texts of any length are counted whole, a segment has at least one document;
equal scores are ranked by document id, null ids last; repeated documents are ranked each; items of equal id and text are one item, and an id
with several texts has a ranking for each; items without a term, or an empty table, give no rows. Only ids and texts are read, so further columns play no part.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import discard, doc_slices, shared_dir, stash, text_buffers
from .kernels import LOWER, word_hashes, words

#: Documents in a posting block, documents of a range, terms (with repeats) of a segment, words of a block of items.
BLOCK, SPAN, SEGMENT_TERMS, BLOCK_WORDS = 128, 256, 2_000_000, 2_000_000
#: Bytes that belong to no term become white space, A-Z become a-z.
PLAIN = LOWER.copy()
PLAIN[[c for c in range(128) if not chr(c).isalnum()]] = 0x20
#: Bytes of an index file's row groups, so that few segments are read at once.
ROW_GROUP = 32 << 20


def term_hashes(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows with the hashes of their terms: (first row, last row, hashes, first term of each row)."""
    data, offs = text_buffers(column)
    for i, j in doc_slices(offs):
        for r in range(i, j, 1 << 16):  # runs of empty texts have no bytes
            z = min(j, r + (1 << 16))
            d, o = PLAIN[data[offs[r] : offs[z]]], offs[r : z + 1] - offs[r]
            starts, ends, first = words(d, o)
            yield r, z, word_hashes(d, starts, ends), first


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term that occurs tf times adds to a document of length factor m, in units of the term's weight."""
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


def weight(docs: int, df: int) -> int:
    """A term's weight from the number of documents and of those that hold it."""
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


def corpus_size(docs: DataFrame, text_col: str = "text") -> tuple[int, int]:
    """How many documents hold a term, and how many terms all of them hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = total = 0
        for b in batches:
            for i, j, h, first in term_hashes(b.column(0)):
                n, total = n + int((np.diff(first) > 0).sum()), total + len(h)
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([total], pa.int64())], names=["n", "total"])

    got = docs.select(F.col(text_col).cast("string")).mapInArrow(run, "n long, total long").agg(F.sum("n"), F.sum("total")).first()
    return int(got[0] or 0), int(got[1] or 0)


INDEX = "corpus_docs long, corpus_terms long, terms binary, df binary, docs binary, known binary, m binary, first binary, last binary, most binary, shape binary, postings binary"
NAMES = [c.split()[0] for c in INDEX.split(", ")]
INDEX_SCHEMA = pa.schema([(c, pa.int64() if c.startswith("corpus") else pa.binary()) for c in NAMES])
#: Bytes of a gap or frequency for each of the codes 0 to 3.
WIDTHS = np.array([0, 1, 2, 4])


def _code(most: np.ndarray) -> np.ndarray:
    """The code of the least width that holds numbers up to these."""
    return np.searchsorted(np.array([0, 255, 65535]), most, "left")


def encode_blocks(doc: np.ndarray, tf: np.ndarray, head: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all blocks (which begin at head) and the shape of each: gaps between its documents, then frequencies less one."""
    size = np.diff(np.append(head, len(doc)))
    gap = np.diff(doc, prepend=doc[:1])
    gap[head] = 0
    less = tf - 1
    shape = _code(np.maximum.reduceat(gap, head)) * 4 + _code(np.maximum.reduceat(less, head))
    wide, times = WIDTHS[shape >> 2], WIDTHS[shape & 3]
    start = np.cumsum(size * (wide + times)) - size * (wide + times)
    out = np.zeros(int((size * (wide + times)).sum()), np.uint8)
    block = np.repeat(np.arange(len(head)), size)
    nth = np.arange(len(doc)) - head[block]
    for values, width, base in ((gap, wide, start), (less, times, start + size * wide)):
        for w in WIDTHS[1:].tolist():
            use = np.flatnonzero(width[block] == w)
            at = base[block[use]] + nth[use] * w
            for k in range(w):
                out[at + k] = values[use] >> (8 * k) & 255
    return out, shape.astype(np.uint8)


def build_segment(ids: list[pa.Array], lengths: np.ndarray, hashes: np.ndarray, corpus: tuple[int, int]) -> tuple:
    """One row of the index from the terms of its documents."""
    n_docs, total = corpus
    own = pa.chunked_array(ids).combine_chunks()
    m = np.array([50 + 50 * n * n_docs // max(1, total) for n in lengths.tolist()], np.int64)
    order = np.argsort(hashes, kind="stable")
    h, doc = hashes[order], np.repeat(np.arange(len(lengths), dtype=np.int64), lengths)[order]
    at = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])))) if len(h) else np.zeros(0, np.int64)
    tf, h, doc = np.diff(np.append(at, len(h))), h[at], doc[at]
    start = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else at
    df = np.diff(np.append(start, len(h)))
    nth = np.arange(len(h)) - np.repeat(start, df)
    head = np.flatnonzero(nth % BLOCK == 0)
    if len(head):
        data, shape = encode_blocks(doc, tf, head)
        most = np.maximum.reduceat(impacts(tf, m[doc]), head)
    else:
        data, shape, most = np.zeros(0, np.uint8), np.zeros(0, np.uint8), head
    last = np.append(head[1:], len(doc)) - 1
    cells = (h[start], df.astype(np.int32), own.fill_null(0).to_numpy(), own.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8), m, doc[head].astype(np.int32), doc[last].astype(np.int32), most.astype(np.int32), shape, data)
    return (n_docs, total, *(np.ascontiguousarray(c).tobytes() for c in cells))


def build_index(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the index of all documents to a folder that all executors share, and reads it."""
    corpus = corpus_size(docs, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, lengths, hashes, size = [], [], [], 0

        def flush() -> pa.RecordBatch:
            row = build_segment(ids, np.concatenate(lengths), np.concatenate(hashes), corpus)
            return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(row, INDEX_SCHEMA.types, strict=True)], schema=INDEX_SCHEMA)

        for b in batches:
            for i, j, h, first in term_hashes(b.column(1)):
                ids.append(b.column(0).slice(i, j - i))
                lengths.append(np.diff(first))
                hashes.append(h)
                size += len(h) + j - i
                if size >= SEGMENT_TERMS:
                    yield flush()
                    ids, lengths, hashes, size = [], [], [], 0
        if ids:
            yield flush()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    rows.mapInArrow(run, INDEX).write.option("compression", "lz4_raw").option("parquet.block.size", ROW_GROUP).parquet(path)
    out = docs.sparkSession.read.schema(INDEX).parquet(path)
    out._stash = path
    return out


@dataclass
class Segment:
    """A row of the index, opened: arrays share its bytes."""

    terms: np.ndarray
    df: np.ndarray
    docs: np.ndarray
    known: np.ndarray
    m: np.ndarray
    first: np.ndarray
    last: np.ndarray
    most: np.ndarray
    shape: np.ndarray
    data: np.ndarray
    opened: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        blocks = -(-self.df // BLOCK)
        #: The first block of each term, and the postings and place of each block.
        self.block = np.concatenate(([0], np.cumsum(blocks)))
        self.size = np.full(len(self.first), BLOCK, np.int64)
        self.size[self.block[1:] - 1] = self.df - (blocks - 1) * BLOCK
        self.at = np.concatenate(([0], np.cumsum(self.size * (WIDTHS[self.shape >> 2] + WIDTHS[self.shape & 3]))))

    def open(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """The documents of a block and their impacts; decompressed once."""
        got = self.opened.get(b)
        if got is None:
            n, wide, times = int(self.size[b]), int(WIDTHS[self.shape[b] >> 2]), int(WIDTHS[self.shape[b] & 3])
            raw = self.data[self.at[b] : self.at[b + 1]].tobytes()
            gap = np.frombuffer(raw, f"<u{wide}", n).astype(np.int64) if wide else np.zeros(n, np.int64)
            tf = np.frombuffer(raw, f"<u{times}", n, n * wide).astype(np.int64) + 1 if times else np.ones(n, np.int64)
            doc = int(self.first[b]) + np.cumsum(gap)
            got = self.opened[b] = doc, impacts(tf, self.m[doc])
        return got


def open_segment(cells: tuple) -> Segment:
    kinds = ("<u8", "<i4", "<i8", "u1", "<i8", "<i4", "<i4", "<i4", "u1", "u1")
    return Segment(*(np.frombuffer(c, k) for c, k in zip(cells, kinds, strict=True)))


@dataclass
class Best:
    """The k best documents of an item so far."""

    k: int
    score: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    doc: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    known: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint8))
    #: A document with less can't be among them; one with as much can, by its id.
    least: int = 1

    def add(self, score: np.ndarray, doc: np.ndarray, known: np.ndarray) -> None:
        score, doc, known = np.concatenate((self.score, score)), np.concatenate((self.doc, doc)), np.concatenate((self.known, known))
        top = np.lexsort((doc, 1 - known, -score))[: self.k]
        self.score, self.doc, self.known = score[top], doc[top], known[top]
        if len(top) == self.k:
            self.least = int(self.score[-1])


def search_segment(seg: Segment, term: np.ndarray, weights: np.ndarray, best: Best) -> None:
    """Block-Max WAND of one item over one segment: term has the places of its terms in the segment's dictionary."""
    block, end = seg.block[term].copy(), seg.block[term + 1]
    first, last, most = seg.first, seg.last, seg.most
    # the greatest impact of a term in the segment, over all its blocks
    width = end - block
    flat = np.repeat(block - np.cumsum(width) + width, width) + np.arange(int(width.sum()))
    ceiling = np.maximum.reduceat(most[flat], np.cumsum(width) - width) * weights
    final, d, top = end - 1, 0, len(seg.docs)
    while d < top:
        while (move := last[np.minimum(block, final)] < d).any():  # shallow: only bounds are read
            move &= block < end
            if not move.any():
                break
            block += move
        live = np.flatnonzero(block < end)
        if not len(live):
            return
        can = np.maximum(first[block[live]], d)
        order = np.argsort(can, kind="stable")
        reach = np.cumsum(ceiling[live][order])
        pivot = int(np.searchsorted(reach, best.least))
        if pivot == len(reach):
            return
        p = int(can[order[pivot]])
        stop = min(top, p + SPAN)
        use, weigh, last_of = block[live].copy(), weights[live], end[live]
        fin = last_of - 1
        while (move := (use < last_of) & (last[np.minimum(use, fin)] < p)).any():
            use += move
        begin, bound = use.copy(), np.zeros(len(live), np.int64)
        while (inside := (use < last_of) & (first[np.minimum(use, fin)] < stop)).any():
            bound = np.where(inside, np.maximum(bound, most[np.minimum(use, fin)]), bound)
            use += inside
        if int((bound * weigh).sum()) >= best.least:
            score = np.zeros(stop - p, np.int64)
            for a, z, w in zip(begin.tolist(), use.tolist(), weigh.tolist(), strict=True):
                for b in range(a, z):
                    doc, impact = seg.open(b)
                    if first[b] < p or last[b] >= stop:
                        x, y = np.searchsorted(doc, (p, stop))
                        doc, impact = doc[x:y], impact[x:y]
                    score[doc - p] += w * impact
            got = np.flatnonzero(score >= best.least)
            if len(got):
                best.add(score[got], seg.docs[p + got], seg.known[p + got])
        d = stop


@dataclass
class Items:
    """A block of items: their keys and ids, and the places of each one's terms among all terms of the block."""

    keys: list[int]
    ids: list[int | None]
    terms: np.ndarray
    own: list[np.ndarray]
    weights: np.ndarray | None = None


def _item_blocks(items: DataFrame, id_col: str, text_col: str, block_words: int) -> Iterator[Items]:
    rows = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text")).where("text is not null").distinct()
    total = rows.agg(F.sum(F.length("text") / 2)).first()[0] or 0
    blocks = max(1, math.ceil(float(total) / block_words))
    for n in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == n) if blocks > 1 else rows
        got = part.orderBy("item_id", "text").toArrow()
        ids, own = got["item_id"].to_pylist(), []
        for i, j, h, first in term_hashes(got["text"].combine_chunks()):
            own += [np.unique(h[first[r] : first[r + 1]]) for r in range(j - i)]
        terms = np.unique(np.concatenate([np.zeros(0, np.uint64), *own]))
        yield Items([(n << 40) + r for r in range(len(ids))], ids, terms, [np.searchsorted(terms, t) for t in own])


def _frequencies(index: DataFrame, items: Items) -> np.ndarray:
    """How many documents hold each of the block's terms."""
    sent = index.sparkSession.sparkContext.broadcast(items.terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        want = sent.value
        total = np.zeros(len(want), np.int64)
        for b in batches:
            for terms, df in zip(b.column(0), b.column(1), strict=True):
                own, n = np.frombuffer(terms.as_buffer(), "<u8"), np.frombuffer(df.as_buffer(), "<i4")
                if len(own):
                    at = np.minimum(np.searchsorted(own, want), len(own) - 1)
                    total += np.where(own[at] == want, n[at], 0)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], names=["term", "df"])

    got = index.select("terms", "df").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    out = np.zeros(len(items.terms), np.int64)
    out[got["term"].to_numpy()] = got["df"].to_numpy()
    return out


FOUND = "item long, item_id long, doc_id long, score long"


def _best(index: DataFrame, items: Items, k: int) -> DataFrame:
    """Each task's k best documents of each item."""
    sent = index.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q: Items = sent.value
        best = [Best(k) for _ in q.keys]
        for b in batches:
            for r in range(len(b)):
                seg = open_segment(tuple(c[r].as_py() for c in b.columns))
                if not len(seg.terms):
                    continue
                at = np.minimum(np.searchsorted(seg.terms, q.terms), len(seg.terms) - 1)
                here = (seg.terms[at] == q.terms) & (q.weights > 0)
                for own, top in zip(q.own, best, strict=True):
                    own = own[here[own]]
                    if len(own):
                        search_segment(seg, at[own], q.weights[own], top)
        n = [len(x.doc) for x in best]
        cat = lambda parts, kind: np.concatenate([np.zeros(0, kind), *parts])
        keep = cat([x.known for x in best], np.uint8).astype(bool)
        ids = pa.array(q.ids, pa.int64()).take(pa.array(np.repeat(np.arange(len(n)), n)))
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array(q.keys, np.int64), n)), ids, pa.array(cat([x.doc for x in best], np.int64), mask=~keep), pa.array(cat([x.score for x in best], np.int64))], names=["item", "item_id", "doc_id", "score"])

    return index.drop("corpus_docs", "corpus_terms").mapInArrow(run, FOUND)


def search(index: DataFrame, items: DataFrame, k: int = 50, id_col: str = "item_id", text_col: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each item, from an index that build_index wrote."""
    size = index.agg(F.max("corpus_docs")).first()[0] or 0
    out = None
    for block in _item_blocks(items, id_col, text_col, block_words):
        block.weights = np.array([weight(size, df) for df in _frequencies(index, block).tolist()], np.int64)
        found = _best(index, block, k)
        out = found if out is None else out.unionByName(found)
    by = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = out.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """search over an index that is made for it and deleted afterwards."""
    index = build_index(docs, f"{shared_dir(docs.sparkSession)}/index-{uuid.uuid4().hex}")
    out = stash(search(index, items, k))
    discard(index)
    return out


#: The same rows in DuckDB's SQL, by scoring all pairs that share a term.
SQL = r"""
WITH d AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM documents),
i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
n AS (SELECT doc_id, count(*) AS n FROM d GROUP BY 1), c AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM n),
m AS (SELECT doc_id, 50 + (50 * n * docs) // terms AS m FROM n, c),
p AS (SELECT doc_id, t, count(*) AS tf FROM d WHERE t IN (SELECT t FROM i) GROUP BY 1, 2),
w AS (SELECT t, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, c GROUP BY 1),
s AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score FROM i JOIN w USING (t) JOIN p USING (t) JOIN m USING (doc_id) GROUP BY 1, 2),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM s WHERE score > 0)
SELECT * FROM r WHERE rank <= 50
"""
