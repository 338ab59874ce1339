"""N-gram Jaccard join by vertical partitioning.

A document's set is its distinct k-word shingles, lower-cased over A-Z. The global order of shingles is cut into
fragments that are handled apart from each other:

1. each fragment counts its shingles over all documents; per document the partial numbers of shingles that occur
   nowhere else are summed. A document of n shingles with more than n - ceil(t n) such ones can have no partner.
2. The others order the rest of their shingles by frequency, rarest first; two sets with similarity t share one of
   their first n - ceil(t n) + 1 shingles (prefix filter, which holds for any global order). Fragments of those
   prefixes link documents into families, and say which pairs of a family's blocks hold candidate pairs.
3. The shingles of a pair of blocks are cut into fragments, PARTS at least and of bounded size; each counts the partial overlaps
   of the pairs of sets in it by itself, and a second shuffle sums them per pair and holds the sums against the threshold.
   Pairs travel as packed counts, one row for each pair of blocks and fragment, and what comes out are numbers
   of links and a spanning forest, so that a group of thousands of near copies gives no row for each pair.

A block has the sets of a family whose rarest shared shingle is the same, as far as they fit, so that a family of many small groups
has few pairs of blocks with candidates. Equal sets are collapsed, first in each batch and then over all, and take part
once, with their multiplicity. Shingles are told apart by 64-bit hashes throughout, equal sets by two digests of them.

Defined results: null or empty text, or text without words: 0 shingles, no links, its own component. Repeated
rows (equal doc_id): each gets a row of the result, and they are copies of each other only if their texts are. Ties (a
similarity of exactly the threshold) are links. Null doc_id: kept, with null component. An empty table gives no rows.
Further columns of the input play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import vertical as V
from .base import blob, discard, doc_slices, fragments, free_name, stash, text_buffers
from .components import components
from .kernels import labels, lower_ascii, mix, shingles

#: Sets in a block, and of one rarest shingle in it; a task has two blocks, or as many sets of small families.
BLOCK, CLUMP = 128, 32
#: Shingles of a pair of blocks in one fragment.
PART_ITEMS = 1_000_000
#: Fragments of a pair of blocks at least.
PARTS = 4
#: Shingles of a family that more sets than this have are counted by matrix products, others by listing pairs.
DENSE_DF, DENSE_SETS = 12, 64
DOC = "row long, doc_id long, n int, d1 long, d2 long, lead long, items binary, prefix binary"
DOC_SCHEMA = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int32()), ("d1", pa.int64()), ("d2", pa.int64()), ("lead", pa.int64()), ("items", pa.binary()), ("prefix", pa.binary())])
HEAD = np.dtype([("doc_id", "<i8"), ("n", "<i4"), ("d1", "<i8"), ("d2", "<i8"), ("set", "<i4")])
#: How often a shingle occurs, as far as it counts for the order of frequency.
COMMON = 65535


def _digests(items: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each sorted set."""
    n = np.diff(bounds)
    out = []
    for salt in (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25):
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(items ^ np.uint64(salt)), dtype=np.uint64)))
        out.append((sums[bounds[1:]] - sums[bounds[:-1]] + n.astype(np.uint64)).view(np.int64))
    return out[0], out[1]


def _to_cells(k: int, frags: int):
    """Shingles of the distinct sets of each batch, as cells; the batch's own row has its documents, and who has its repeated shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held, size = V.batch_ids(), [], 0

        def flush() -> pa.RecordBatch:
            head = np.concatenate([h for h, _ in held])
            items = np.concatenate([x for _, x in held])
            # equal sets of the batch go once, under the document of smallest id
            order = np.lexsort((head["doc_id"], head["d2"], head["d1"]))
            d = head[order]
            new = np.concatenate(([True], (d["d1"][1:] != d["d1"][:-1]) | (d["d2"][1:] != d["d2"][:-1])))
            head["set"][order] = order[new][np.cumsum(new) - 1]
            own = np.repeat(head["set"] == np.arange(len(head)), head["n"])
            items, doc = items[own], np.repeat(np.arange(len(head)), head["n"])[own].astype(np.uint32)
            single, multi, times, where = V.divide(items)
            owners = doc[where]
            items, doc = items[single], doc[single]
            frag = V.fragment_of(items, frags)
            at, edge = V.cut(items, frags)
            items = items[at]
            far = np.searchsorted(V.fragment_of(multi, frags), np.arange(frags + 1))
            batch = next(ids)
            rows = [V.row(-1, batch, V.pack(head, frag.astype(V.frag_kind(frags)), np.bincount(doc, minlength=len(head)).astype(np.uint32), multi, times.astype(np.uint32), owners))]
            for f in np.flatnonzero((np.diff(edge) > 0) | (np.diff(far) > 0)).tolist():
                p, q = far[f], far[f + 1]
                rows.append(V.row(f, batch, V.shorten(items[edge[f] : edge[f + 1]]), None, V.shorten(multi[p:q]), blob(times[p:q].astype(np.uint32))))
            return V.record_batch(rows)

        for b in batches:
            data, offs = text_buffers(b.column(1))
            doc_ids = b.column(0).to_numpy(zero_copy_only=False)
            for i, j in doc_slices(offs):
                for r in range(i, j, 1 << 16):  # runs of empty texts have no bytes
                    z = min(j, r + (1 << 16))
                    items, bounds = shingles(lower_ascii(data[offs[r] : offs[z]]), offs[r : z + 1] - offs[r], k)
                    head = np.zeros(z - r, HEAD)
                    head["doc_id"], head["n"] = doc_ids[r:z], np.diff(bounds)
                    head["d1"], head["d2"] = _digests(items, bounds)
                    held.append((head, items))
                    size += len(items) + z - r
                    if size >= V.BATCH_ITEMS:
                        yield flush()
                        held, size = [], 0
        if held:
            yield flush()

    return run


def _count(frags: int):
    """A fragment's answer to each batch: which of its single items occur elsewhere (packed bits, behind their number), those
    items with their counts, and the counts of the batch's repeated items."""

    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        f = key[0].as_py()
        if f < 0:
            return t
        raw = V.arrays(t["items"], np.uint8)
        items, multi = ([V.whole(x, f, frags) for x in column] for column in (raw, V.arrays(t["multi"], np.uint8)))
        counts, again = V.fragment_counts(items, multi, V.arrays(t["times"], np.uint32))
        cap = lambda v: np.minimum(v, COMMON).astype(np.uint16)
        rows = []
        for batch, x, c, a in zip(t["batch"].to_pylist(), items, counts, again, strict=True):
            rows.append(V.row(f, batch, V.shorten(x[c > 1]), V.pack(np.array([len(c)]), np.packbits(c > 1)), None, V.pack(cap(c[c > 1]), cap(a))))
        return pa.Table.from_batches([V.record_batch(rows)])

    return run


def needed(n: np.ndarray, percent: int) -> np.ndarray:
    """The least overlap that a set of n items has with a partner: ceil(t n)."""
    return (n.astype(np.int64) * percent + 99) // 100


def _gather(percent: int, frags: int):
    """Sums the fragments' answers of one batch: all its documents; lead is null where a set has neither a copy nor a
    possible partner; items and prefix go with one document of each set that may have partners."""

    def run(t: pa.Table) -> pa.Table:
        head, bits, items, counts, again = None, [], [np.zeros(0, np.uint64)], [], []
        for f, x, s, c in sorted(zip(t["frag"].to_pylist(), V.arrays(t["items"], np.uint8), V.arrays(t["sizes"], np.uint8), V.arrays(t["times"], np.uint8), strict=True), key=lambda r: r[0]):
            if f < 0:
                head, frag, sizes, multi, times, owners = V.unpack(x, HEAD, V.frag_kind(frags), np.uint32, np.uint64, np.uint32, np.uint32)
                continue
            n, b = V.unpack(s, np.int64, np.uint8)
            bits.append(np.unpackbits(b, count=int(n[0])) if n[0] else b[:0])
            items.append(V.whole(x, f, frags))
            for parts, y in zip((counts, again), V.unpack(c, np.uint16, np.uint16), strict=True):
                parts.append(y)
        if head is None:
            raise RuntimeError("a batch lost its documents")
        docs, none = len(head), np.zeros(0, np.uint16)
        # answers come in the order of fragments, and within one in that of the documents
        doc, more = np.repeat(np.arange(docs), sizes)[np.argsort(frag, kind="stable")], np.concatenate([none, *bits]).astype(bool)
        lone = np.bincount(doc[~more], minlength=docs)
        doc, items = np.concatenate([doc[more], owners]).astype(np.int64), np.concatenate([*items, np.repeat(multi, times)])
        counts = np.concatenate([*counts, np.repeat(np.concatenate([none, *again]), times)])
        n = head["n"].astype(np.int64)
        first = n - needed(n, percent) + 1  # length of the prefix
        some = (n > 0) & (lone[head["set"]] < first)
        own = some & (head["set"] == np.arange(docs))
        out_items: list = [None] * docs
        out_prefix: list = [None] * docs
        lead = np.zeros(docs, np.int64)
        use = own[doc]
        doc, items, counts = doc[use], items[use], counts[use]
        order = np.lexsort((items, counts, doc))
        doc, items = doc[order], items[order]
        bounds = np.searchsorted(doc, np.arange(docs + 1))
        for i in np.flatnonzero(own):
            x = items[bounds[i] : bounds[i + 1]]
            lead[i] = x[:1].view(np.int64)[0]
            out_prefix[i] = blob(x[: first[i] - lone[i]])
            out_items[i] = blob(np.sort(x))
        copied = (np.bincount(head["set"], minlength=docs) > 1)[head["set"]] & (n > 0)
        lead = pa.array(lead[head["set"]], mask=~(some | copied))
        row = (t["batch"][0].as_py() << 22) + np.arange(docs)  # a batch has no more than 2 ** 22 documents
        return pa.table([pa.array(row), pa.array(head["doc_id"]), pa.array(head["n"]), pa.array(head["d1"]), pa.array(head["d2"]), lead, pa.array(out_items, pa.binary()), pa.array(out_prefix, pa.binary())], schema=DOC_SCHEMA)

    return run


def _prefix_cells(frags: int):
    """Distinct prefix items of each batch of sets with one owner each; the batch's own row links the sets that share one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = V.batch_ids()
        for b in batches:
            if not len(b):
                continue
            node, parts = b.column(0).to_numpy(), V.arrays(b.column(1), np.uint64)
            own = np.repeat(np.arange(len(node)), [len(p) for p in parts])
            items, owner, (p, q) = _share(np.concatenate(parts), own)
            up = labels(len(node), p, q)
            far = np.flatnonzero(up != np.arange(len(node)))
            edge = np.searchsorted(V.fragment_of(items, frags), np.arange(frags + 1))
            batch = next(ids)
            rows = [V.row(-1, batch, blob(node[up[far]]), blob(node[far]))]
            rows += [V.row(f, batch, blob(items[edge[f] : edge[f + 1]]), blob(node[owner[edge[f] : edge[f + 1]]])) for f in np.flatnonzero(np.diff(edge)).tolist()]
            yield V.record_batch(rows)

    return run


def _share(items: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """Distinct sorted items with one owner each, and chains of the owners of each item."""
    order = np.argsort(items, kind="stable")
    items, owner = items[order], owner[order]
    same = np.flatnonzero(items[1:] == items[:-1])
    new = np.concatenate(([True], items[1:] != items[:-1])) if len(items) else np.zeros(0, bool)
    return items[new], owner[new], (owner[same], owner[same + 1])


EDGE_SCHEMA = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _families(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
    """A spanning forest of the sets of one fragment that share a prefix item."""
    a, b = V.arrays(t["items"], np.uint64), V.arrays(t["sizes"], np.int64)
    if key[0].as_py() < 0:
        return pa.table([pa.array(np.concatenate(a).view(np.int64)), pa.array(np.concatenate(b))], schema=EDGE_SCHEMA)
    node, own = np.unique(np.concatenate(b), return_inverse=True)
    _, _, (p, q) = _share(np.concatenate(a), own)
    up = labels(len(node), p, q)
    far = np.flatnonzero(up != np.arange(len(node)))
    return pa.table([pa.array(node[up[far]]), pa.array(node[far])], schema=EDGE_SCHEMA)


PLACE = np.dtype([("item", "<u8"), ("family", "<i8"), ("block", "<i4"), ("sets", "<i4")])


def _block_cells(frags: int):
    """Distinct (prefix item, family, block) of each batch of sets, with the number of its sets (1 or 2 for more)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = V.batch_ids()
        for b in batches:
            if not len(b):
                continue
            parts = V.arrays(b.column(2), np.uint64)
            n = [len(p) for p in parts]
            rows = np.zeros(sum(n), PLACE)
            rows["item"], rows["family"], rows["block"], rows["sets"] = np.concatenate(parts), np.repeat(b.column(0).to_numpy(), n), np.repeat(b.column(1).to_numpy(), n), 1
            rows, batch = _places(rows), next(ids)
            edge = np.searchsorted(V.fragment_of(rows["item"], frags), np.arange(frags + 1))
            yield V.record_batch([V.row(f, batch, blob(rows[edge[f] : edge[f + 1]])) for f in np.flatnonzero(np.diff(edge)).tolist()] or [V.row(0, batch)])

    return run


def _places(rows: np.ndarray) -> np.ndarray:
    """Rows of equal item, family and block as one, sorted."""
    rows = rows[np.lexsort((rows["block"], rows["family"], rows["item"]))]
    if not len(rows):
        return rows
    edge = np.flatnonzero(np.concatenate(([True], (rows["item"][1:] != rows["item"][:-1]) | (rows["family"][1:] != rows["family"][:-1]) | (rows["block"][1:] != rows["block"][:-1]))))
    out = rows[edge]
    out["sets"] = np.minimum(np.add.reduceat(rows["sets"], edge), 2)
    return out


BLOCKS_SCHEMA = pa.schema([("family", pa.int64()), ("blocks", pa.list_(pa.int32())), ("twice", pa.list_(pa.int32()))])


def _block_lists(t: pa.Table) -> pa.Table:
    """Of this fragment, each different list of a family's blocks that share a prefix item, and the blocks that hold an item twice."""
    rows = _places(np.concatenate(V.arrays(t["items"], PLACE)))
    edge = np.flatnonzero(np.concatenate(([True], (rows["item"][1:] != rows["item"][:-1]) | (rows["family"][1:] != rows["family"][:-1]), [True]))) if len(rows) else np.zeros(0, np.int64)
    seen: set[tuple[int, bytes]] = set()
    got: list[tuple[int, list, list]] = []
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        family, block = int(rows["family"][a]), rows["block"][a:b]
        if b - a > 1 and (key := (family, block.tobytes())) not in seen:
            seen.add(key)
            got.append((family, block.tolist(), []))
    many = rows[rows["sets"] > 1]
    own = np.unique(np.stack([many["family"], many["block"].astype(np.int64)], 1), axis=0)
    got += [(int(part[0, 0]), [], part[:, 1].tolist()) for part in np.split(own, np.flatnonzero(np.diff(own[:, 0])) + 1) if len(part)]
    return pa.table([pa.array([x[c] for x in got], kind) for c, kind in enumerate(BLOCKS_SCHEMA.types)], schema=BLOCKS_SCHEMA)


def block_pairs(cells: DataFrame) -> DataFrame:
    """family, i, j: the pairs of a family's blocks in which two sets share a prefix item. Spark unrolls the lists row by row,
    so that no task holds the pairs of a family."""
    lists = cells.groupBy("frag").applyInArrow(_block_lists, "family long, blocks array<int>, twice array<int>").distinct()
    lists = stash(lists)
    same = lists.select("family", F.explode("twice").alias("i")).withColumn("j", F.col("i"))
    left = lists.select("family", "blocks", F.posexplode("blocks").alias("at", "i"))
    cross = left.select("family", "i", F.explode(F.slice("blocks", F.col("at") + 2, F.size("blocks"))).alias("j"))
    pairs = stash(same.unionByName(cross).distinct())
    discard(lists)
    return pairs


SLICE = "g long, i int, j int, v int, block int, family long, doc_id long, n int, mult long, items binary"
SLICE_NAMES = [c.split()[0] for c in SLICE.split(", ")]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sets of a pair of blocks, once for each fragment of its items. All sets go to all fragments, so that each of them
    numbers the sets alike."""
    for b in batches:
        at, v, items = [], [], []
        for r, (parts, x) in enumerate(zip(b.column("parts").to_pylist(), V.arrays(b.column("items"), np.uint64), strict=True)):
            edge = np.searchsorted(V.fragment_of(x, parts), np.arange(parts + 1))
            at += [r] * parts
            v += range(parts)
            items += [blob(x[p:q]) for p, q in zip(edge[:-1], edge[1:], strict=True)]
        take = b.take(pa.array(at, pa.int64()))
        more = {"v": pa.array(v, pa.int32()), "items": pa.array(items, pa.binary())}
        yield pa.RecordBatch.from_arrays([more[c] if c in more else take.column(c) for c in SLICE_NAMES], names=SLICE_NAMES)


def overlaps(items: np.ndarray, doc: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """p * docs + q of all pairs of sets (p < q) with common items, sorted, and how many they have."""
    order = np.argsort(items, kind="stable")
    items, doc = items[order], doc[order]
    edge = np.flatnonzero(np.concatenate(([True], items[1:] != items[:-1], [True]))) if len(items) else np.zeros(1, np.int64)
    size = np.diff(edge)
    total = np.zeros((docs, docs), np.float32) if docs > DENSE_SETS else None
    dense = size > (DENSE_DF if total is not None else 1 << 60)
    if total is not None and dense.any():
        use, col = np.repeat(dense, size), np.repeat(np.cumsum(dense) - 1, size)
        d, c = doc[use], col[use]
        for a in range(0, int(dense.sum()), 2048):
            lo, hi = np.searchsorted(c, (a, a + 2048))
            m = np.zeros((docs, 2048), np.float32)
            m[d[lo:hi], c[lo:hi] - a] = 1
            total += m @ m.T
    keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if total is not None:
        p, q = np.nonzero(np.triu(total, 1))
        keys.append(p * docs + q)
        counts.append(total[p, q].astype(np.int64))
    for length in np.unique(size[(size > 1) & ~dense]).tolist():
        rows = np.sort(doc[edge[:-1][(size == length) & ~dense][:, None] + np.arange(length)], axis=1)
        p, q = np.triu_indices(length, 1)
        step = max(1, 4_000_000 // (length * length))
        for a in range(0, len(rows), step):
            part = rows[a : a + step]
            key, c = np.unique((part[:, p].astype(np.int64) * docs + part[:, q]).ravel(), return_counts=True)
            keys.append(key)
            counts.append(c)
    key, inv = np.unique(np.concatenate(keys), return_inverse=True)
    return key, np.bincount(inv, np.concatenate(counts), minlength=len(key)).astype(np.int64)


SUM = "g long, i int, j int, v int, docs binary, pairs binary"
SUM_SCHEMA = pa.schema([("g", pa.int64()), ("i", pa.int32()), ("j", pa.int32()), ("v", pa.int32()), ("docs", pa.binary()), ("pairs", pa.binary())])
SET = np.dtype([("id", "<i8"), ("n", "<i8"), ("mult", "<i8")])
PAIR = np.dtype([("p", "<u4"), ("q", "<u4"), ("c", "<u4")])


def _partial(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
    """One fragment of a pair of blocks: the partial overlaps of its pairs, sets numbered in order of their ids."""
    g, i, j, v = (k.as_py() for k in key)
    t = t.take(pa.array(np.argsort(t["doc_id"].to_numpy(), kind="stable")))
    fam, block = t["family"].to_numpy(), t["block"].to_numpy()
    docs = np.zeros(len(t), SET)
    docs["id"], docs["n"], docs["mult"] = t["doc_id"].to_numpy(), t["n"].to_numpy(), t["mult"].to_numpy()
    items = V.arrays(t["items"], np.uint64)
    out = [np.zeros(0, PAIR)]
    order = np.argsort(fam, kind="stable")
    for own in np.split(order, np.flatnonzero(np.diff(fam[order])) + 1):
        if len(own) < 2:
            continue
        pairs, count = overlaps(np.concatenate([items[k] for k in own]), np.repeat(np.arange(len(own)), [len(items[k]) for k in own]), len(own))
        p, q = own[pairs // len(own)], own[pairs % len(own)]
        cross = block[p] != block[q] if i != j else np.ones(len(p), bool)
        part = np.zeros(int(cross.sum()), PAIR)
        part["p"], part["q"], part["c"] = p[cross], q[cross], count[cross]
        out.append(part)
    return pa.table([pa.array([x], kind) for x, kind in zip((g, i, j, v, docs.tobytes() if v == 0 else None, np.concatenate(out).tobytes()), SUM_SCHEMA.types, strict=True)], schema=SUM_SCHEMA)


OUT_SCHEMA = pa.schema([("kind", pa.int32()), ("a", pa.int64()), ("b", pa.int64())])


def _sum(percent: int):
    """The overlap of each pair over all fragments: numbers of links, and a spanning forest of them."""

    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        docs = np.concatenate(V.arrays(t["docs"], SET))
        parts = np.concatenate(V.arrays(t["pairs"], PAIR))
        pair, inv = np.unique(parts["p"].astype(np.int64) * max(1, len(docs)) + parts["q"], return_inverse=True)
        c = np.bincount(inv, parts["c"], minlength=len(pair)).astype(np.int64)
        p, q = pair // max(1, len(docs)), pair % max(1, len(docs))
        ok = 100 * c >= percent * (docs["n"][p] + docs["n"][q] - c)
        p, q = p[ok], q[ok]
        links = np.zeros(len(docs), np.int64)
        np.add.at(links, p, docs["mult"][q])
        np.add.at(links, q, docs["mult"][p])
        up = labels(len(docs), p, q)
        far, got = np.flatnonzero(up != np.arange(len(docs))), np.flatnonzero(links)
        ids, kind = docs["id"], np.concatenate((np.ones(len(far), np.int32), np.zeros(len(got), np.int32)))
        return pa.table([pa.array(kind), pa.array(np.concatenate((ids[up[far]], ids[got]))), pa.array(np.concatenate((ids[far], links[got])))], schema=OUT_SCHEMA)

    return run


def _pow2(x):
    return F.pow(F.lit(2), F.ceil(F.log2(F.greatest(x, F.lit(1.0))))).cast("int")


def _placed(sets: DataFrame, family: DataFrame, frags: int) -> DataFrame:
    """The sets of each pair of blocks (g, i, j) that holds candidates, with the number of fragments (parts) for its items."""
    size = (F.octet_length("items") / 8).alias("size")
    member = stash(sets.select(F.col("doc_id").alias("node"), "lead", size).join(family, "node").withColumnRenamed("component", "family"))
    sizes = member.groupBy("family").agg(F.count("*").alias("members"), F.sum("size").alias("size"))
    sizes = sizes.withColumn("big", (F.col("members") > BLOCK) | (F.col("size") > PART_ITEMS))
    sizes = sizes.withColumn("blocks", F.when(F.col("big"), F.ceil(F.col("members") / BLOCK)).otherwise(1).cast("int"))
    sizes = stash(sizes.withColumn("parts", F.when(F.col("big"), _pow2(F.col("size") / F.col("members") * F.least(F.col("members"), F.lit(2.0 * BLOCK)) / PART_ITEMS)).otherwise(1)).withColumn("parts", F.greatest("parts", F.lit(PARTS))))
    small = sizes.where("not big").agg(F.coalesce(F.sum("members") / (2 * BLOCK), F.lit(0)).alias("n"), F.coalesce(F.sum("size") / PART_ITEMS, F.lit(0)).alias("s")).first()
    packs = max(1, int(max(small["n"], small["s"])))
    member = member.drop("size").join(sizes.select("family", "big", "blocks", "parts"), "family")
    pack = -1 - F.pmod(F.xxhash64("family"), F.lit(packs))
    few = member.where("not big").select(F.col("node").alias("doc_id"), "family", pack.alias("g"), F.lit(0).alias("block"), F.lit(0).alias("i"), F.lit(0).alias("j"), "parts")
    # sets of one rarest item stay together in clumps, and clumps are dealt out to the family's blocks
    big = member.where("big")
    clumps = big.groupBy("family", "lead").agg(F.ceil(F.count("*") / CLUMP).alias("clumps"))
    big = big.join(clumps, ["family", "lead"]).withColumn("block", F.pmod(F.xxhash64("lead", F.pmod(F.xxhash64("node"), F.col("clumps"))), F.col("blocks")).cast("int"))
    big = stash(big.select(F.col("node").alias("doc_id"), "family", "block", "parts"))
    shared = sets.select("doc_id", "prefix").join(big, "doc_id").select("family", "block", "prefix").mapInArrow(_block_cells(frags), V.CELLS)
    pairs = block_pairs(shared)
    each = pairs.select("family", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("block"))
    many = big.join(each, ["family", "block"]).select("doc_id", "family", F.col("family").alias("g"), "block", "i", "j", "parts")
    return sets.select("doc_id", "n", "mult", "items").join(few.unionByName(many), "doc_id")


def ngram_jaccard_join(docs: DataFrame, k: int = 5, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, n_links (to documents of another or equal set), component_id; see the module's text."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    known = rows.where("doc_id is not null")
    frags = fragments(known)
    cells = known.mapInArrow(_to_cells(k, frags), V.CELLS)
    told = cells.groupBy("frag", F.when(F.col("frag") < 0, F.col("batch")).alias("own")).applyInArrow(_count(frags), V.CELLS)
    t = stash(told.groupBy("batch").applyInArrow(_gather(percent, frags), DOC))
    same = t.where("lead is not null").groupBy("d1", "d2").agg(F.min(F.struct("doc_id", "row")).alias("first"), F.count("*").alias("mult"))
    same = stash(same.select("d1", "d2", F.col("first.doc_id").alias("rep"), F.col("first.row").alias("row"), "mult"))
    # an id that stands for several sets is the node of one of them, the others have a hash for a node
    shared = same.groupBy("rep").agg(F.min(F.struct("d1", "d2")).alias("own"), F.count("*").alias("sets")).where("sets > 1")
    node = F.when(F.col("own").isNull() | (F.col("own") == F.struct("d1", "d2")), F.col("rep")).otherwise(F.xxhash64("d1", "d2"))
    same = stash(same.join(shared, "rep", "left").withColumn("node", node).drop("own", "sets"))
    sets = stash(t.where("items is not null").select("row", "n", "lead", "items", "prefix").join(same.select("row", "node", "mult"), "row").select(F.col("node").alias("doc_id"), "n", "mult", "lead", "items", "prefix"))
    edges = sets.select("doc_id", "prefix").mapInArrow(_prefix_cells(frags), V.CELLS)
    edges = edges.groupBy("frag", F.when(F.col("frag") < 0, F.col("batch")).alias("own")).applyInArrow(_families, "a long, b long")
    family = components(edges)
    slices = _placed(sets, family, frags).mapInArrow(_slices, SLICE)
    partial = slices.groupBy("g", "i", "j", "v").applyInArrow(_partial, SUM)
    found = stash(partial.groupBy("g", "i", "j").applyInArrow(_sum(percent), "kind int, a long, b long"))
    # an id's sets stay apart unless their texts are linked; a component's name is its smallest id
    comp = components(found.where("kind = 1"))
    links = found.where("kind = 0").groupBy("a").agg(F.sum("b").alias("more")).withColumnRenamed("a", "node")
    classes = stash(same.join(links, "node", "left").join(comp, "node", "left").withColumn("component", F.coalesce("component", "node")))
    least = classes.groupBy("component").agg(F.min("rep").alias("least"))
    classes = stash(classes.join(least, "component").select("d1", "d2", F.col("least").alias("component"), (F.col("mult") - 1 + F.coalesce("more", F.lit(0))).alias("links")))
    discard(sets, found)
    linked = t.where("lead is not null").select("doc_id", "n", "d1", "d2").join(classes, ["d1", "d2"], "left")
    alone = t.where("lead is null").select("doc_id", "n", F.col("doc_id").alias("component"), F.lit(0).cast("long").alias("links"))
    out = linked.select("doc_id", "n", "component", "links").unionByName(alone)
    lost = rows.where("doc_id is null").mapInArrow(_only_sizes(k), "doc_id long, n int").select("doc_id", "n", F.lit(None).cast("long").alias("component"), F.lit(0).cast("long").alias("links"))
    out = out.unionByName(lost)
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.col("component").cast("long").alias("component_id"), F.col("links").cast("long").alias("n_links"))


def _only_sizes(k: int):
    def run(batches):
        for b in batches:
            data, offs = text_buffers(b.column(1))
            for i, j in doc_slices(offs):
                _, bounds = shingles(lower_ascii(data[offs[i] : offs[j]]), offs[i : j + 1] - offs[i], k)
                yield pa.RecordBatch.from_arrays([pa.nulls(j - i, pa.int64()), pa.array(np.diff(bounds).astype(np.int32))], names=["doc_id", "n"])

    return run


def row_key(id: Column, text: Column) -> Column:
    """64 bits of a row, of which some rows among 10^10 share theirs with another."""
    return F.xxhash64(id, text)


def with_row_keys(docs: DataFrame, key: str, id_col: str, text_col: str) -> DataFrame:
    """docs with the column `key`, equal where id and text are. Where rows of one row_key differ in a second hash, all but those
    of its least value go by both; the few such keys are a table of their own."""
    check, least = free_name(docs, "row_check"), free_name(docs, "row_least")
    keyed = docs.withColumns({key: row_key(F.col(id_col), F.col(text_col)), check: F.xxhash64(F.lit(1), F.col(text_col), F.col(id_col))})
    shared = stash(keyed.groupBy(key).agg(F.min(check).alias(least), F.max(check).alias("most")).where(F.col(least) != F.col("most")).drop("most"))
    own = F.when(F.col(least) != F.col(check), F.xxhash64(check, key)).otherwise(F.col(key))
    return keyed.join(shared, key, "left").withColumn(key, own).select(*docs.columns, key)


def one_row_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of near copies, the one of smallest id, null ones last.

    Rows are told apart by two 64-bit hashes of id and text, so neither null ids nor an id that different texts have lose
    rows; rows of equal id and text are one."""
    key = free_name(docs, "row_key")
    keyed = with_row_keys(docs, key, id_col, text_col)
    ids = keyed.select(F.col(key).alias("key"), F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col(key).alias("key")).alias("rank"))
    joined = stash(ngram_jaccard_join(keyed, id_col=key, text_col=text_col).select(F.col("doc_id").alias("key"), "component_id").distinct())
    first = ids.join(joined, "key").groupBy("component_id").agg(F.min("rank").alias("rank"))
    keep = stash(first.select(F.col("rank.key").alias(key)))
    discard(joined)
    return keyed.dropDuplicates([key]).join(keep, key, "left_semi").select(*docs.columns)


#: The same rows in DuckDB's SQL, by joining all shingles: for small tables.
SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
r AS (SELECT a AS v, b AS m FROM l UNION SELECT r.v, l.b FROM r JOIN l ON l.a = r.m),
c AS (SELECT v, min(m) AS m FROM r GROUP BY 1), d AS (SELECT a, count(*) AS k FROM l GROUP BY 1)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(w.doc_id, coalesce(c.m, w.doc_id)) AS component_id, coalesce(d.k, 0)::BIGINT AS n_links
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN c ON c.v = w.doc_id LEFT JOIN d ON d.a = w.doc_id
"""
