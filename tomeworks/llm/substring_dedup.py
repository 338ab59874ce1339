"""Removal of word passages that occur more than once, by compressed FM-indexes over shards.

1. Every window of `window` words gets a 64-bit fingerprint, of which fragments of their order (see vertical.py) count the
   first 40 bits or more. A fingerprint that occurs once belongs to a window that occurs once, so this leaves a
   superset of the repeated windows, a small part of most corpora. It decides nothing but what need not be searched.
2. Runs of such windows are cut into segments with the same minimizer, the place of the lowest hash of RUN words
   within the window. Equal windows have equal minimizers, so a shard by minimizer holds all occurrences of a window.
   Equal segments of a batch are sent once, with their number, so a hot passage is a few rows from each batch. Shards grow in
   number with the bytes of the input.
3. Each shard builds an FM-index of its distinct segments, and streams what the documents sent it through backward search
   over the wavelet matrix: matching statistics give each window's interval. It is repeated if its segment was sent
   twice or the interval holds another place.
4. The words under windows that occur twice or more are removed, judged on the input.

Words are told apart by 64-bit hashes.

Defined results: null or empty text: no words, nothing removed, digest of the empty string. Repeated rows are copies
of each other, and lose what copies lose; so do ties, since all places of a repeated window go alike. Null doc_ids are rows
like any other; an empty table gives no rows. Only doc_id and text are read, so further columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vertical as V
from .base import blob, doc_slices, fragments, stash, text_buffers
from .fm_index import FMIndex
from .kernels import mix, run_hashes, word_hashes, words

WINDOW, RUN = 35, 8
HEAD = np.dtype([("doc_id", "<i8"), ("known", "?"), ("h", "<i8"), ("n_words", "<i8"), ("windows", "<i8"), ("sha", "S64")])
SEGMENT = np.dtype([("n", "<u4"), ("count", "<u4")])
PLACE = np.dtype([("doc", "<i4"), ("first", "<i4"), ("windows", "<i4"), ("shard", "<i4"), ("at", "<i4")])
DOC_HEAD = np.dtype([("doc_id", "<i8"), ("known", "?"), ("h", "<i8")])
ROW = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("n_words", pa.int64()), ("sha", pa.string()), ("spans", pa.binary())])


def _windows(size: int, frags: int):
    """Fingerprints of all windows, as cells; the batch's own row has the documents and each window's fragment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held, total = V.batch_ids(), [], 0
        FRAG = V.frag_kind(frags)

        def flush() -> pa.RecordBatch:
            head = np.concatenate([h for h, _ in held])
            items = np.concatenate([x for _, x in held])
            single, multi, times, _ = V.divide(items)
            items = items[single]
            frag = V.fragment_of(items, frags)
            order, edge = V.cut(items, frags)
            low = lambda x: ((x >> np.uint64(33 - frags.bit_length())) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            items, far, batch = low(items[order]), np.searchsorted(V.fragment_of(multi, frags), np.arange(frags + 1)), next(ids)
            rows = [V.row(-1, batch, V.pack(head, np.packbits(~single), frag.astype(FRAG)))]
            for f in np.flatnonzero((np.diff(edge) > 0) | (np.diff(far) > 0)).tolist():
                p, q = far[f], far[f + 1]
                rows.append(V.row(f, batch, blob(items[edge[f] : edge[f + 1]]), None, blob(low(multi[p:q])), blob(times[p:q].astype(np.uint32))))
            return V.record_batch(rows)

        for b in batches:
            data, offs = text_buffers(b.column(1))
            doc_ids = b.column(0)
            known = ~np.array(doc_ids.is_null().to_numpy(zero_copy_only=False), bool)
            doc_ids = doc_ids.fill_null(0).to_numpy(zero_copy_only=False)
            h = b.column(2).to_numpy(zero_copy_only=False)
            for i, j in doc_slices(offs):
                d, o = data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
                starts, ends, first = words(d, o)
                items = run_hashes(word_hashes(d, starts, ends), size)
                n = np.diff(first)
                own = np.repeat(np.arange(j - i), n)[: len(items)]
                items = items[np.arange(len(items)) + size <= first[own + 1]]
                head = np.zeros(j - i, HEAD)
                head["doc_id"], head["known"], head["h"], head["n_words"], head["windows"] = doc_ids[i:j], known[i:j], h[i:j], n, np.maximum(0, n - size + 1)
                raw = d.tobytes()
                head["sha"] = [hashlib.sha256(b" ".join(raw[o[k] : o[k + 1]].split())).hexdigest().encode() for k in range(j - i)]
                held.append((head, items))
                total += len(items) + j - i
                if total >= V.BATCH_ITEMS:
                    yield flush()
                    held, total = [], 0
        if held:
            yield flush()

    return run


def _twice(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
    """For each batch, which of its single fingerprints in this fragment occur elsewhere (packed bits, behind their number)."""
    if key[0].as_py() < 0:
        return t
    counts, _ = V.fragment_counts(*(V.arrays(t[c], np.uint32) for c in ("items", "multi", "times")))
    return pa.Table.from_batches([V.record_batch([V.row(key[0].as_py(), b, V.pack(np.array([len(c)], np.int64), np.packbits(c > 1))) for b, c in zip(t["batch"].to_pylist(), counts, strict=True)])])


def runs_of(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Runs of set flags that don't cross the bounds: (start, end) rows."""
    if not len(flags):
        return np.zeros((0, 2), np.int64)
    edge = np.zeros(len(flags) + 1, bool)
    edge[bounds] = True
    start = np.flatnonzero(flags & (edge[:-1] | np.concatenate(([True], ~flags[:-1]))))
    end = np.flatnonzero(flags & (edge[1:] | np.concatenate((~flags[1:], [True])))) + 1
    return np.stack((start, end), axis=1)


def _candidates(frags: int):
    def run(t: pa.Table) -> pa.Table:
        return _runs(t, frags)

    return run


def _runs(t: pa.Table, frags: int) -> pa.Table:
    """Per document, the runs of windows whose fingerprints occur twice; null where there are none."""
    head, parts = None, []
    for f, x in sorted(zip(t["frag"].to_pylist(), V.arrays(t["items"], np.uint8), strict=True), key=lambda r: r[0]):
        if f < 0:
            head, again, frag = V.unpack(x, HEAD, np.uint8, V.frag_kind(frags))
        else:
            n, bits = V.unpack(x, np.int64, np.uint8)
            parts.append(np.unpackbits(bits, count=int(n[0])) if n[0] else bits[:0])
    if head is None:
        raise RuntimeError("a batch lost its documents")
    flags = np.unpackbits(again, count=int(head["windows"].sum())).astype(bool) if head["windows"].any() else np.zeros(0, bool)
    if parts:
        single = np.flatnonzero(~flags)
        flags[single[np.argsort(frag, kind="stable")]] = np.concatenate(parts).astype(bool)
    bounds = np.concatenate(([0], np.cumsum(head["windows"])))
    runs = runs_of(flags, bounds)
    doc = np.searchsorted(bounds, runs[:, 0], "right") - 1
    at = np.searchsorted(doc, np.arange(len(head) + 1))
    spans = [blob((runs[a:b] - bounds[k]).astype(np.int32)) if b > a else None for k, (a, b) in enumerate(zip(at, at[1:], strict=False))]
    return pa.table([pa.array(head["doc_id"], mask=~head["known"]), pa.array(head["h"]), pa.array(head["n_words"]), pa.array([x.decode() for x in head["sha"]], pa.string()), pa.array(spans, pa.binary())], schema=ROW)


def lowest(h: np.ndarray, width: int) -> np.ndarray:
    """For each run of `width` items, the place of its lowest one (leftmost of equals)."""
    n = len(h) - width + 1
    best, at, size = h.copy(), np.arange(len(h)), 1
    while size < width:  # doubling; the last step overlaps
        step = min(size, width - size)
        m = len(best) - step
        right = best[step:] < best[:m]
        best, at = np.where(right, best[step:], best[:m]), np.where(right, at[step:], at[:m])
        size += step
    return at[:n]


def _segments(size: int, k: int, shards: int):
    """Segments of the runs of windows, by shard, equal ones of a batch once; the batch's own row says which documents have which."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, heads, found, docs, total = V.batch_ids(), [], [], 0, 0

        def flush() -> pa.RecordBatch:
            seen: dict[tuple[int, bytes], int] = {}
            by_shard: dict[int, list] = {}
            places = np.zeros(len(found), PLACE)
            for n, (q, r, s, m, key) in enumerate(found):
                own = by_shard.setdefault(q, [])
                at = seen.get((q, key))
                if at is None:
                    at = seen[q, key] = len(own)
                    own.append([key, 0])
                own[at][1] += 1
                places[n] = (r, s, m, q, at)
            batch = next(ids)
            rows = [V.row(-1, batch, V.pack(np.concatenate(heads), places))]
            for q, own in sorted(by_shard.items()):
                rows.append(V.row(q, batch, b"".join(x for x, _ in own), np.array([(len(x) // 8, c) for x, c in own], SEGMENT).tobytes()))
            return V.record_batch(rows)

        for b in batches:
            data, offs = text_buffers(b.column("text"))
            doc_ids, h, spans = b.column("doc_id"), b.column("h").to_numpy(), V.arrays(b.column("spans"), np.int32)
            head = np.zeros(len(b), DOC_HEAD)
            head["known"] = ~np.array(doc_ids.is_null().to_numpy(zero_copy_only=False), bool)
            head["doc_id"], head["h"] = doc_ids.fill_null(0).to_numpy(zero_copy_only=False), h
            for i, j in doc_slices(offs):
                d, o = data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
                starts, ends, first = words(d, o)
                w = word_hashes(d, starts, ends)
                heads.append(head[i:j])
                for r in range(i, j):
                    for a, z in spans[r].reshape(-1, 2):
                        own = w[first[r - i] + a : first[r - i] + z + size - 1]
                        g = run_hashes(own, k)
                        at = lowest(g, size - k + 1)
                        cut = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1], [True])))
                        anchor = mix(g[at[cut[:-1]]].copy()) % np.uint64(shards)
                        for s, e, q in zip(cut[:-1].tolist(), cut[1:].tolist(), anchor.tolist(), strict=True):
                            found.append((q, docs + r - i, int(a) + s, e - s, own[s : e + size - 1].tobytes()))
                            total += e - s + size - 1
                docs += j - i
                if total >= V.BATCH_ITEMS:
                    yield flush()
                    heads, found, docs, total = [], [], 0, 0
        if found:
            yield flush()

    return run


def repeated_windows(seq: np.ndarray, lengths: np.ndarray, weights: np.ndarray, size: int) -> np.ndarray:
    """For distinct segments (items one after the other), which positions start a window that occurs twice or more."""
    if not len(seq):
        return np.zeros(0, bool)
    code = np.unique(seq, return_inverse=True)[1].astype(np.int64) + 1
    ends = np.cumsum(lengths)
    starts = ends - lengths
    gap = np.arange(len(lengths))
    text = np.zeros(len(seq) + len(lengths), np.int64)
    at = np.arange(len(seq)) + np.repeat(gap, lengths)
    text[at] = code
    twice = FMIndex(text, size).repeated(text, starts + gap, ends + gap)[at]
    return (twice | np.repeat(weights >= 2, lengths)) & (np.arange(len(seq)) + size <= np.repeat(ends, lengths))


def _shard(size: int):
    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        if key[0].as_py() < 0:
            return t
        raw, segs = V.arrays(t["items"], np.uint64), V.arrays(t["sizes"], np.uint8)
        segs = [np.frombuffer(s.tobytes(), SEGMENT) for s in segs]
        seq, seg = np.concatenate(raw), np.concatenate(segs)
        n = seg["n"].astype(np.int64)
        ends = np.cumsum(n)
        # segments of the shard that are equal count as one
        own, which, first, weight = {}, np.zeros(len(seg), np.int64), [], []
        data = seq.tobytes()
        for i, (a, z, c) in enumerate(zip((ends - n).tolist(), ends.tolist(), seg["count"].tolist(), strict=True)):
            k = own.setdefault(data[a * 8 : z * 8], len(own))
            if k == len(first):
                first.append(i)
                weight.append(0)
            weight[k] += c
            which[i] = k
        first = np.array(first)
        take = np.concatenate([np.arange(ends[i] - n[i], ends[i]) for i in first])
        twice = repeated_windows(seq[take], n[first], np.array(weight), size)
        begin = np.cumsum(n[first]) - n[first]
        flags = [twice[begin[k] : begin[k] + m - size + 1] for k, m in zip(which.tolist(), n.tolist(), strict=True)]
        rows, at = [], 0
        for batch, s, sizes in zip(t["batch"].to_pylist(), segs, t["sizes"].to_pylist(), strict=True):
            rows.append(V.row(key[0].as_py(), batch, blob(np.packbits(np.concatenate(flags[at : at + len(s)]))), sizes))
            at += len(s)
        return pa.Table.from_batches([V.record_batch(rows)])

    return run


SPANS = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("cover", pa.binary())])


def _covered(size: int):
    """Per document, the spans of words under repeated windows."""

    def run(t: pa.Table) -> pa.Table:
        flags: dict[int, tuple] = {}
        for f, x, s in zip(t["frag"].to_pylist(), V.arrays(t["items"], np.uint8), V.arrays(t["sizes"], np.uint8), strict=True):
            if f < 0:
                heads, places = V.unpack(x, DOC_HEAD, PLACE)
            else:
                seg = np.frombuffer(s.tobytes(), SEGMENT)
                m = seg["n"].astype(np.int64) - size + 1
                flags[f] = (np.unpackbits(x, count=int(m.sum())).astype(bool), np.cumsum(m) - m)
        base, at = {}, 0
        for f, (bits, _) in flags.items():
            base[f] = at
            at += len(bits)
        bits = np.concatenate([x for x, _ in flags.values()]) if flags else np.zeros(0, bool)
        begin = np.zeros(len(places), np.int64)
        for f, (_, first) in flags.items():
            own = places["shard"] == f
            begin[own] = base[f] + first[places["at"][own]]
        # places come in the order of documents and words
        m = places["windows"].astype(np.int64)
        nth = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
        use = bits[np.repeat(begin, m) + nth]
        doc, pos = np.repeat(places["doc"], m)[use], (np.repeat(places["first"].astype(np.int64), m) + nth)[use]
        head = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (pos[1:] - pos[:-1] > size)))) if len(pos) else np.zeros(0, np.int64)
        tail = np.append(head[1:] - 1, len(pos) - 1) if len(pos) else head
        cover = np.stack((pos[head], pos[tail] + size), axis=1).astype(np.int32)
        bounds = np.searchsorted(doc[head], np.arange(len(heads) + 1))
        keep = np.flatnonzero(np.diff(bounds))
        return pa.table([pa.array(heads["doc_id"][keep], mask=~heads["known"][keep]), pa.array(heads["h"][keep]), pa.array([blob(cover[bounds[i] : bounds[i + 1]]) for i in keep], pa.binary())], schema=SPANS)

    return run


def _kept(text: bytes, cover: np.ndarray) -> tuple[int, list[bytes]]:
    w = text.split()
    gone = np.zeros(len(w) + 1, np.int32)
    np.add.at(gone, cover[:, 0], 1)
    np.add.at(gone, cover[:, 1], -1)
    out = np.cumsum(gone)[:-1] > 0
    return int(out.sum()), [x for x, o in zip(w, out.tolist(), strict=True) if not o]


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        data, offs = text_buffers(b.column("text"))
        spans = V.arrays(b.column("cover"), np.int32)
        n, kept, sha = [], [], []
        for i in range(len(b)):
            gone, left = _kept(data[offs[i] : offs[i + 1]].tobytes(), spans[i].reshape(-1, 2))
            n.append(gone)
            kept.append(b" ".join(left).decode("utf-8", "replace"))
            sha.append(hashlib.sha256(b" ".join(left)).hexdigest())
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_words"), pa.array(n, pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])


def _join_key(a: DataFrame, b: DataFrame, right: list[str]) -> DataFrame:
    """a with columns of b (unique by h and doc_id, where null equals null)."""
    b = b.select(F.col("doc_id").alias("_id"), F.col("h").alias("_h"), *right)
    return a.join(b, (a["h"] == F.col("_h")) & (F.coalesce(a["doc_id"], F.lit(-1)) == F.coalesce(F.col("_id"), F.lit(-1))) & a["doc_id"].eqNullSafe(F.col("_id"))).drop("_id", "_h")


def remove_repeats(docs: DataFrame, size: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", texts: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and with `texts`, the kept words of the documents that lost some)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    frags = fragments(rows)
    cells = rows.mapInArrow(_windows(size, frags), V.CELLS)
    told = cells.groupBy("frag", F.when(F.col("frag") < 0, F.col("batch")).alias("own")).applyInArrow(_twice, V.CELLS)
    found = stash(told.groupBy("batch").applyInArrow(_candidates(frags), "doc_id long, h long, n_words long, sha string, spans binary"))
    some = found.where("spans is not null").select("doc_id", "h", "n_words", "spans").dropDuplicates(["doc_id", "h"])
    held = stash(_join_key(rows, some, ["n_words", "spans"]), "zstd")
    segs = held.select("doc_id", "h", "text", "spans").mapInArrow(_segments(size, min(RUN, size), frags), V.CELLS)
    judged = segs.groupBy("frag", F.when(F.col("frag") < 0, F.col("batch")).alias("own")).applyInArrow(_shard(size), V.CELLS)
    spans = stash(judged.groupBy("batch").applyInArrow(_covered(size), "doc_id long, h long, cover binary"))
    cut = _join_key(held.select("doc_id", "h", "text", "n_words"), spans.dropDuplicates(["doc_id", "h"]), ["cover"])
    cut = cut.mapInArrow(_strip, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
    lost = spans.select(F.col("doc_id").alias("_id"), F.col("h").alias("_h")).distinct()
    whole = found.join(lost, (F.col("h") == F.col("_h")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left_anti")
    whole = whole.select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("sha").alias("kept_sha256"), F.lit(None).cast("string").alias("kept"))
    out = whole.unionByName(cut)
    return out if texts else out.drop("kept")


#: The same rows in DuckDB's SQL, by counting all windows: for small tables.
SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
h AS (SELECT doc_id, list_transform(range(1, len(ws) - 33), lambda i: md5(array_to_string(ws[i:i + 34], ' '))) AS hs FROM w WHERE len(ws) >= 35),
g AS (SELECT doc_id, unnest(hs) AS g, generate_subscripts(hs, 1) AS i FROM h),
t AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY g) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS k FROM t),
x AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS k FROM w),
y AS (SELECT x.doc_id, count(gone.k) AS n, string_agg(word, ' ' ORDER BY x.k) FILTER (WHERE gone.k IS NULL) AS kept FROM x LEFT JOIN gone ON gone.doc_id = x.doc_id AND gone.k = x.k GROUP BY x.doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(y.n, 0)::BIGINT AS n_removed, sha256(coalesce(y.kept, '')) AS kept_sha256 FROM w LEFT JOIN y ON y.doc_id = w.doc_id
"""
