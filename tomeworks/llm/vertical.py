"""Vertical partitioning of hashed items: the hash order is cut into fragments, each fragment is counted by itself,
and what it finds goes back to the batch of documents that the items came from.

Items travel in binary columns, one row for each batch and fragment, so that neither the shuffle nor the JVM handles
single items. An item that occurs more than once in a batch is sent once, with the number of times: a hot item costs a
fragment one value for each batch, whatever its number of documents. Which of the batch's documents hold it stays with the
batch. Fragments grow in number with the bytes of the input, so each of them keeps its size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext

from .base import blob

#: Items (and documents) in a batch; more only where one document has more.
BATCH_ITEMS = 2_000_000
CELLS = "frag int, batch long, items binary, sizes binary, multi binary, times binary"
CELL_SCHEMA = pa.schema([("frag", pa.int32()), ("batch", pa.int64()), ("items", pa.binary()), ("sizes", pa.binary()), ("multi", pa.binary()), ("times", pa.binary())])


def batch_ids() -> Iterator[int]:
    """Numbers that no other task uses: a million for each partition."""
    at = TaskContext.get().partitionId() << 20 if TaskContext.get() else 0
    while True:
        yield at
        at += 1


def row(frag: int, batch: int, items: bytes | None = None, sizes: bytes | None = None, multi: bytes | None = None, times: bytes | None = None) -> tuple:
    return frag, batch, items, sizes, multi, times


def record_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), CELL_SCHEMA.types, strict=True)], schema=CELL_SCHEMA)


def fragment_of(items: np.ndarray, frags: int) -> np.ndarray:
    return (items >> np.uint64(65 - frags.bit_length())).astype(np.uint32)


def shorten(items: np.ndarray) -> bytes:
    """The low seven bytes of each item; the fragment, one of 256 or more, has the eighth."""
    return blob(items.view(np.uint8).reshape(-1, 8)[:, :7]) if len(items) else b""


def whole(low: np.ndarray, frag: int, frags: int) -> np.ndarray:
    """Back to the items that were shortened."""
    out = np.zeros((len(low) // 7, 8), np.uint8)
    out[:, :7] = low.reshape(-1, 7)
    return out.view(np.uint64).ravel() | np.uint64((frag << (65 - frags.bit_length())) >> 56 << 56)


def frag_kind(frags: int):
    return np.uint8 if frags <= 1 << 8 else np.uint16 if frags <= 1 << 16 else np.uint32


def divide(items: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Which items occur once; the others, distinct and sorted; how often each occurs; and where, item by item."""
    order = np.argsort(items, kind="stable")
    s = items[order]
    edge = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1]))) if len(s) else np.zeros(0, np.int64)
    size = np.diff(np.append(edge, len(s)))
    single = np.empty(len(s), bool)
    single[order] = np.repeat(size == 1, size)
    again = size > 1
    return single, s[edge[again]], size[again], order[np.repeat(again, size)]


def cut(items: np.ndarray, frags: int) -> tuple[np.ndarray, np.ndarray]:
    """The items' order by fragment (stable), and the fragments' bounds in it."""
    frag = fragment_of(items, frags)
    order = np.argsort(frag, kind="stable")
    return order, np.searchsorted(frag[order], np.arange(frags + 1))


def counts_by(keys: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """For each key, the summed weights of its equals."""
    if not len(keys):
        return np.zeros(0, np.int64)
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    edge = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
    out = np.empty(len(keys), np.int64)
    out[order] = np.repeat(np.add.reduceat(weights[order], edge), np.diff(np.append(edge, len(s))))
    return out


def arrays(column: pa.ChunkedArray | pa.Array, kind) -> list[np.ndarray]:
    """Each value of a binary column as an array, without copying; null is empty."""
    out = []
    for x in column:
        b = x.as_buffer()
        out.append(np.frombuffer(b, kind) if b is not None and b.size else np.zeros(0, kind))
    return out


def fragment_counts(items: list[np.ndarray], multi: list[np.ndarray], times: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """How often the single items of each batch occur in the fragment, and how often its repeated ones (with their times) do."""
    n = sum(map(len, items))
    weights = np.concatenate([np.ones(n, np.int64), *times])
    total = counts_by(np.concatenate([*items, *multi]), weights)
    return np.split(total[:n], np.cumsum([len(x) for x in items])[:-1]), np.split(total[n:], np.cumsum([len(x) for x in multi])[:-1])


def pack(*parts: np.ndarray) -> bytes:
    """Arrays one after the other, behind their sizes in bytes."""
    raw = [blob(p) for p in parts]
    return b"".join([np.array([len(r) for r in raw], np.int64).tobytes(), *raw])


def unpack(raw: np.ndarray, *kinds) -> list[np.ndarray]:
    sizes = np.frombuffer(raw[: 8 * len(kinds)].tobytes(), np.int64)
    ends = 8 * len(kinds) + np.cumsum(sizes)
    return [np.frombuffer(raw[e - n : e].tobytes(), k) for e, n, k in zip(ends, sizes, kinds, strict=True)]
