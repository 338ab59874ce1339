"""Shards of near equal bytes by a minimax contiguous partition.

Atomic groups are never split. Equal texts fall into one of 65,536 cells by the first bits of their MD5 digest, so
that a cell holds whole groups of copies and the driver sees at most 65,536 sizes whatever the input. The cells have an
order: those larger than an even share (hot groups of copies) come first, by falling size, the others follow by their number.
Shards are contiguous in that order: the smallest capacity is found by binary search, where a greedy pass tells
whether the shards suffice, and each cut is made as near to an even share as the capacity of what is left allows.

Slots number the rows of a shard without gaps: rows are counted by shard and by 256 buckets of doc_id, numbered
within a bucket and moved by the bucket's offset, so that no task holds a whole shard.

Defined results: a null text has 16 bytes and checksum 0 and goes where the empty text goes; a null doc_id is a row
like any other; repeated rows keep a slot each; an empty table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import stash

CELLS = 1 << 16
BUCKETS = 256


def feasible(prefix: np.ndarray, capacity: int, shards: int) -> bool:
    """Whether a greedy pass over the sizes (prefix sums, from 0) needs no more than so many shards."""
    at, n = 0, len(prefix) - 1
    for _ in range(shards):
        if at == n:
            return True
        nxt = int(np.searchsorted(prefix, prefix[at] + capacity, side="right")) - 1
        if nxt == at:
            return False
        at = nxt
    return at == n


def least_capacity(sizes: np.ndarray, shards: int) -> int:
    """The smallest capacity for which a contiguous partition into so many shards exists."""
    prefix = np.concatenate(([0], np.cumsum(sizes)))
    lo, hi = int(max(sizes.max(initial=0), -(-prefix[-1] // shards))), int(prefix[-1])
    while lo < hi:
        mid = (lo + hi) // 2
        lo, hi = (lo, mid) if feasible(prefix, mid, shards) else (mid + 1, hi)
    return lo


def cuts(sizes: np.ndarray, shards: int) -> list[int]:
    """Where shards 1, 2, ... begin. Each shard is as near to an even share of what is left as the least capacity of what is
    left allows, so no shard is above the least capacity, nor is any later one above that of its own rest."""
    n = len(sizes)
    if not n or shards < 2:
        return []
    prefix = np.concatenate(([0], np.cumsum(sizes)))
    out, at = [], 0
    for left in range(shards - 1, 0, -1):
        if at == n:
            out.append(n)
            continue
        cap = least_capacity(sizes[at:], left + 1)
        back = n  # from here on, `left` shards suffice
        for _ in range(left):
            back = int(np.searchsorted(prefix, prefix[back] - cap, side="left"))
        share = prefix[at] + (prefix[-1] - prefix[at]) / (left + 1)
        far = int(np.searchsorted(prefix, prefix[at] + cap, side="right")) - 1
        p = int(np.searchsorted(prefix, share))
        if share - prefix[p - 1] <= prefix[p] - share:
            p -= 1
        at = min(max(p, back, at + 1), far)
        out.append(at)
    return out


def ordered(cells: np.ndarray, sizes: np.ndarray, shards: int) -> tuple[np.ndarray, int]:
    """The order of the groups, and how many of them come first for being larger than an even share of what is left (by
    falling size); the others follow by number."""
    order = np.argsort(-sizes, kind="stable")
    rest, hot = int(sizes.sum()), 0
    while hot < len(order) and shards - hot > 1 and int(sizes[order[hot]]) * (shards - hot) > rest:
        rest -= int(sizes[order[hot]])
        hot += 1
    others = np.setdiff1d(np.arange(len(cells)), order[:hot])
    return np.concatenate((order[:hot], others[np.argsort(cells[others], kind="stable")])), hot


def plan(cells: np.ndarray, sizes: np.ndarray, shards: int) -> tuple[list[tuple[int, int]], int, list[int]]:
    """(cell, shard) of the hot cells, the shard of the first other cell, and the cells at which further shards begin."""
    order, hot = ordered(cells, sizes, shards)
    starts = cuts(sizes[order], shards)
    own = [(int(cells[order[k]]), sum(s <= k for s in starts)) for k in range(hot)]
    return own, sum(s <= hot for s in starts), [int(cells[order[s]]) if s < len(order) else CELLS for s in starts if s > hot]


def shard_by_bytes(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (null under this law)."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = stash(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text) + 16).cast("long").alias("size"),
            F.crc32(text).cast("long").alias("text_crc32"),
            F.conv(F.substring(F.md5(text), 1, 4), 16, 10).cast("int").alias("cell"),
        )
    )
    got = base.groupBy("cell").agg(F.sum("size").alias("size")).orderBy("cell").toArrow()  # at most CELLS rows
    hot, first, starts = plan(got["cell"].to_numpy().astype(np.int64), got["size"].to_numpy().astype(np.int64), shards)
    shard = F.lit(first)
    if starts:
        shard = shard + F.size(F.filter(F.array(*[F.lit(s) for s in starts]), lambda s: s <= F.col("cell")))
    for c, k in hot:
        shard = F.when(F.col("cell") == c, k).otherwise(shard)
    placed = base.withColumn("shard", shard.cast("int")).withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(BUCKETS)).cast("int"))
    sizes = placed.groupBy("shard", "bucket").count().toArrow().to_pylist()  # at most shards * BUCKETS rows
    rows, at = [], {}
    for r in sorted(sizes, key=lambda r: (r["shard"], r["bucket"])):
        rows.append((r["shard"], r["bucket"], at.get(r["shard"], 0)))
        at[r["shard"]] = rows[-1][2] + r["count"]
    offsets = spark.createDataFrame(rows, "shard int, bucket int, before long")
    w = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
    return (
        placed.withColumn("rank", F.row_number().over(w))
        .join(F.broadcast(offsets), ["shard", "bucket"])
        .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("before") + F.col("rank") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
    )
