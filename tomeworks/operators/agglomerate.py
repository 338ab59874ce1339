"""Average-linkage clustering of many vectors under cosine distance, exact, and its cuts.

The mean distance between two clusters is 1 less the product of their mean unit vectors, so a cluster is its size and
the sum of its vectors. Clusters that are nearest to each other are merged all at once, round by round; average linkage
is reducible, so that gives the tree that merging the nearest pair each time gives. Below a distance, only pairs of clusters nearer
than it matter, and the mean distance of a merged cluster is below it only if that of one of its parts was: the
graph of near pairs, made once by a range join, is kept from round to round by renaming its ends. Where a number of clusters is asked
for, the distance is raised from stage to stage. Once LAST clusters or fewer are left, one task does the rest.

The tree is a table: each item but the first of a tree is absorbed once, by a smaller one, at a height.

`label_clusters` cuts the trees of many labels to a number of clusters each. A label of up to WHOLE vectors is one task, which keeps
sums of vectors and no distances; the larger ones share their rounds, whatever their number, in which clusters whose nearest one is gone look for it among all
of their label, in tiles of bounded size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import staged, unstaged
from .dedupe import ranked
from .keywords import merge_order

#: Clusters that one task takes; vectors of one side of a task of the range join; vectors for which it has a pivot, and pivots at most.
LAST, SIDE, CELL, PIVOTS = 4096, 2048, 1024, 1024
#: Distances of the stages where a number of clusters is asked for; the last is above any distance.
STAGES = (0.05, 0.1, 0.2, 0.4, 0.8, 1.6, 2.1)
#: Clusters of a label that one task takes where it keeps no distances, and numbers in those it takes once few of them search; clusters of
#: one side of a tile, products held at once, and searches a cluster after which chains take over.
WHOLE, NUMBERS, TILE, AT_ONCE, SEARCHES = 16384, 1 << 22, 16384, 1 << 22, 8


def _product(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _units(df: DataFrame, item: str, vector: str) -> DataFrame:
    """id, n, s: the items with their unit vectors; a zero vector stays zero."""
    wide = df.where(f"{item} is not null and {vector} is not null").select(F.col(item).alias("id"), F.transform(vector, lambda x: x.cast("double")).alias("s"))
    norm = F.sqrt(_product(F.col("s"), F.col("s")))
    return wide.select("id", F.lit(1).cast("long").alias("n"), F.transform("s", lambda x: F.when(norm > 0, x / norm).otherwise(0.0)).alias("s"))


def near_pairs(nodes: DataFrame, distance: float) -> DataFrame:
    """a, b, d: all ordered pairs of clusters with a mean distance below the one given.

    Mean vectors are at most as long as unit vectors, so the ends of such a pair lie within sqrt(2 distance) of each other. Each
    vector is at home with its nearest pivot, and also goes to every pivot whose border it lies that near to. The vectors of a pivot meet those at home there in
    bounded sides, so that no task has all of a crowded one."""
    kind, reach = nodes.schema["id"].dataType.simpleString(), math.sqrt(2 * distance) + 1e-9
    means = nodes.select("id", F.transform("s", lambda x: x / F.col("n")).alias("m"))
    total = means.count()
    pivots = means.orderBy(F.xxhash64("id"), "id").limit(max(1, min(PIVOTS, total // CELL))).toPandas()
    p = np.stack(pivots["m"].map(np.asarray)) if len(pivots) else np.zeros((1, 1))
    apart = np.sqrt(np.maximum(((p[:, None] - p[None]) ** 2).sum(2), 1e-300)) if len(p) <= 64 else np.sqrt(np.maximum((p * p).sum(1)[:, None] + (p * p).sum(1) - 2 * p @ p.T, 1e-300))

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            m = np.stack(pdf["m"].map(np.asarray))
            far = np.maximum((m * m).sum(1)[:, None] + (p * p).sum(1) - 2 * m @ p.T, 0)
            home = far.argmin(1)
            border = (far - far[np.arange(len(m)), home][:, None]) / (2 * apart[home])
            row, cell = np.nonzero((border <= reach + 1e-6) | (np.arange(len(p)) == home[:, None]))
            yield pd.DataFrame({"cell": cell.astype("int32"), "home": cell == home[row], "id": pdf["id"].to_numpy()[row], "m": pdf["m"].to_numpy()[row]})

    dealt = staged(means.mapInPandas(deal, f"cell int, home boolean, id {kind}, m array<double>"))
    sizes = dealt.groupBy("cell").agg(F.ceil(F.count_if("home") / SIDE).cast("int").alias("homes"), F.ceil(F.count("*") / SIDE).cast("int").alias("alls")).where("homes > 0")
    dealt = dealt.join(F.broadcast(sizes), "cell")  # a row for each pivot
    side = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = dealt.where("home").select("cell", side("homes").alias("i"), each("alls").alias("j"), "id", "m")
    right = dealt.select(F.col("cell").alias("c2"), each("homes").alias("i2"), side("alls").alias("j2"), F.col("id").alias("id2"), F.col("m").alias("m2"))

    def meet(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        b = b.rename(columns={"id2": "id", "m2": "m"})
        if not len(a) or not len(b):
            return pd.DataFrame({"a": a["id"][:0], "b": b["id"][:0], "d": np.zeros(0)})
        d = 1 - np.stack(a["m"].map(np.asarray)) @ np.stack(b["m"].map(np.asarray)).T
        x, y = np.nonzero(d < distance)
        out = pd.DataFrame({"a": a["id"].to_numpy()[x], "b": b["id"].to_numpy()[y], "d": d[x, y]})
        return out[out["a"] != out["b"]]

    return left.groupBy("cell", "i", "j").cogroup(right.groupBy("c2", "i2", "j2")).applyInPandas(meet, f"a {kind}, b {kind}, d double")


def _round(nodes: DataFrame, edges: DataFrame, distance: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Merges all clusters that are nearest to each other: merges, nodes and edges after it."""
    best = edges.groupBy("a").agg(F.min(F.struct("d", F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))).alias("e")).select("e.*")
    merges = staged(best.groupBy("lo", "hi", "d").count().where("count = 2").select(F.col("hi").alias("item"), F.col("lo").alias("parent"), F.col("d").alias("height")))
    gone = nodes.join(merges.select(F.col("item").alias("id"), "parent"), "id").select(F.col("parent").alias("id"), F.col("n").alias("n2"), F.col("s").alias("s2"))
    kept = nodes.join(merges.select(F.col("item").alias("id")), "id", "left_anti").join(gone, "id", "left")
    nodes = staged(kept.select("id", (F.col("n") + F.coalesce("n2", F.lit(0))).alias("n"), F.when(F.col("s2").isNull(), F.col("s")).otherwise(F.zip_with("s", "s2", lambda x, y: x + y)).alias("s")))
    names = merges.select(F.explode(F.array(F.struct(F.col("item").alias("old"), F.col("parent").alias("new")), F.struct(F.col("parent").alias("old"), F.col("parent").alias("new")))).alias("r")).select("r.*")
    na, nb = names.select(F.col("old").alias("a"), F.col("new").alias("na")), names.select(F.col("old").alias("b"), F.col("new").alias("nb"))
    moved = edges.join(na, "a", "left").join(nb, "b", "left")
    changed = F.col("na").isNotNull() | F.col("nb").isNotNull()
    same = moved.where(~changed).select("a", "b", "d")
    due = moved.where(changed).select(F.coalesce("na", "a").alias("a"), F.coalesce("nb", "b").alias("b")).where("a <> b").distinct()
    ma, mb = nodes.select(F.col("id").alias("a"), F.col("n").alias("xn"), F.col("s").alias("xs")), nodes.select(F.col("id").alias("b"), F.col("n").alias("yn"), F.col("s").alias("ys"))
    # both directions of a pair must get the same distance to the last bit, so it is reckoned from the smaller id on
    first = F.col("a") < F.col("b")
    d = 1 - F.when(first, _product(F.col("xs"), F.col("ys"))).otherwise(_product(F.col("ys"), F.col("xs"))) / (F.col("xn") * F.col("yn"))
    again = due.join(ma, "a").join(mb, "b").select("a", "b", d.alias("d")).where(F.col("d") < distance)
    return merges, nodes, staged(same.unionByName(again))


def _finish(nodes: DataFrame, distance: float) -> tuple[DataFrame, DataFrame]:
    """All merges below the distance among LAST clusters or fewer, and the clusters that are left."""
    kind = nodes.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(batches)
        if not sum(map(len, parts)):
            return
        pdf = pd.concat(parts).sort_values("id", ignore_index=True)
        n, s = pdf["n"].to_numpy(), np.stack(pdf["s"].map(np.asarray))
        m = s / n[:, None]
        ids, parent, height = pdf["id"].to_numpy(), np.arange(len(n)), np.zeros(len(n))
        for h, a, b in merge_order(1 - m @ m.T, n.astype(float)):
            if h < distance:
                parent[b], height[b] = a, h
        root = parent.copy()
        while (root != root[root]).any():
            root = root[root]
        sums, sizes = np.zeros_like(s), np.zeros_like(n)
        np.add.at(sums, root, s)
        np.add.at(sizes, root, n)
        own = parent == np.arange(len(n))
        yield pd.DataFrame({"id": ids, "parent": np.where(own, None, ids[parent]), "height": height, "n": sizes, "s": list(sums)})

    got = staged(nodes.coalesce(1).mapInPandas(run, f"id {kind}, parent {kind}, height double, n long, s array<double>"))
    return got.where("parent is not null").select(F.col("id").alias("item"), "parent", "height"), got.where("parent is null").select("id", "n", "s")


def dendrogram(df: DataFrame, item: str, vector: str, distance: float | None = None, clusters: int = 1) -> DataFrame:
    """item, parent, height, step: which smaller item's cluster absorbs each item's, at which mean distance; merges below
    `distance`, or, where it is None, enough for `clusters` clusters.

    Items are distinct. Null items and vectors play no part, zero vectors are at distance 1 from all. Pairs of equal distance are merged in the order of
    their ids. An empty table gives no rows."""
    units = staged(_units(df, item, vector))
    # equal vectors are one from the start
    reps = units.groupBy("s").agg(F.min("id").alias("id"), F.count("*").alias("n"))
    nodes = staged(reps.select("id", "n", F.transform("s", lambda x: x * F.col("n")).alias("s"), F.col("s").alias("unit")))
    equal = units.join(nodes.select(F.col("id").alias("parent"), F.col("unit").alias("s")), "s").where("id <> parent")
    found = [equal.select(F.col("id").alias("item"), "parent", F.lit(0.0).alias("height"))]
    nodes = nodes.drop("unit")
    if distance is not None and distance <= 0:
        found, stages = [found[0].where("false")], ()
    else:
        stages = STAGES if distance is None else (distance,)
    for limit in stages:
        left = nodes.count()
        if left <= (clusters if distance is None else 1):
            break
        if left <= LAST:
            merges, nodes = _finish(nodes, limit if distance is not None else math.inf)
            found.append(merges)
            break
        edges = staged(near_pairs(nodes, limit))
        while (linked := edges.select("a").distinct().count()) > LAST:
            merges, nodes, edges = _round(nodes, edges, limit)
            found.append(merges)
        if linked:
            some = edges.select(F.col("a").alias("id")).distinct()
            merges, rest = _finish(nodes.join(some, "id", "left_semi"), limit)
            found.append(merges)
            nodes = staged(nodes.join(some, "id", "left_anti").unionByName(rest))
    return staged(reduce(DataFrame.unionByName, [f.withColumn("step", F.lit(n)) for n, f in enumerate(found)]))


def _lifts(tree: DataFrame) -> list[DataFrame]:
    """For 1, 2, 4, ... steps: item, parent after so many, and the greatest rank on the way."""
    lifts = [staged(tree.select("item", "parent", "rank"))]
    while True:
        up = lifts[-1]
        nxt = staged(up.alias("x").join(up.alias("y"), F.col("x.parent") == F.col("y.item")).select("x.item", "y.parent", F.greatest("x.rank", "y.rank").alias("rank")))
        if not nxt.limit(1).count():
            return lifts
        lifts.append(nxt)


def cuts(items: DataFrame, tree: DataFrame, ks: list[int]) -> DataFrame:
    """item, k, cluster: for each k, the clusters (by their smallest item) of all items once the lowest merges have left k of
    them, or all merges if there are not enough.

    Merges are ranked by height; an item's cluster at k is as far up as ranks are below the number of items less k. That is a range join
    on each power of two of steps, for all k at once."""
    n = items.count()
    by_rank = ranked(tree.withColumn("_key", F.lit(0)), "_key", "height", "step", "item").withColumnRenamed("_at", "rank")
    levels = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(max(0, n - k)).cast("long").alias("limit")) for k in ks])).alias("level")
    out = items.select("item", levels).select("item", "level.*", F.col("item").alias("cluster"))
    for lift in reversed(_lifts(by_rank)):
        up = lift.select(F.col("item").alias("at"), "parent", "rank")
        out = out.join(up, (F.col("cluster") == F.col("at")) & (F.col("rank") < F.col("limit")), "left").select("item", "k", "limit", F.coalesce("parent", "cluster").alias("cluster"))
    return out.select("item", "k", "cluster")


def clusters_below(items: DataFrame, tree: DataFrame) -> DataFrame:
    """item, cluster: the clusters that all merges of the tree give."""
    return cuts(items, tree, [0]).select("item", "cluster")


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """A list column, whose lists must be of one length, as rows; null components are NaN."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    widths = np.unique(flat.value_lengths().to_numpy(zero_copy_only=False))
    if len(widths) > 1:
        raise ValueError(f"vectors of different lengths: {widths[:5].tolist()}")
    return flat.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(flat), int(widths[0]) if len(widths) else 0)


def _unit_rows(x: np.ndarray) -> np.ndarray:
    """Unit vectors; zero ones, and those with components that are null or not finite, become zero vectors."""
    x = np.where(np.isfinite(x).all(1)[:, None], x, 0.0)
    most = np.abs(x).max(axis=1, initial=0)[:, None]
    x = x / np.where(most > 0, most, 1)
    norm = np.sqrt((x * x).sum(1))[:, None]
    return x / np.where(norm > 0, norm, 1)


def _mutual(near: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """a, b, d of the pairs that are the nearest ones of both ends, a < b.

    A pair counts at its lower distance for either end, so the nearest pair of all is among them even if rounding tells its ends apart."""
    k, at = len(near), np.arange(len(near))
    key = np.minimum(at, near) * k + np.maximum(at, near)
    order = np.lexsort((key, d))
    a, b = np.divmod(key[order], k)
    best = np.full(k, k)
    np.minimum.at(best, a, at)
    np.minimum.at(best, b, at)
    ok = (best[a] == at) & (best[b] == at)
    return a[ok], b[ok], d[order][ok]


def _chain(s: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """height, a, b of all merges by a chain of nearest neighbours: three searches a cluster at most."""
    s, size, m = s.copy(), size.copy(), s / size[:, None]
    live, first, chain, merges = np.ones(len(s), bool), 0, [], []
    for _ in range(len(s) - 1):
        while not chain:
            chain, first = ([first] if live[first] else []), first + (not live[first])
        while True:
            d = 1 - m @ m[chain[-1]]
            d[~live] = d[chain[-1]] = np.inf
            b = int(d.argmin())
            # each step is nearer by more than rounding, else a chain might run in a circle
            if len(chain) > 1 and d[chain[-2]] <= d[b] + 1e-12:
                break
            chain.append(b)
        height = float(d[chain[-2]])
        lo, hi = sorted((chain.pop(), chain.pop()))
        merges.append((height, lo, hi))
        s[lo] += s[hi]
        size[lo] += size[hi]
        m[lo], live[hi] = s[lo] / size[lo], False
    h, a, b = zip(*merges, strict=True) if merges else ((), (), ())
    return np.array(h, float), np.array(a, np.int64), np.array(b, np.int64)


def merge_sums(s: np.ndarray, size: np.ndarray, near: np.ndarray | None = None, d: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """height, a, b of all merges of b into a < b, from the sums of unit vectors and the sizes of clusters; what merge_order gives, in
    memory that is linear in the clusters. near, d: the nearest one of each cluster so far as it is known (else below 0), and its distance.

    Pairs that are nearest to each other merge all at once, and only clusters whose nearest one is gone search again. Many that have one
    and the same nearest would search each time it grows, so chains do the rest after SEARCHES searches a cluster."""
    s, size, ids, out, left = s.copy(), size.astype(float), np.arange(len(s)), [], SEARCHES * len(s)
    near, d = (np.full(len(s), -1), np.zeros(len(s))) if near is None else (near.copy(), d.copy())
    stale = near < 0
    while (k := len(ids)) > 1:
        if left < 0:
            h, a, b = _chain(s, size)
            out.append((h, ids[a], ids[b]))
            break
        m, rows = s / size[:, None], np.flatnonzero(stale)
        left -= len(rows) + 16  # what a round takes besides
        for at in range(0, len(rows), step := max(1, AT_ONCE // k)):
            r = rows[at : at + step]
            p = m[r] @ m.T
            p[np.arange(len(r)), r] = -np.inf
            near[r] = p.argmax(1)
            d[r] = 1 - p[np.arange(len(r)), near[r]]
        a, b, h = _mutual(near, d)
        out.append((h, ids[a], ids[b]))
        s[a] += s[b]
        size[a] += size[b]
        touched, kept = np.zeros(k, bool), np.ones(k, bool)
        touched[a] = touched[b] = True
        kept[b] = False
        stale, place = (touched | touched[near])[kept], np.cumsum(kept) - 1
        s, size, ids, d, near = s[kept], size[kept], ids[kept], d[kept], place[near[kept]]
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64))


def cut_vectors(x: np.ndarray, clusters: int) -> np.ndarray:
    """The cluster of each of the rows, named by its first row: the lowest merges until `clusters` are left. Equal vectors merge
    first, but for zero vectors, which are at distance 1 from each other too."""
    unit, n = _unit_rows(x), len(x)
    own = np.where(unit.any(1), 0, np.arange(1, n + 1))
    _, first, same, size = np.unique(np.c_[unit, own], axis=0, return_index=True, return_inverse=True, return_counts=True)
    rep = first[same]
    more, order = np.flatnonzero(rep != np.arange(n)), np.argsort(first)
    first, size = first[order], size[order]
    h, a, b = merge_sums(unit[first] * size[:, None], size)
    h, a, b = np.concatenate((np.zeros(len(more)), h)), np.concatenate((rep[more], first[a])), np.concatenate((more, first[b]))
    low = np.argsort(h, kind="stable")[: max(0, n - clusters)]
    up = np.arange(n)
    up[b[low]] = a[low]
    while (up != up[up]).any():
        up = up[up]
    return up


def _by_label(df: DataFrame, labels: int) -> DataFrame:
    """df in so many partitions that labels seldom share one; sizes in bytes don't tell how long a label takes."""
    return df.repartition(min(4096, max(4 * labels, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))), "label")


def _search(nodes: DataFrame, sizes: DataFrame, tiles: int) -> DataFrame:
    """nodes with near and d where they had none: each one's nearest of its label, the smaller id if there are several.

    Those that search meet all of their label in tiles; a row travels once for each of the tiles that it is in."""
    side = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    met = nodes.select("label", "id", "near", F.transform("s", lambda x: x / F.col("n")).alias("m")).join(sizes.where("asking > 0"), "label")
    left = met.where("near is null").select("label", side("asking").alias("i"), each("tiles").alias("j"), "id", "m").repartition(tiles, "label", "i", "j")
    right = met.select(F.col("label").alias("l2"), each("asking").alias("i2"), side("tiles").alias("j2"), F.col("id").alias("id2"), F.col("m").alias("m2")).repartition(tiles, "l2", "i2", "j2")
    kind = pa.schema([("id", pa.int64()), ("near", pa.int64()), ("d", pa.float64())])

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        if not len(a) or not len(b):
            return kind.empty_table()
        b = b.sort_by("id2")
        x, y, ids, others = _matrix(a["m"]), _matrix(b["m2"]), a["id"].to_numpy(), b["id2"].to_numpy()
        own = np.minimum(np.searchsorted(others, ids), len(others) - 1)
        self, near, d = others[own] == ids, np.zeros(len(ids), np.int64), np.zeros(len(ids))
        for at in range(0, len(ids), step := max(1, AT_ONCE // len(others))):
            r = slice(at, at + step)
            p = x[r] @ y.T
            p[np.flatnonzero(self[r]), own[r][self[r]]] = -np.inf
            at_most = p.argmax(1)
            near[r], d[r] = others[at_most], 1 - p[np.arange(len(p)), at_most]
        found = np.isfinite(d)
        return pa.table([ids[found], near[found], d[found]], schema=kind)

    got = left.groupBy("label", "i", "j").cogroup(right.groupBy("l2", "i2", "j2")).applyInArrow(meet, "id long, near long, d double")
    got = got.groupBy("id").agg(F.min(F.struct("d", "near")).alias("e")).select("id", F.col("e.d").alias("d2"), F.col("e.near").alias("near2"))
    return staged(nodes.join(got, "id", "left").select("label", "id", "n", "s", F.coalesce("near", "near2").alias("near"), F.coalesce("d", "d2").alias("d")))


def _merge(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Merges of all that are nearest to each other, and the nodes after it; those whose nearest one is gone or has grown have none."""
    edges = nodes.groupBy(F.least("id", "near").alias("lo"), F.greatest("id", "near").alias("hi")).agg(F.min("d").alias("d"), F.first("label").alias("label"))
    ends = edges.select(F.explode(F.array("lo", "hi")).alias("end"), F.struct("d", "lo", "hi", "label").alias("e")).groupBy("end").agg(F.min("e").alias("e"))
    both = ends.groupBy("e").count().where("count = 2").select("e.*")
    merges = staged(both.select("label", F.col("hi").alias("item"), F.col("lo").alias("parent"), F.col("d").alias("height")))
    gone = nodes.join(merges.select(F.col("item").alias("id"), "parent"), "id").select(F.col("parent").alias("id"), F.col("n").alias("n2"), F.col("s").alias("s2"))
    touched = merges.select(F.explode(F.array("item", "parent")).alias("near"), F.lit(True).alias("hit"))
    kept = nodes.join(merges.select(F.col("item").alias("id")), "id", "left_anti").join(gone, "id", "left").join(touched, "near", "left")
    fresh = F.col("n2").isNull() & F.col("hit").isNull()
    total = F.when(F.col("s2").isNull(), F.col("s")).otherwise(F.zip_with("s", "s2", lambda x, y: x + y))
    return merges, staged(kept.select("label", "id", (F.col("n") + F.coalesce("n2", F.lit(0))).alias("n"), total.alias("s"), F.when(fresh, F.col("near")).alias("near"), F.when(fresh, F.col("d")).alias("d")))


def _large_labels(df: DataFrame, clusters: int) -> DataFrame:
    """label, item, root: of labels of any size; df: label, item, vector."""
    kind, what = df.schema["label"].dataType.simpleString(), df.schema["item"].dataType.simpleString()

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = batch.column("vector").value_lengths().to_numpy(zero_copy_only=False)
            for w in np.unique(widths):  # each label has its own
                b = batch.take(pa.array(np.flatnonzero(widths == w)))
                u = _unit_rows(_matrix(b.column("vector")))
                flat = pa.ListArray.from_arrays(np.arange(len(u) + 1, dtype=np.int32) * u.shape[1], u.ravel())
                yield pa.RecordBatch.from_arrays([b.column("label"), b.column("item"), b.column("id"), flat], names=["label", "item", "id", "s"])

    numbered = staged(df.orderBy("label", "item").withColumn("id", F.monotonically_increasing_id()))
    base = staged(numbered.select("label", "item", "id", "vector").mapInArrow(units, f"label {kind}, item {what}, id long, s array<double>").withColumn("own", F.when(~F.exists("s", lambda v: v != 0), F.col("id")).otherwise(-1)))
    unstaged(numbered)
    reps = staged(base.groupBy("label", "s", "own").agg(F.min("id").alias("rep"), F.count("*").alias("n")))
    equal = base.join(reps, ["label", "s", "own"]).where("id <> rep").select("label", F.col("id").alias("item"), F.col("rep").alias("parent"), F.lit(0.0).alias("height"))
    nodes = staged(reps.select("label", F.col("rep").alias("id"), "n", F.transform("s", lambda x: x * F.col("n")).alias("s"), F.lit(None).cast("long").alias("near"), F.lit(None).cast("double").alias("d")))
    found, small = [equal], []
    while True:
        sizes = nodes.groupBy("label").agg(F.count("*").alias("live"), F.ceil(F.count("*") / TILE).cast("int").alias("tiles"), F.count_if(F.col("near").isNull()).alias("asking"), F.max(F.size("s")).alias("width"))
        few = (F.col("live") * F.col("asking") <= WHOLE * WHOLE) & (F.col("live") * F.col("width") <= NUMBERS)
        sizes = staged(sizes.select("label", "tiles", F.ceil(F.col("asking") / TILE).cast("int").alias("asking"), ((F.col("live") <= WHOLE) | few).alias("whole")))
        wholes, tiles = sizes.agg(F.count_if("whole"), F.sum(F.when(~F.col("whole"), F.col("tiles") * F.col("asking")))).first()
        if wholes:
            small.append(staged(nodes.join(sizes.where("whole"), "label", "left_semi")))
        if tiles is None:
            break
        large = sizes.where("not whole").drop("whole")
        searched = _search(nodes.join(large, "label", "left_semi"), large, max(1, min(4096, tiles)))
        unstaged(nodes)
        merges, nodes = _merge(searched)
        unstaged(searched)
        found.append(merges)
    width = f"label {kind}, item long, parent long, height double"

    def finish(t: pa.Table) -> pa.Table:
        t = t.sort_by("id")
        ids = t["id"].to_numpy()
        near = np.where(t["near"].is_null().to_numpy(), -1, np.searchsorted(ids, t["near"].fill_null(-1).to_numpy()))
        h, a, b = merge_sums(_matrix(t["s"]), t["n"].to_numpy(), near, t["d"].fill_null(0.0).to_numpy())
        return pa.table({"label": t["label"].take(pa.array(b)), "item": ids[b], "parent": ids[a], "height": h})

    rest = reduce(DataFrame.unionByName, small)
    found.append(_by_label(rest, rest.select("label").distinct().count()).groupBy("label").applyInArrow(finish, width))
    tree = staged(reduce(DataFrame.unionByName, [f.withColumn("step", F.lit(n)) for n, f in enumerate(found)]))
    # all but the highest merges, each label's last
    last = F.row_number().over(Window.partitionBy("label").orderBy(F.desc("height"), F.desc("step"), F.desc("item")))
    high = tree.withColumn("last", last).where(F.col("last") <= clusters - 1).select("item")
    up = staged(tree.join(high, "item", "left_anti").select("item", "parent"))
    while True:
        nxt = up.select(F.col("item").alias("parent"), F.col("parent").alias("further"))
        nxt = staged(up.join(nxt, "parent", "left").select("item", F.coalesce("further", "parent").alias("parent"), F.col("further").isNotNull().alias("moved")))
        up = nxt.select("item", "parent")
        if not nxt.where("moved").limit(1).count():
            break
    root = up.select(F.col("item").alias("id"), F.col("parent").alias("root"))
    return base.select("label", "item", "id").join(root, "id", "left").select("label", "item", F.coalesce("root", "id").alias("root"))


def label_clusters(df: DataFrame, label: str, item: str, vector: str, clusters: int, most: int | None = None) -> DataFrame:
    """label, item, cluster_id: `clusters` average-linkage clusters of each label's vectors under cosine distance, numbered by their smallest item.

    Each row is an item of its own. Null labels, items and vectors play no part; zero vectors, and those with components that are null or not
    finite, are at distance 1 from all. A label's vectors must be of one length. A label of up to `most` vectors (WHOLE) is one task."""
    most = WHOLE if most is None else most
    rows = staged(df.where(f"{label} is not null and {item} is not null and {vector} is not null").select(F.col(label).alias("label"), F.col(item).alias("item"), F.col(vector).alias("vector")))
    sizes = staged(rows.groupBy("label").agg(F.count("*").alias("live")))
    kind, what = rows.schema["label"].dataType.simpleString(), rows.schema["item"].dataType.simpleString()

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("item")
        got = np.unique(cut_vectors(_matrix(t["vector"]), clusters), return_inverse=True)[1]
        return pa.table({"label": t["label"], "item": t["item"], "cluster_id": got.astype(np.int32)})

    whole = sizes.where(F.col("live") <= most)
    out = _by_label(rows.join(whole, "label", "left_semi"), whole.count()).groupBy("label").applyInArrow(run, f"label {kind}, item {what}, cluster_id int")
    large = sizes.where(F.col("live") > most)
    if large.limit(1).count():
        got = staged(_large_labels(rows.join(large, "label", "left_semi"), clusters))
        number = F.row_number().over(Window.partitionBy("label").orderBy("root")) - 1  # as many rows as clusters
        got = got.join(got.select("label", "root").distinct().withColumn("cluster_id", number.cast("int")), ["label", "root"])
        out = out.unionByName(got.select("label", "item", "cluster_id"))
    return out.select(F.col("label").alias(label), F.col("item").alias(item), "cluster_id")
