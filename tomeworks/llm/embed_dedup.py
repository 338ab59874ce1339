"""Near-duplicate vectors by an exact metric range join.

Unit vectors with cosine c are sqrt(2 - 2 c) apart, a metric. Pivots partition the vectors: the home of a vector is its
nearest pivot. If x and y are within r, the triangle inequality gives d(x, p) <= d(x, home) + 2 r for the home p of y;
so x is replicated to all pivots of lower number for which that holds (and whose bisecting hyperplane is within r),
and each pair meets in exactly one cell, that of the lower home. Cells join independently of each other: a cell
of many vectors is cut into blocks, and each pair of blocks is a task of bounded size.

Equal vectors of a label are collapsed first and take part once, with their multiplicity. Pivots are the vectors of
lowest hash: of n distinct vectors one for each PER_PIVOT, and beyond PER_PIVOT squared the root of n, where finding the
nearest pivots and comparing within cells grow alike. In many dimensions most pivots are about as far from a vector as each
other, so more of them means more replicas. They are broadcast, PIVOT_BYTES of each length at most, and only steer the
partition: every vector is compared with all it may link with.

Defined results: a vector with null label, null itself, empty, of zero norm, or with null, NaN or infinite
components links with nothing; vectors of different length don't link; null vec_id: no links, null component, kept.
Repeated rows are vectors of their own, and so are different vectors of one vec_id, each with its own links. Ties (a
cosine of exactly the threshold) are links. An empty table gives no rows. Only vec_id, embedding and label are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import stash
from .components import components
from .kernels import labels

#: Distinct vectors for each pivot, bytes of the pivots of one length, distances held at once, vectors in a block, and what
#: rounding may add to a distance.
PER_PIVOT, PIVOT_BYTES, AT_ONCE, BLOCK, SLACK = 2048, 1 << 25, 1 << 20, 4096, 1e-7
#: Vector lengths that have pivots of their own, the most common ones; the vectors of any other length are one cell.
LENGTHS = 64
OUT = pa.schema([("kind", pa.int32()), ("a", pa.int64()), ("b", pa.int64())])


def _unit(column: pa.Array) -> list[np.ndarray]:
    out = []
    for x in column:
        v = np.asarray(x.values.to_numpy(zero_copy_only=False), np.float64)
        out.append(v / np.sqrt(v @ v))
    return out


def _place(pivots, radius: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_size = pivots.value
        for b in batches:
            unit = _unit(b.column("embedding"))
            size = np.array([len(u) for u in unit])
            row, cell, home = [], [], []
            for d in np.unique(size):
                own = np.flatnonzero(size == d)
                p = by_size.get(int(d), np.eye(1, int(d)))
                for some in np.array_split(own, min(len(own), -(-len(own) * len(p) // AT_ONCE))):
                    x = np.stack([unit[i] for i in some])
                    dist = np.sqrt(np.maximum(0, 2 - 2 * (x @ p.T)))
                    near = dist.argmin(axis=1)
                    least = dist[np.arange(len(some)), near]
                    gap = np.sqrt(np.maximum(0, 2 - 2 * (p[near] @ p.T)))
                    reach = dist - least[:, None] <= 2 * radius + SLACK
                    reach &= (dist**2 - least[:, None] ** 2) <= 2 * gap * (radius + SLACK) + SLACK
                    reach &= np.arange(len(p))[None, :] <= near[:, None]
                    reach[np.arange(len(some)), near] = True
                    i, c = np.nonzero(reach)
                    row.append(some[i])
                    cell.append(c)
                    home.append(near[i] == c)
            if not row:
                continue
            row, cell, home = np.concatenate(row), np.concatenate(cell), np.concatenate(home)
            take = b.take(pa.array(row))
            yield pa.RecordBatch.from_arrays([*(take.column(n) for n in ("rep", "mult", "label", "embedding")), pa.array(size[row].astype(np.int32)), pa.array(cell.astype(np.int32)), pa.array(home)], names=["rep", "mult", "label", "embedding", "size", "cell", "home"])

    return run


def _join(cosine: float):
    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        i, j = key[3].as_py(), key[4].as_py()
        ids, mult, home, block = (t[c].to_numpy() for c in ("rep", "mult", "home", "block"))
        unit = _unit(t["embedding"].combine_chunks() if t["embedding"].num_chunks != 1 else t["embedding"].chunk(0))
        x = np.stack(unit)
        a, b = np.flatnonzero(block == i), np.flatnonzero(block == j)
        links, p, q = np.zeros(len(ids), np.int64), [], []
        for at in range(0, len(a), 512):
            rows = a[at : at + 512]
            ok = (x[rows] @ x[b].T >= cosine) & (home[rows][:, None] | home[b][None, :])
            if i == j:
                ok &= rows[:, None] < b[None, :]
            r, c = np.nonzero(ok)
            p.append(rows[r])
            q.append(b[c])
        none = [np.zeros(0, np.int64)]  # a block may be empty
        p, q = np.concatenate(p or none), np.concatenate(q or none)
        np.add.at(links, p, mult[q])
        np.add.at(links, q, mult[p])
        up = labels(len(ids), p, q)
        far, got = np.flatnonzero(up != np.arange(len(ids))), np.flatnonzero(links)
        kind = np.concatenate((np.ones(len(far), np.int32), np.zeros(len(got), np.int32)))
        return pa.table([pa.array(kind), pa.array(np.concatenate((ids[up[far]], ids[got]))), pa.array(np.concatenate((ids[far], links[got])))], schema=OUT)

    return run


def embedding_near_duplicates(vectors: DataFrame, cosine: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, n_links, component_id, kept; see the module's text."""
    spark = vectors.sparkSession
    radius = math.sqrt(max(0.0, 2 - 2 * cosine))
    e = F.col("embedding")
    base = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding"), F.col(label_col).alias("label"))
    sound = F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(e, lambda v: v != 0)
    base = base.withColumn("sound", F.coalesce(sound & F.col("label").isNotNull() & F.col("vec_id").isNotNull(), F.lit(False)))
    base = stash(base)
    same = stash(base.where("sound").groupBy("label", "embedding").agg(F.min("vec_id").alias("least"), F.count("*").alias("mult"), F.xxhash64("label", "embedding").alias("hash")))
    # an id that stands for several vectors is the node of one of them, the others have a hash for a node
    shared = same.groupBy("least").agg(F.min("hash").alias("own"), F.count("*").alias("sets")).where("sets > 1")
    node = F.when(F.col("own").isNull() | (F.col("own") == F.col("hash")), F.col("least")).otherwise(F.col("hash"))
    same = stash(same.join(shared, "least", "left").withColumn("rep", node).drop("own", "sets", "hash"))
    n = same.count()
    top = max(1, min(n // PER_PIVOT, math.isqrt(n)))
    pivots: dict[int, np.ndarray] = {}
    sizes = [r["d"] for r in same.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").limit(LENGTHS).collect()]
    for d in sizes:
        got = same.where(F.size("embedding") == d).select("embedding", F.xxhash64("embedding").alias("h")).orderBy("h").limit(max(1, min(top, PIVOT_BYTES // (8 * d)))).toArrow()
        pivots[d] = np.stack(_unit(got["embedding"].combine_chunks()))
    cells = same.mapInArrow(_place(spark.sparkContext.broadcast(pivots), radius), "rep long, mult long, label " + same.schema["label"].dataType.simpleString() + ", embedding array<double>, size int, cell int, home boolean")
    cells = stash(cells)
    blocks = stash(cells.groupBy("label", "size", "cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")))
    placed = cells.join(blocks, ["label", "size", "cell"]).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    found = stash(placed.select("label", "size", "cell", "i", "j", "rep", "mult", "embedding", "home", "block").groupBy("label", "size", "cell", "i", "j").applyInArrow(_join(cosine), "kind int, a long, b long"))
    comp = components(found.where("kind = 1"))
    links = found.where("kind = 0").groupBy("a").agg(F.sum("b").alias("more")).withColumnRenamed("a", "rep")
    classes = same.join(links, "rep", "left").join(comp.select(F.col("node").alias("rep"), "component"), "rep", "left")
    classes = stash(classes.withColumn("component", F.coalesce("component", "rep")))
    least = classes.groupBy("component").agg(F.min("least").alias("id"))  # a component's name is its smallest id
    classes = stash(classes.join(least, "component").select("label", "embedding", F.col("id").alias("component"), (F.col("mult") - 1 + F.coalesce("more", F.lit(0))).alias("links")))
    linked = base.where("sound").join(classes, ["label", "embedding"]).select("vec_id", "links", "component")
    alone = base.where("not sound").select("vec_id", F.lit(0).cast("long").alias("links"), F.col("vec_id").alias("component"))
    out = linked.unionByName(alone)
    return out.select("vec_id", F.col("links").cast("long").alias("n_links"), F.col("component").cast("long").alias("component_id"), F.coalesce(F.col("vec_id") == F.col("component"), F.lit(True)).alias("kept"))


SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL
                AND list_sum(list_transform(embedding, lambda x: CASE WHEN x IS NULL OR NOT isfinite(x) THEN 1 ELSE 0 END)) = 0 AND list_sum(list_transform(embedding, lambda x: abs(x))) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98),
r AS (SELECT DISTINCT a AS n, b AS m FROM l UNION SELECT r.n, l.b FROM r JOIN l ON l.a = r.m),
c AS (SELECT n, min(m) AS m FROM r GROUP BY n), d AS (SELECT a, count(*) AS k FROM l GROUP BY a)
SELECT e.vec_id, coalesce(d.k, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(c.m, e.vec_id)) AS component_id, e.vec_id = least(e.vec_id, coalesce(c.m, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN c ON c.n = e.vec_id LEFT JOIN d ON d.a = e.vec_id
"""
