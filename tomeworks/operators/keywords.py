"""Keywords: counts, clusters and canonical forms."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalize_keyword
from ..sources.staging import staged


def keyword_counts(docs: DataFrame, keywords: Column, key: Column) -> DataFrame:
    """keyword, n_docs: in how many distinct documents (by key) each normalised keyword occurs.

    Documents are made distinct first, and a row's keywords within the row, so that the count needs no distinct."""
    rows = docs.select(key.alias("_key"), keywords.alias("_words")).dropDuplicates(["_key"]).select(F.array_distinct("_words").alias("_words"))
    own = F.array_distinct(F.filter(F.transform("_words", normalize_keyword), lambda k: k.isNotNull() & (k != "")))
    return rows.select(F.explode(own).alias("keyword")).groupBy("keyword").agg(F.count("*").alias("n_docs"))


def distinct_words(rows: DataFrame, words: str) -> DataFrame:
    """raw, keyword: each different raw word with its normalised form."""
    return rows.select(F.explode(words).alias("raw")).distinct().withColumn("keyword", normalize_keyword(F.col("raw")))


def apply_canonical(rows: DataFrame, key: str, words: str, mapping: DataFrame) -> DataFrame:
    """key, canonical: sorted distinct canonical keywords of each row; keywords without a label stay, empty labels go.

    mapping: keyword, label. Each different raw word is normalised and labelled once; rows meet the result by a join on the
    raw word."""
    labels = distinct_words(rows, words).join(mapping, "keyword", "left").select("raw", F.coalesce("label", "keyword").alias("word")).where("word <> ''")
    got = rows.select(key, F.explode(words).alias("raw")).join(labels, "raw")
    return got.groupBy(key).agg(F.array_sort(F.collect_set("word")).alias("canonical"))


def label_clusters(clusters: DataFrame) -> DataFrame:
    """cluster_id, label: the shortest, then first keyword of each cluster (the offline labeller)."""
    return clusters.groupBy("cluster_id").agg(normalize_keyword(F.min_by("keyword", F.struct(F.length("keyword"), F.col("keyword")))).alias("label"))


def count_clusters(clusters: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    """n_clusters: how many clusters there are, as one row."""
    return clusters.agg(F.countDistinct(cluster).alias("n_clusters"))


def tag_sets(tags: DataFrame, canonical: str, tag: str) -> DataFrame:
    """canonical, tags: the sorted set of tags that each canonical one stands for."""
    return tags.where(f"{canonical} is not null").groupBy(canonical).agg(F.array_sort(F.collect_set(tag)).alias("tags"))


def cluster_points(embeddings: DataFrame, clusters: DataFrame, item: str) -> DataFrame:
    """The embeddings of clustered items, in the clusters' order."""
    return embeddings.join(clusters, item).orderBy("cluster_id", item)


def silhouette_by_k(df: DataFrame, item: str, vector: str, ks: list[int]) -> list[tuple[int, float]]:
    """(k, mean silhouette) of the cuts of one agglomerative clustering."""
    from .agglomerate import cuts, dendrogram

    known = df.where(f"{item} is not null and {vector} is not null").select(F.col(item).alias("item"), F.col(vector).alias("vector"))
    cut, out = staged(cuts(known.select("item"), dendrogram(known, "item", "vector"), ks)), []
    for k in ks:
        one = staged(cut.where(F.col("k") == k).select("item", F.col("cluster").alias("cluster_id")).join(known, "item").select(F.col("item").alias(item), F.col("vector").alias(vector), "cluster_id"))
        sizes = one.groupBy("cluster_id").agg(F.count("*").alias("n"))
        mean = silhouette(one, item, vector, "cluster_id").join(sizes, "cluster_id").agg(F.sum(F.col("silhouette") * F.col("n")) / F.sum("n")).first()[0]
        out.append((k, mean))
    return out


def merge_order(d: np.ndarray, size: np.ndarray, linkage: str = "average") -> list[tuple[float, int, int]]:
    """(height, a, b) of all merges of b into a < b, lowest first, from the distances (which are overwritten) and sizes of clusters."""
    np.fill_diagonal(d, np.inf)
    n = len(d)
    size, live, merges, chain = size.copy(), np.ones(n, bool), [], []
    for _ in range(n - 1):
        if not chain:
            chain.append(int(np.flatnonzero(live)[0]))
        while True:
            a = chain[-1]
            b = int(d[a].argmin())
            if len(chain) > 1 and d[a, chain[-2]] <= d[a, b]:
                b = chain[-2]
            if len(chain) > 1 and b == chain[-2]:
                break
            chain.append(b)
        chain = chain[:-2]
        lo, hi = min(a, b), max(a, b)
        merges.append((float(d[lo, hi]), lo, hi))
        if linkage == "average":
            row = (size[lo] * d[lo] + size[hi] * d[hi]) / (size[lo] + size[hi])
        elif linkage == "complete":
            row = np.maximum(d[lo], d[hi])
        elif linkage == "single":
            row = np.minimum(d[lo], d[hi])
        elif linkage == "ward":  # on squares, which are undone in the heights
            row = ((size[lo] + size) * d[lo] + (size[hi] + size) * d[hi] - size * d[lo, hi]) / (size[lo] + size[hi] + size)
        else:
            raise ValueError(f"no such linkage: {linkage}")
        row[lo] = np.inf
        d[lo] = d[:, lo] = row
        d[hi] = d[:, hi] = np.inf
        size[lo] += size[hi]
        live[hi] = False
    return sorted(merges, key=lambda m: m[0])


def average_linkage(vectors: np.ndarray, clusters: int | None = None, distance: float | None = None, linkage: str = "average") -> np.ndarray:
    """Agglomerative clustering under cosine distance (Euclidean for ward) by nearest-neighbour chains; ties go to the
    lower index.

    Exactly one of clusters and distance must be given. Clusters are numbered by their first member."""
    if (clusters is None) == (distance is None):
        raise ValueError("give either a number of clusters or a distance")
    n = len(vectors)
    unit = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    d = 1 - unit @ unit.T
    if linkage == "ward":
        x = np.asarray(vectors, float)
        squares = (x * x).sum(1)
        d = np.maximum(squares[:, None] + squares - 2 * x @ x.T, 0)
    merges = merge_order(d, np.ones(n), linkage)
    if linkage == "ward":
        merges = [(m[0] ** 0.5, *m[1:]) for m in merges]
    keep = n - min(clusters, n) if clusters is not None else sum(m[0] < distance for m in merges)
    up = np.arange(n)

    def root(x: int) -> int:
        while up[x] != x:
            x = up[x]
        return x

    for _, a, b in merges[:keep]:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return np.unique([root(i) for i in range(n)], return_inverse=True)[1]


def cluster_within(df: DataFrame, block: str, item: str, vector: str, clusters: int | str | None = None, distance: float | None = None, linkage: str = "average") -> DataFrame:
    """block, item, cluster_id: clusters of each block on its own. A block's members are compared with each other in
    one task, so blocks (a coarse partition such as a language or a k-means cell) are to have a bounded size. clusters: their
    number in each block, or the column that has it."""
    own = clusters if isinstance(clusters, str) else None

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(item)
        out = average_linkage(np.stack(pdf[vector].map(np.asarray)), int(pdf[own].iloc[0]) if own else clusters, distance, linkage)
        return pd.DataFrame({block: pdf[block], item: pdf[item], "cluster_id": out.astype("int32")})

    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    return df.select(block, item, vector, *([own] if own else [])).groupBy(block).applyInPandas(run, f"{block} {kinds[block]}, {item} {kinds[item]}, cluster_id int")


def hashing_embedding(text: Column, size: int = 64) -> Column:
    """The offline embedder: counts of hashed character 3-grams, a function of the text alone."""

    @F.pandas_udf("array<float>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import xxhash

        for s in batches:
            out = []
            for x in s:
                v = np.zeros(size, np.float32)
                t = f" {x or ''} "
                for i in range(len(t) - 2):
                    v[xxhash.xxh32_intdigest(t[i : i + 3]) % size] += 1
                out.append(v)
            yield pd.Series(out)

    return run(text)


def silhouette(df: DataFrame, item: str, vector: str, cluster: str, most: int = 256) -> DataFrame:
    """cluster, silhouette: mean cosine silhouette of the items by cluster.

    Mean cosine distances to a cluster follow from the sum of its unit vectors, so no pairs of items are made. The sums
    travel in blocks of about `most` clusters, and an item meets each block once; blocks are repeated over salts, so that no task
    has all items of one."""
    norm = F.sqrt(F.aggregate(F.transform(vector, lambda v: v.cast("double") * v.cast("double")), F.lit(0.0), lambda s, v: s + v))
    unit = df.select(item, cluster, F.transform(vector, lambda v: v.cast("double") / norm).alias("u"))
    sums = unit.select(cluster, F.posexplode("u")).groupBy(cluster, "pos").agg(F.sum("col").alias("s"), F.count("*").alias("n"))
    sums = staged(sums.groupBy(cluster).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "s"))), lambda p: p["s"]).alias("s"), F.first("n").alias("n")))
    blocks, salts = max(1, -(-sums.count() // most)), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parted = sums.groupBy(F.pmod(F.xxhash64(cluster), F.lit(blocks)).alias("block")).agg(F.collect_list(F.struct(F.col(cluster).alias("c"), "s", "n")).alias("others"))
    parted = parted.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    asked = unit.select("*", F.pmod(F.xxhash64(item), F.lit(salts)).alias("salt"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"))
    dot = lambda o: F.aggregate(F.zip_with("u", o["s"], lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    own = F.filter("others", lambda o: (o["c"] == F.col(cluster)) & (o["n"] > 1))
    rest = F.filter("others", lambda o: o["c"] != F.col(cluster))
    met = asked.join(parted, ["block", "salt"]).select(
        item, cluster,
        F.array_max(F.transform(own, lambda o: (o["n"] - dot(o)) / (o["n"] - 1))).alias("a"),
        F.array_min(F.transform(rest, lambda o: 1 - dot(o) / o["n"])).alias("b"),
    )
    each = met.groupBy(item, cluster).agg(F.max("a").alias("a"), F.min("b").alias("b"))
    return each.groupBy(cluster).agg(F.avg(F.when(F.col("a").isNull() | F.col("b").isNull(), 0.0).otherwise(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")))).alias("silhouette"))
