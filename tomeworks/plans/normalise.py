"""From the run log to normalised metadata, and back to the files: canonical keywords and publishers, payloads, sidecars."""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.metadata import to_info
from ..functions.text import moved_below, normalize_keyword
from ..functions.xmp import differs, write_xmp
from ..operators import keywords as K
from ..operators import lookup, publishers
from ..operators.agglomerate import clusters_below, cuts, dendrogram, label_clusters
from ..providers.base import ask
from ..sources import pdf
from ..sources.staging import staged

Embed = Callable[[Column], Column]


def distinct_keywords(rows: DataFrame, words: str = "keywords") -> DataFrame:
    """keyword: all normalised keywords of the rows, each once, without blank ones."""
    return K.distinct_words(rows, words).select("keyword").where("keyword <> ''").distinct()


def cells(vectors: DataFrame, n: int, most: int, seed: int = 7, item: str = "keyword") -> DataFrame:
    """vectors with `cell`: k-means cells of the n vectors, aimed at `most` members; those that got more are split by hash.

    Up to `most` vectors are one cell, so clusters of small inputs are found over all of them."""
    k = -(-n // most)
    if k < 2:
        return vectors.withColumn("cell", F.lit("0"))
    model = KMeans(k=k, seed=seed, featuresCol="_v", predictionCol="_c").fit(vectors.select(array_to_vector("embedding").alias("_v")))
    got = staged(model.transform(vectors.withColumn("_v", array_to_vector("embedding"))).drop("_v"))
    sizes = got.groupBy("_c").agg(F.ceil(F.count("*") / most).alias("_parts"))
    return got.join(sizes, "_c").withColumn("cell", F.concat_ws("-", F.col("_c").cast("string"), F.pmod(F.xxhash64(item), F.col("_parts")).cast("string"))).drop("_c", "_parts")


def canonical_keywords(words: DataFrame, clusters: int | None = None, distance: float | None = None, linkage: str = "average", embed: Embed = K.hashing_embedding, labeller: str | None = None, most: int = 4096) -> DataFrame:
    """keyword, label: every keyword with the label of its cluster.

    words: keyword. Clusters are agglomerative under cosine distance. Up to `most` keywords are one task; more are clustered in
    rounds by average linkage, with the same clusters but for ties, and by other linkages within k-means cells of at most that many, where a
    number of clusters is shared out by the cells' sizes. The label is the shortest keyword, or the first line that the
    provider `labeller` gives for the list of them, normalised; keywords of a cluster it gives none for stay."""
    v = staged(words.select("keyword", embed(F.col("keyword")).alias("embedding")))
    n = v.count()

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        import numpy as np

        pdf = pdf.sort_values("keyword")
        share = None if clusters is None else max(1, round(clusters * len(pdf) / n))
        ids = K.average_linkage(np.stack(pdf["embedding"].map(np.asarray)).astype(float), share, distance, linkage)
        return pd.DataFrame({"keyword": pdf["keyword"], "cluster_id": [f"{c}/{i}" for c, i in zip(pdf["cell"], ids, strict=True)]})

    if n > most and linkage == "average":
        items = v.select(F.col("keyword").alias("item"))
        tree = dendrogram(v, "keyword", "embedding", distance, clusters or 1)
        cut = clusters_below(items, tree) if clusters is None else cuts(items, tree, [clusters])
        got = staged(cut.select(F.col("item").alias("keyword"), F.col("cluster").alias("cluster_id")))
    else:
        got = staged(cells(v, n, most).groupBy("cell").applyInPandas(run, "keyword string, cluster_id string"))
    if labeller is None:
        labels = K.label_clusters(got)
    else:
        groups = got.groupBy("cluster_id").agg(F.to_json(F.array_sort(F.collect_list("keyword"))).alias("request"))
        first = F.regexp_replace(F.trim(F.split("response", "\n")[0]), r"^[\"']+|[\"']+$", "")
        labels = ask(groups, "cluster_id", "request", labeller).select("cluster_id", normalize_keyword(first).alias("label"))
    return got.join(labels, "cluster_id", "left").select("keyword", F.coalesce("label", "keyword").alias("label"), "cluster_id")


def clusters_of_labels(df: DataFrame, label: str, item: str, vector: str, clusters: int, most: int | None = None) -> DataFrame:
    """block, item, cluster_id: `clusters` average-linkage clusters of each label's vectors, numbered by their smallest item.

    Labels of up to `most` vectors are a task each, larger ones are clustered together in rounds; see `label_clusters`."""
    got = label_clusters(df, label, item, vector, clusters, most)
    return got.select(F.concat(F.col(label).cast("string"), F.lit("-0")).alias("block"), item, "cluster_id")


def normalised(runs: DataFrame, mapping: DataFrame, threshold: float = 75.0) -> DataFrame:
    """The rows of `runs` (parsed run log) with canonical_keywords, canonical_publisher and entity."""
    runs = runs.withColumn("_row", F.xxhash64("pdf_hash", "run_timestamp", "result"))
    runs = staged(runs.dropDuplicates(["_row"]))
    canon = K.apply_canonical(runs, "_row", "keywords", mapping.select("keyword", "label"))
    # names keep the order of their first run
    names = staged(publishers.publisher_names(runs, "publisher", "run_timestamp"))
    chosen = publishers.canonical_names(publishers.greedy_groups(names, publishers.fuzzy_pairs(names, threshold)))
    out = runs.join(canon, "_row", "left").join(chosen.select(F.col("name").alias("publisher"), F.col("canonical").alias("canonical_publisher")), "publisher", "left")
    out = out.withColumn("canonical_keywords", F.coalesce("canonical", F.array().cast("array<string>")))
    entity = lookup.book_entity(F.col("author"), F.col("title"), F.col("subtitle"), F.col("publisher"), F.col("canonical_publisher"), F.col("canonical_keywords"), F.lit(None).cast("array<string>"), F.col("description"), F.col("isbn_identifiers"))
    return out.withColumn("entity", entity).drop("_row", "canonical")


def write_sidecars(files: DataFrame, meta: DataFrame, root: str, target: str, now: Column | None = None) -> DataFrame:
    """path, dest, status of each file: its payload and XMP packet beside its place below `target`, as <name>.json and
    <name>.xmp; `done`, `exists` where there is one, `no metadata`, or `failed: reason`.

    files: path, file_hash, file_name. meta: the same keys, entity and order. Where target is root, the files go to
    __normalized__ below it. Paths are mounted on the executors; a file is put in place by a rename, so that a task that
    is repeated does no harm."""
    root, target = os.path.abspath(root), os.path.abspath(target)
    if root == target:
        target = os.path.join(target, "__normalized__")
    found = lookup.metadata_lookup(files, meta, "order")
    e = lookup.writer_payload(F.col("entity"))
    packet = write_xmp({k: e[k] for k in ("title", "description", "publisher", "isbn13", "isbn10", "authors", "categories")}, now if now is not None else F.current_timestamp())
    dest = moved_below(F.col("path"), root, target)
    rows = found.select("path", dest.alias("dest"), F.when(F.col("entity").isNotNull(), F.to_json(e)).alias("payload"), packet.alias("packet"))

    def put(path: str, text: str) -> None:
        part = f"{path}.{os.getpid()}.part"
        with open(part, "w", encoding="utf-8") as f:
            f.write(text)
        os.replace(part, path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            status = []
            for dest, payload, packet in zip(pdf["dest"], pdf["payload"], pdf["packet"], strict=True):
                try:
                    if payload is None:
                        status.append("no metadata")
                    elif os.path.exists(dest + ".json"):
                        status.append("exists")
                    else:
                        os.makedirs(os.path.dirname(dest), exist_ok=True)
                        put(dest + ".xmp", packet)
                        put(dest + ".json", json.dumps(json.loads(payload), ensure_ascii=False, indent=2))
                        status.append("done")
                except OSError as x:
                    status.append(f"failed: {x}")
            yield pdf[["path", "dest"]].assign(status=status)

    return rows.mapInPandas(run, "path string, dest string, status string")


def write_pdfs(content: DataFrame, files: DataFrame, meta: DataFrame, root: str, target: str, now: Column | None = None) -> DataFrame:
    """path, dest, status of each file: a copy with info entries and XMP packet written into it, at its place below `target`.
    content: path, content; the rest as in write_sidecars. A file whose packet says the same already is left: `unchanged`."""
    root, target = os.path.abspath(root), os.path.abspath(target)
    if root == target:
        target = os.path.join(target, "__normalized__")
    e = lookup.writer_payload(F.col("entity"))
    packet = write_xmp({k: e[k] for k in ("title", "description", "publisher", "isbn13", "isbn10", "authors", "categories")}, now if now is not None else F.current_timestamp())
    dest = moved_below(F.col("path"), root, target)
    known = lookup.metadata_lookup(files, meta, "order").select("path", dest.alias("dest"), "entity")
    old = pdf.documents(content).select("path", F.col("xmp").alias("old"))
    told = known.join(old, "path").select("path", "dest", F.col("entity").isNotNull().alias("known"), to_info(e).alias("info"), packet.alias("packet"), differs(F.col("old"), packet).alias("changed"))
    due = staged(told)
    made = pdf.embed(content.join(due.where("known and changed"), "path").select("path", "content", "info", "packet"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            status = []
            for place, data, error in zip(frame["dest"], frame["content"], frame["error"], strict=True):
                try:
                    if error is not None:
                        status.append(f"failed: {error}")
                    elif os.path.exists(place):
                        status.append("exists")
                    else:
                        os.makedirs(os.path.dirname(place), exist_ok=True)
                        part = f"{place}.{os.getpid()}.part"
                        with open(part, "wb") as f:
                            f.write(data)
                        os.replace(part, place)
                        status.append("done")
                except OSError as x:
                    status.append(f"failed: {x}")
            yield frame[["path", "dest"]].assign(status=status)

    written = made.join(due.select("path", "dest"), "path").mapInPandas(run, "path string, dest string, status string")
    rest = due.where("not known or not changed").select("path", "dest", F.when(F.col("known"), "unchanged").otherwise("no metadata").alias("status"))
    return written.unionByName(rest)


def failures(statuses: DataFrame, path: str) -> None:
    """The log of what failed: one line a file, anew for each job."""
    statuses.where(F.col("status").startswith("failed")).select(F.concat_ws("\t", "path", "status")).write.mode("overwrite").text(path)


def save(rows: DataFrame, path: str) -> None:
    """The table of normalised metadata, replacing the one before."""
    rows.write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
