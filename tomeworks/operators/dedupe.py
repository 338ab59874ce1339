"""First-seen deduplication and what follows from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import staged


def first_seen(df: DataFrame, key: Column, order: str) -> DataFrame:
    """df with dup_key, status (unique, duplicate) and first_seen: of equal keys the row of least `order` is unique.

    Rows without a key are unique. The first row of each key comes from an aggregation, which combines before the
    shuffle, and a join that AQE may split, so that a key with a third of all rows needs no task of its own."""
    df = df.withColumn("dup_key", key)
    first = df.where("dup_key is not null").groupBy("dup_key").agg(F.min(order).alias("first_seen"))
    out = df.join(first, "dup_key", "left")
    return out.withColumn("first_seen", F.coalesce("first_seen", order)).withColumn("status", F.when(F.col("first_seen") == F.col(order), "unique").otherwise("duplicate"))


def content_signature(pages: DataFrame, doc: str, number: str, digest: str) -> DataFrame:
    """doc, signature: number of pages, digests of the first and the last one; null where either can't be told."""
    first, last = F.min_by(digest, number), F.max_by(digest, number)
    got = pages.groupBy(doc).agg(F.count("*").alias("page_count"), first.alias("first"), last.alias("last"))
    return got.select(doc, F.when(F.col("first").isNotNull() & F.col("last").isNotNull(), F.struct("page_count", "first", "last")).alias("signature"))


def ranked(df: DataFrame, key: str, *order: str) -> DataFrame:
    """df with `_at`: the place of each row among those of its key, from 0, in the order given.

    Rows are numbered within ranges of (key, order) and moved by what the ranges before hold, so that a key that a third
    of all rows have needs no task of its own."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = staged(df.repartitionByRange(n, key, *order).withColumn("_part", F.spark_partition_id()))
    sizes = ranged.groupBy(key, "_part").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.sum("_n").over(Window.partitionBy(key).orderBy("_part")) - F.col("_n")).drop("_n")
    own = ranged.withColumn("_own", F.row_number().over(Window.partitionBy(key, "_part").orderBy(*order)) - 1)
    return own.join(before, [key, "_part"]).withColumn("_at", F.col("_own") + F.col("_before")).drop("_part", "_own", "_before")


def _taken_numbers(names: DataFrame, name: str) -> DataFrame:
    """target, number: what each name takes: number 0 of itself, and k of the target whose k-th name it is."""
    numbered = r"^(.*)_([1-9]\d{0,8})(\.[^./]*)?$"
    itself = F.struct(F.col(name).alias("target"), F.lit(0).cast("long").alias("number"))
    other = F.struct(F.concat(F.regexp_extract(name, numbered, 1), F.regexp_extract(name, numbered, 3)).alias("target"), F.regexp_extract(name, numbered, 2).try_cast("long").alias("number"))
    return names.select(F.explode(F.array(itself, other)).alias("t")).select("t.*").where("number is not null")


def free_names(df: DataFrame, target: str, order: str, taken: DataFrame | None = None) -> DataFrame:
    """df with `dest`: the target itself for the first row that wants it, then name_1.ext, name_2.ext, ...

    taken: path, the names that aren't free. With it, each row gets the next free number of its target; a name that another
    row wants as it is isn't free either. The r-th free number is the place of r among the rows and, of each taken number,
    what it is less the taken ones before it."""
    if taken is None:
        out = ranked(df, target, order)
    else:
        wanted = df.select(F.col(target).alias("target")).distinct()
        here = _taken_numbers(taken.select("path"), "path").unionByName(_taken_numbers(wanted, "target").where("number > 0"))
        here = ranked(here.join(wanted, "target", "left_semi").distinct(), "target", "number")
        marks = here.select("target", (F.col("number") - F.col("_at")).alias("_v"), F.lit(0).alias("_kind"), F.lit(None).cast(df.schema).alias("_row"))
        rows = ranked(df, target, order)
        rows = rows.select(F.col(target).alias("target"), F.col("_at").cast("long").alias("_v"), F.lit(1).alias("_kind"), F.struct(*df.columns).alias("_row"))
        out = ranked(rows.unionByName(marks), "target", "_v", "_kind").where("_kind = 1").select("_row.*", "_at")
    numbered = F.concat(F.regexp_replace(target, r"(\.[^./]*)$", ""), F.lit("_"), F.col("_at").cast("string"), F.regexp_extract(target, r"(\.[^./]*)$", 1))
    return out.withColumn("dest", F.when(F.col("_at") == 0, F.col(target)).otherwise(numbered)).drop("_at")


def copy_plan(source: DataFrame, present: DataFrame, key: str, order: str) -> DataFrame:
    """The rows of source whose key isn't present, one for each key."""
    new = source.join(present.select(key).distinct(), key, "left_anti")
    return first_seen(new, F.col(key), order).where("status = 'unique'").drop("status", "first_seen", "dup_key")


def flatten_plan(df: DataFrame, path: str) -> DataFrame:
    """Where each file goes when it moves to its folder's parent as <folder>_<file>; files in the root stay."""
    moved = F.regexp_replace(path, r"^(.*/)?([^/]+)/([^/]+)$", "$1$2_$3")
    return df.withColumn("dest", moved).where(F.col("dest") != F.col(path))


def one_per_dest(plan: DataFrame, order: str, last: bool = False) -> DataFrame:
    """One row for each dest: the first, or the last, in the order given."""
    best = (F.max_by if last else F.min_by)(F.struct(*plan.columns), order).alias("_row")
    return plan.groupBy("dest").agg(best).select("_row.*")


def chunk_ids(df: DataFrame, order: str, size: int) -> DataFrame:
    """df with `chunk`: size rows each in the order given. Ranks come from range partitions and their sizes, not from one task."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = staged(df.repartitionByRange(n, order).withColumn("part", F.spark_partition_id()))
    sizes = {r["part"]: r["count"] for r in ranged.groupBy("part").count().collect()}
    at, rows = 0, []
    for p in sorted(sizes):
        rows.append((p, at))
        at += sizes[p]
    before = spark.createDataFrame(rows, "part int, before long")
    w = Window.partitionBy("part").orderBy(order)
    out = ranged.join(F.broadcast(before), "part").withColumn("chunk", F.floor((F.col("before") + F.row_number().over(w) - 1) / size).cast("long"))
    return out.drop("part", "before")
