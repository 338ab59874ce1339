"""Connected components by alternating large-star and small-star rounds on DataFrames.

Each half round is one minimum per node (partial aggregation takes the hot nodes) and one join whose two sides are
plain shuffles, which AQE splits where a node has many links. Every round is written to the shared folder, and replaces the one before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import discard, stash


def _mark(e: DataFrame) -> tuple:
    r = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable, for each node that has a link to another one.

    Null ends and self links are ignored, repeated links count once; no edges give no rows."""
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(f"{a} is not null and {b} is not null and {a} <> {b}").distinct()
    e = stash(e)
    mark = _mark(e)
    for _ in range(rounds):
        if not mark[0]:
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stash(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = stash(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = stash(large.groupBy("u").agg(F.min("v").alias("m")))
        # small star: the smaller neighbours of u, and u itself, go to the smallest of them
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = stash(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        discard(e, low, large, least)
        e, old, mark = new, mark, _mark(new)
        if old == mark:
            break
    else:
        raise RuntimeError("components did not converge")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
