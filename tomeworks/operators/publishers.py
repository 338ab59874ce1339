"""Publishers: fuzzy matches, greedy groups and canonical names."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import indel_ratio, normalize_publisher
from ..sources.staging import staged


def publisher_names(df: DataFrame, column: str, order: str) -> DataFrame:
    """name, norm, pos: distinct names that aren't blank, with the order of their first appearance."""
    rows = df.where(F.trim(column) != "").groupBy(F.col(column).alias("name")).agg(F.min(order).alias("pos"))
    return rows.select("name", normalize_publisher(F.col("name")).alias("norm"), "pos")


def fuzzy_pairs(names: DataFrame, threshold: float = 75.0) -> DataFrame:
    """a, b, ratio of distinct normalised names that match: ratio of at least the threshold, or one begins with the other.

    Instead of comparing all with all, names meet over keys that every match shares: prefix matches by the shorter name, others
    by pairs of their rarest letters within a band of lengths, where the shorter has at least t / (200 - t) of the longer one's."""
    norms = names.select("norm").distinct().where("norm <> ''")
    a, b = norms.select(F.col("norm").alias("a")), norms.select(F.col("norm").alias("b"))
    # prefix branch: a is one of the prefixes of b
    cut = b.withColumn("a", F.explode(F.expr("transform(sequence(1, length(b)), n -> substring(b, 1, n))")))
    prefix = cut.join(a, "a").where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    # ratio branch: a match shares 0.6 (at 75 percent) of the letters of either name, counted with repeats. The k-th rarest of
    # the shared ones is among the first n - ceil(0.6 n) + k of either, so both hold the same k of those. With a share above a
    # half every name of two letters shares two; one of one letter matches none but itself.
    share = threshold / (200.0 - threshold)
    k = 2 if share > 0.5 else 1
    letters = F.expr("transform(sequence(1, length(norm)), i -> concat(substring(norm, i, 1), size(filter(sequence(1, i), j -> substring(norm, j, 1) = substring(norm, i, 1)))))")
    keyed = norms.select("norm", F.explode(letters).alias("c"))
    ranked = keyed.join(keyed.groupBy("c").agg(F.count("*").alias("df")), "c")
    grouped = ranked.groupBy("norm").agg(F.transform(F.array_sort(F.collect_list(F.struct("df", "c"))), lambda s: s["c"]).alias("cs"))
    first = F.slice("cs", 1, F.length("norm") - F.ceil(F.lit(share) * F.length("norm") - 1e-9).cast("int") + k)
    if k == 2:
        first = F.flatten(F.transform(first, lambda c, i: F.transform(F.slice(first, i + 2, F.size("cs")), lambda d: F.concat(c, F.lit("\t"), d))))
    band = F.floor(F.log(F.length("norm")) / F.log(F.lit(1 / share)) + 1e-9) if share < 1 else F.length("norm")
    keys = staged(grouped.select("norm", "cs", band.alias("band"), F.explode(first).alias("key")))
    left = keys.select(F.col("norm").alias("a"), F.col("cs").alias("ca"), "key", "band")
    right = keys.select(F.col("norm").alias("b"), F.col("cs").alias("cb"), "key", F.explode(F.array(*(F.col("band") + d for d in (-1, 0, 1)))).alias("band"))
    both = F.length("a") + F.length("b")
    near = (F.col("a") < F.col("b")) & (F.least(F.length("a"), F.length("b")) >= F.lit(share) * F.greatest(F.length("a"), F.length("b")))
    common = F.size(F.array_intersect("ca", "cb")) >= F.lit(threshold / 200) * both - 1e-9
    pairs = left.join(right, ["key", "band"]).where(near & common).select("a", "b").distinct()
    ratio = pairs.withColumn("ratio", indel_ratio(F.col("a"), F.col("b"))).where(F.col("ratio") >= threshold)
    begun = prefix.distinct().withColumn("ratio", indel_ratio(F.col("a"), F.col("b")))
    return ratio.unionByName(begun).dropDuplicates(["a", "b"]).withColumn("ratio", F.round("ratio", 4))


#: Matches between undecided names that one task decides at the end.
LAST = 100_000


def _out(edges: DataFrame) -> DataFrame:
    """norm of the names that an earlier one takes, from all matches (early, late) between undecided names, at most LAST."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out: set[str] = set()
        for early, late in zip(pdf["early"], pdf["late"], strict=True):  # in the order of the earlier name
            if early not in out:
                out.add(late)
        return pd.DataFrame({"norm": sorted(out)}, dtype=object)

    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(batches)
        if parts:
            yield run(pd.concat(parts).sort_values(["early_pos", "early"], kind="stable"))

    return edges.coalesce(1).mapInPandas(decide, "norm string")


def greedy_groups(names: DataFrame, pairs: DataFrame) -> DataFrame:
    """name, norm, pos, seed: in order of appearance, a name that has no group yet founds one and takes all later ones that match it.

    Founders are the first maximal independent set of the match graph in that order, found in rounds: a name that no
    earlier undecided one matches founds a group, and what matches it is decided with it. A round is a few joins over the matches between
    undecided names, whose number falls from round to round; once they are LAST or fewer, one task decides the rest in order,
    since a chain of names would take as many rounds as it is long. Then each name that isn't a founder goes to the first founder that matches it."""
    order = names.groupBy("norm").agg(F.min("pos").alias("pos"))
    a, b = order.select(F.col("norm").alias("a"), F.col("pos").alias("pa")), order.select(F.col("norm").alias("b"), F.col("pos").alias("pb"))
    first = F.struct("pa", "a") < F.struct("pb", "b")
    early, late = F.when(first, F.struct("a", "pa")).otherwise(F.struct(F.col("b").alias("a"), F.col("pb").alias("pa"))), F.when(first, F.col("b")).otherwise(F.col("a"))
    matches = staged(pairs.select("a", "b").where("a <> b").distinct().join(a, "a").join(b, "b").select(early["a"].alias("early"), early["pa"].alias("early_pos"), late.alias("late")).distinct())
    left, out = matches, []
    while (n := left.count()) > LAST:
        founders = left.select(F.col("early").alias("norm")).distinct().join(left.select(F.col("late").alias("norm")).distinct(), "norm", "left_anti")
        gone = staged(left.join(founders.withColumnRenamed("norm", "early"), "early", "left_semi").select(F.col("late").alias("norm")).distinct())
        out.append(gone)
        left = staged(left.join(gone.withColumnRenamed("norm", "early"), "early", "left_anti").join(gone.withColumnRenamed("norm", "late"), "late", "left_anti"))
    if n:
        out.append(staged(_out(left)))
    if not out:
        return names.select("name", "norm", "pos", F.col("norm").alias("seed"))
    taken = staged(reduce(DataFrame.unionByName, out).distinct())
    founded = matches.join(taken.withColumnRenamed("norm", "early"), "early", "left_anti")
    seeds = founded.groupBy("late").agg(F.min(F.struct("early_pos", "early"))["early"].alias("seed")).withColumnRenamed("late", "norm")
    return names.join(seeds, "norm", "left").select("name", "norm", "pos", F.coalesce("seed", "norm").alias("seed"))


def canonical_names(groups: DataFrame) -> DataFrame:
    """name, canonical: the shortest, then first name of each group."""
    best = groups.groupBy("seed").agg(F.min_by("name", F.struct(F.length("name"), F.col("name"))).alias("canonical"))
    return groups.join(best, "seed").select("name", "canonical")
