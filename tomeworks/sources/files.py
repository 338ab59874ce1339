"""Binary files: discovery, identity, and the plans' execution."""

from __future__ import annotations

import glob
import os
import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import actions


def expand_paths(patterns: list[str]) -> list[str]:
    """Globs and ~ expanded; a pattern without a match is warned about, plain paths and URIs pass through."""
    out: list[str] = []
    for p in patterns:
        p = os.path.expanduser(p)
        if any(c in p for c in "*?[") and "://" not in p:
            found = sorted(glob.glob(p, recursive=True))
            if not found:
                warnings.warn(f"nothing matches {p}", stacklevel=2)
            out += found
        else:
            out.append(p)
    return out


def discover(spark: SparkSession, roots: str | list[str], pattern: str = "*.pdf", case_insensitive: bool = False) -> DataFrame:
    """path, modificationTime, length, content of all matching files below the roots, of which each must be a directory."""
    roots = [roots] if isinstance(roots, str) else roots
    for r in roots:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(r)
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(path) or not fs.getFileStatus(path).isDirectory():
            raise RuntimeError(f"not a directory: {r}")
    if case_insensitive:
        pattern = "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in pattern)
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(roots)


def count_files(spark: SparkSession, root: str, pattern: str = "*.pdf") -> int:
    return discover(spark, root, pattern).select("path").count()


def with_hash(files: DataFrame) -> DataFrame:
    """files with content_hash; the content itself goes."""
    return files.withColumn("content_hash", F.sha2("content", 256)).drop("content")


def looks_valid(content: Column) -> Column:
    """The fallback check of a PDF: its header, and its end mark in the last kilobyte."""
    n = F.length(content)
    tail = F.substring(content, F.greatest(n - 1023, F.lit(1)), F.lit(1024))
    return (F.substring(content, 1, 5) == F.lit(b"%PDF-")) & F.contains(tail, F.lit(b"%%EOF"))


def remove_files(plan: DataFrame, path: str = "path", dry_run: bool = False) -> DataFrame:
    """path, status of each file; one that is gone already is done."""

    def run(batches):
        for pdf in batches:
            status = []
            for p in pdf[path]:
                try:
                    if not dry_run:
                        os.remove(p.removeprefix("file:"))
                    status.append("planned" if dry_run else "done")
                except FileNotFoundError:
                    status.append("done")
                except OSError as e:
                    status.append(f"failed: {e}")
            yield pdf[[path]].assign(status=status)

    return plan.select(path).mapInPandas(run, f"{path} string, status string")


def move_files(plan: DataFrame, source: str = "path", dest: str = "dest", copy: bool = False, dry_run: bool = False, overwrite: bool = False) -> DataFrame:
    """source, dest, status of each planned move: done, planned, exists, or failed with the reason; see actions.perform."""
    if dry_run:
        return plan.select(source, dest, F.lit("planned").alias("status"))
    return actions.perform(plan, source, dest, copy, overwrite)
