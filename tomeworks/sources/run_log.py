"""The log of pipeline runs: a Parquet table by run date, appended to, with JSON columns parsed once on reading."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import author_list

#: The columns of a run and the fields of its result.
RUN = "pdf_name string, pdf_hash string, pipeline_config string, result string, run_timestamp timestamp"
RESULT = "title string, subtitle string, publisher string, subject string, keywords array<string>, isbn_identifiers array<string>, description string"


def append_runs(runs: DataFrame, path: str) -> bool:
    """Append runs; a failure is logged and reported, never raised."""
    try:
        runs.withColumn("run_date", F.to_date("run_timestamp")).write.mode("append").partitionBy("run_date").parquet(path)
        return True
    except Exception:
        logging.getLogger(__name__).exception("runs were not written to %s", path)
        return False


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """All runs; columns that older files lack are null, and a log that isn't there yet has none."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], RUN + ", run_date date")
    return spark.read.schema(RUN + ", run_date date").option("mergeSchema", True).parquet(path)


def parsed(runs: DataFrame) -> DataFrame:
    """Runs with all result fields as columns, author as a list and keywords as a sorted set."""
    r = F.from_json("result", RESULT)
    out = runs.withColumns({"_r": r, "author": author_list(F.col("result"))}).select(*runs.columns, "author", "_r.*")
    return out.withColumn("keywords", F.array_sort(F.array_distinct(F.coalesce("keywords", F.array().cast("array<string>")))))


def latest(runs: DataFrame, key: str, order: str) -> DataFrame:
    """The last run of each key. The aggregation combines before the shuffle, whatever the number of runs of a key."""
    rest = [c for c in runs.columns if c != key]
    best = runs.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_b"))
    return best.select(key, "_b.*")
