"""Tables of values by key that grow by appending: the last value of a key counts, and a look-up reads the buckets of its keys only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .staging import staged

BUCKETS = 64


def bucket(key: Column) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(BUCKETS)).cast("int")


def exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def append(rows: DataFrame, path: str, key: str) -> None:
    """Add values. What a repeated batch adds once more has the same order, so it changes nothing."""
    rows.withColumn("bucket", bucket(F.col(key))).repartition("bucket").write.mode("append").partitionBy("bucket").parquet(path)


def latest(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The row of greatest order of each key; of equal orders the greatest row, so that the choice is the same every time."""
    rest = [c for c in rows.columns if c not in (key, order)]
    return rows.groupBy(key).agg(F.max(F.struct(order, *rest)).alias("_row")).select(key, "_row.*").select(*rows.columns)


def lookup(keys: DataFrame, path: str, key: str, order: str, schema: str) -> DataFrame:
    """The latest values of the keys that the table holds. schema: the table's columns, key and order among them."""
    spark = keys.sparkSession
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    wanted = staged(keys.select(key).distinct())
    some = [r[0] for r in wanted.select(bucket(F.col(key)).alias("bucket")).distinct().collect()]  # BUCKETS at most
    rows = spark.read.schema(f"{schema}, bucket int").parquet(path).where(F.col("bucket").isin(some)).drop("bucket")
    return latest(rows.join(wanted, key, "left_semi"), key, order)
