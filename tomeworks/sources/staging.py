"""Intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: list[str] = []


def local_dir(spark: SparkSession) -> str:
    """A temporary folder, which ends with the process; on a local master only, since other machines would not see its files."""
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _LOCAL:
        _LOCAL.append("file://" + tempfile.mkdtemp(prefix="tomeworks-"))
        atexit.register(shutil.rmtree, _LOCAL[0].removeprefix("file://"), ignore_errors=True)
    return _LOCAL[0]


def staged(df: DataFrame) -> DataFrame:
    """Write df below spark.checkpoint.dir (a temporary folder where none is set, as in tests) and read it back."""
    root = df.sparkSession.sparkContext.getConf().get("spark.checkpoint.dir", None)
    path = f"{root or local_dir(df.sparkSession)}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged = path
    return out


def unstaged(df: DataFrame) -> None:
    """Delete what staged wrote, once nothing reads it any more."""
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df._staged)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
