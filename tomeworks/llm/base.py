"""What the operators of this folder share: intermediate tables, Arrow text access, bounded broadcasts."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir. Where none is named, a temporary one, on a local master only:
    elsewhere other machines would not see its files."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _LOCAL:
        _LOCAL.append("file://" + tempfile.mkdtemp(prefix="tomeworks-"))
        atexit.register(shutil.rmtree, _LOCAL[0].removeprefix("file://"), ignore_errors=True)
    return _LOCAL[0]


def stash(df: DataFrame, codec: str = "lz4_raw") -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/stash-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stash = path
    return out


def discard(*stashed: DataFrame) -> None:
    """Delete what stash wrote, once nothing reads it any more."""
    for df in stashed:
        spark, path = df.sparkSession, df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(df._stash)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Bytes of text for which a hash order has a fragment, and fragments at most (about as many as a shuffle can have partitions).
FRAGMENT_BYTES, FRAGMENTS = 1 << 22, 1 << 18


def fragments(texts: DataFrame, text_col: str = "text") -> int:
    """How many fragments a hash order is cut into: a power of two that grows with the bytes of the texts and with the
    shuffle partitions."""
    size = texts.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    n, want = 256, min(FRAGMENTS, max(partitions(texts.sparkSession), size // FRAGMENT_BYTES))
    while n < want:
        n *= 2
    return n


def free_name(df: DataFrame, name: str) -> str:
    """The name, behind as many underscores as it takes to clash with no column of df."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n + 1) of an Arrow string column without copying; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_null(column.type):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offs


def doc_slices(offs: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Runs of rows whose text has about `limit` bytes; a longer text is a run of its own."""
    n, i = len(offs) - 1, 0
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def blob(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a).tobytes()
