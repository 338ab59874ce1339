"""Streams: a folder of files, and events in windows."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..sources import keyed


def listen_folder(spark: SparkSession, root: str, pattern: str = "*.pdf", delay: str = "1 day") -> DataFrame:
    """path, modificationTime, content_hash of new files, one for each content within the delay."""
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    rows = files.select("path", "modificationTime", F.sha2("content", 256).alias("content_hash"))
    return rows.withWatermark("modificationTime", delay).dropDuplicatesWithinWatermark(["content_hash"])


def distinct_events(events: DataFrame, key: str = "event_id", delay: str = "1 hour") -> DataFrame:
    return events.withWatermark("ts", delay).dropDuplicatesWithinWatermark([key])


def latest_rows(stream: DataFrame, key: str, order: str, kept: timedelta = timedelta(days=7)) -> DataFrame:
    """The rows of a stream that are later, by the timestamp `order`, than all of their key before; late and repeated ones, and those without a key or
    order, are left out. A key's state goes when nothing of it was seen for the time given; the table behind (see keep_latest) still decides rightly."""
    kind, wait = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema.fields), int(kept.total_seconds() * 1000)

    def step(_, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        best = None
        for pdf in frames:
            top = pdf.sort_values([order, *(c for c in pdf.columns if c != order)]).iloc[[-1]]
            if best is None or top[order].iloc[0] > best[order].iloc[0]:
                best = top
        if best is not None:
            at = best[order].iloc[0].to_pydatetime()
            later = not state.exists or at > state.get[0]
            if later:
                state.update((at,))
            state.setTimeoutDuration(wait)
            if later:
                yield best

    rows = stream.where(F.col(key).isNotNull() & F.col(order).isNotNull())
    return rows.groupBy(key).applyInPandasWithState(step, kind, "at timestamp", "update", GroupStateTimeout.ProcessingTimeTimeout)


def keep_latest(stream: DataFrame, path: str, checkpoint: str, key: str, order: str, kept: timedelta = timedelta(days=7)) -> None:
    """Process what is there, so that the table at `path` (see sources.keyed) holds the latest row of each key, and stop. A batch that is repeated after a fault changes nothing."""
    writer = latest_rows(stream, key, order, kept).writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    # timeouts by the clock would make batches without data for ever; the query keeps the setting that it was started with
    conf, name = stream.sparkSession.conf, "spark.sql.streaming.noDataMicroBatches.enabled"
    before = conf.get(name)
    conf.set(name, "false")
    try:
        q = writer.foreachBatch(lambda batch, _: keyed.append(batch, path, key)).start()
    finally:
        conf.set(name, before)
    q.awaitTermination()


def window_counts(events: DataFrame, size: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """window_start, event_type, n, total: tumbling windows, given out once the watermark has passed them."""
    w = F.window("ts", size)
    return events.withWatermark("ts", delay).groupBy(w, "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("window_start"), "event_type", "n", "total")


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Process what is there, write it as Parquet, and stop."""
    q = stream.writeStream.outputMode(mode).format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def table_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table as a stream, whether it is one file of the folder or a folder of its own."""
    path = f"{folder}/{name}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema).format("parquet")
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory():
        return reader.load(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").load(folder)
