"""Starting streams: state settings, bounded and unbounded runs, retry-safe folders."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from eventloom.sources.logtable import stream_of

# State lives in RocksDB, outside the heap; sessions of a batch are merged on the map
# side, so that a hot user's rows are combined before they are shuffled.
STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


@contextmanager
def stream_settings(spark: SparkSession, state_partitions: int | None = None) -> Iterator[None]:
    """Settings for streams started inside the block; a stream keeps those it began with.

    ``state_partitions`` is fixed for the life of a checkpoint, as AQE does not resize
    stateful shuffles; without it the session's number of shuffle partitions holds.
    """
    wanted = dict(STREAM_SETTINGS)
    if state_partitions is not None:
        wanted["spark.sql.shuffle.partitions"] = str(state_partitions)
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def event_time(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Event times as instants, which watermarks need."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def append_files(df: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    return df.writeStream.format("parquet").outputMode("append").option("path", path).option(
        "checkpointLocation", checkpoint
    )


def per_batch(
    df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> DataStreamWriter:
    return df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(handle)


def run_available(writer: DataStreamWriter, state_partitions: int | None = None) -> StreamingQuery:
    """Bounded run: all input present at the start, in as many batches as the source sets."""
    with stream_settings(writer._spark, state_partitions):
        query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def watermark_of(query: StreamingQuery) -> str | None:
    """Watermark of the last batch, as ISO text; None if the stream has none or saw no event."""
    reported = [p["eventTime"]["watermark"] for p in query.recentProgress if "watermark" in (p["eventTime"] or {})]
    return reported[-1] if reported else None


def run_for(
    writer: DataStreamWriter, every: str, seconds: float | None = None, state_partitions: int | None = None
) -> StreamingQuery:
    """Unbounded run with a batch ``every`` interval; stopped after ``seconds`` if given."""
    with stream_settings(writer._spark, state_partitions):
        query = writer.trigger(processingTime=every).start()
    if seconds is not None:
        if not query.awaitTermination(seconds):
            query.stop()
    return query


def run_until_idle(
    writer: DataStreamWriter, every: str, seconds: float, state_partitions: int | None = None
) -> StreamingQuery:
    """Unbounded run, stopped when a look at the source finds nothing new, or after ``seconds``."""
    deadline = time.monotonic() + seconds
    with stream_settings(writer._spark, state_partitions):
        query = writer.trigger(processingTime=every).start()
    try:
        while query.isActive and time.monotonic() < deadline:
            waiting = query.status["isDataAvailable"] or query.status["isTriggerActive"]
            if query.lastProgress is not None and not waiting:
                break
            if query.awaitTermination(0.1):
                break
    finally:
        query.stop()
    return query


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def batch_folder(spark: SparkSession, path: str, batch_id: int) -> str:
    """Folder of one micro-batch of one stream.

    Batch ids start at 0 again under a new checkpoint, so the folder also names the stream: its
    query id lives as long as its checkpoint. Outside a stream the name is fixed.
    """
    return f"{path}/run_id={stream_of(spark)}/batch_id={batch_id}"


def write_batch(df: DataFrame, path: str, batch_id: int, *partitions: str) -> None:
    """Write one micro-batch into its own folder; a retried batch replaces it."""
    writer = df.write.mode("overwrite")
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.parquet(batch_folder(df.sparkSession, path, batch_id))
