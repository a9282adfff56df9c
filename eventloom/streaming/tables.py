"""Micro-batches into stored tables, written so that a retried batch changes nothing."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions.scalar import interval
from eventloom.operators import metrics
from eventloom.operators.decode import decode_events
from eventloom.operators.dedup import first_delivery
from eventloom.operators.validate import accepted, dead_letters
from eventloom.sources.files import spread
from eventloom.sources.idindex import IdIndex
from eventloom.sources.logtable import LogTable, State, stream_of
from eventloom.streaming.runs import batch_folder, path_exists, write_batch

#: When the stream that wrote a change began, in nanoseconds.
STARTED = "run_started"


def append_once(df: DataFrame, batch_id: int, path: str, ts: str = "ts") -> DataFrame:
    """Store the events of a batch that no other batch stored; returns the new ones.

    Ids are searched in the index of all stored batches, of whatever day or stream: a redelivered event may
    carry another time. The stored events themselves are not read. The batch's own entries
    are left out of the search and replaced, which makes a retry harmless.
    """
    spark = df.sparkSession
    index = IdIndex(spark, f"{path}_ids")
    fresh = index.without_stored(first_delivery(df, ts=ts), batch_id).withColumn("event_date", F.to_date(ts))
    write_batch(fresh.hint("rebalance", F.col("event_date")), path, batch_id, "event_date")
    stored = spark.read.schema(fresh.schema).parquet(batch_folder(spark, path, batch_id))
    index.add(stored, batch_id)
    return stored


def upsert_users(events_path: str, users_path: str, least: int = 8) -> Callable[[DataFrame, int], None]:
    """Batch handler: append new events, and add their per-user sums to the users table.

    The users table is one merged folder and the sums of the latest batches, see ``read_users``. After
    ``least`` batches the handler merges them; readers see the table before or after that.
    """

    def handle(df: DataFrame, batch_id: int) -> None:
        arrived = df.persist()
        try:
            if arrived.isEmpty():
                return
            new = append_once(arrived, batch_id, events_path)
        finally:
            arrived.unpersist()
        table = LogTable(df.sparkSession, users_path)
        folder = table.new_folder()
        metrics.user_partials(new).write.parquet(folder)
        table.put(batch_id, {"folder": folder})
        compact_users(df.sparkSession, users_path, least)

    return handle


def users_schema(spark: SparkSession, entries: list[dict]):
    return spark.read.parquet(entries[0]["folder"]).schema


def read_users(spark: SparkSession, users_path: str) -> DataFrame:
    """The users table as of its newest manifest."""
    table = LogTable(spark, users_path)
    entries = table.state().entries
    if not entries:
        raise ValueError(f"no users are stored under {users_path}")
    return metrics.users_of(metrics.merged_partials(table.read(users_schema(spark, entries), entries)))


def compact_users(spark: SparkSession, users_path: str, least: int = 1) -> bool:
    """Merge the sums of all batches but the newest of each stream into one folder; totals stay as they are.

    Safe while a stream writes: what it adds meanwhile is kept beside the merged folder, and a failure
    leaves the table as it was.
    """
    table = LogTable(spark, users_path)

    def merge(entries: list[dict]) -> dict:
        folder = table.new_folder()
        metrics.merged_partials(table.read(users_schema(spark, entries), entries)).write.parquet(folder)
        return {"folder": folder}

    return table.compact(merge, least)


def keep_changes(path: str) -> Callable[[DataFrame, int], None]:
    """Batch handler for update-mode results: the changed rows of each batch.

    Batch ids start anew under another checkpoint, so each row also says when its stream first wrote here. All batches
    of a stream share that time, which is kept in a table of its own.
    """

    def handle(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        table = LogTable(spark, f"{path}_runs")
        key = f"{stream_of(spark)}/0"
        first = {"started": time.time_ns()}
        state = table.state()
        if key not in state.batches:
            state = table.commit(lambda s: State({key: first} | s.batches, s.merged))
        started = F.lit(state.batches[key]["started"]).cast("long")
        write_batch(df.withColumn(STARTED, started), path, batch_id)

    return handle


def latest_changes(spark: SparkSession, path: str, *keys: str) -> DataFrame:
    """Newest row per key out of the changes of all batches, later runs after earlier ones."""
    changes = spark.read.parquet(path)
    rest = [c for c in changes.columns if c not in (*keys, "batch_id", "run_id", STARTED)]
    newest = changes.groupBy(*keys).agg(F.max(F.struct(STARTED, "run_id", "batch_id", *rest)).alias("_row"))
    return newest.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def split_rejected(valid_path: str, dead_path: str, received: str) -> Callable[[DataFrame, int], None]:
    """Batch handler for raw messages: accepted events to one table, dead letters to the other.

    ``received`` names the column with the arrival time of a message.
    """

    def handle(messages: DataFrame, batch_id: int) -> None:
        arrived = F.col(received)
        checked = decode_events(spread(messages), received_at=arrived, keep=(received,)).persist()
        try:
            write_batch(accepted(checked), valid_path, batch_id)
            write_batch(dead_letters(checked, F.col("raw"), arrived), dead_path, batch_id)
        finally:
            checked.unpersist()

    return handle


def split_late(path: str, delay: str, ts: str = "ts") -> Callable[[DataFrame, int], None]:
    """Batch handler that accounts for late rows one by one.

    A row is late when it is older than the newest time of earlier batches minus
    ``delay``. Rows go to ``on_time`` or ``late`` under ``path``; ``newest`` keeps the newest
    time seen up to each batch, one row per batch.
    """

    def handle(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        before = None
        last = batch_folder(spark, f"{path}/newest", batch_id - 1)
        if batch_id > 0 and path_exists(spark, last):
            before = spark.read.parquet(last).first().newest
        newest = df.agg(F.max(ts).alias("newest"))
        if before is not None:
            newest = newest.select(F.greatest("newest", F.lit(before)).alias("newest"))
        # A row without a time is on time: nothing says that it is late.
        is_late = F.lit(False) if before is None else F.coalesce(F.col(ts) < F.lit(before) - interval(delay), F.lit(False))
        write_batch(df.where(~is_late), f"{path}/on_time", batch_id)
        write_batch(df.where(is_late), f"{path}/late", batch_id)
        write_batch(newest, f"{path}/newest", batch_id)

    return handle
