"""Stored tables: events by day, dead letters, daily statistics, topic folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from eventloom import schema
from eventloom.functions.scalar import money
from eventloom.operators.encode import event_json
from eventloom.sources.logtable import LogTable


def stored_layout(df: DataFrame, created_at: Column) -> DataFrame:
    """Validated wide events in the layout of the events table."""
    columns = {
        "value": money(F.col("value")),
        "data": event_json(df),
        "created_at": created_at,
    }
    names = [c.split()[0] for c in schema.STORED_EVENT_COLUMNS.split(", ")]
    return df.select(*[columns.get(n, F.col(n)).alias(n) for n in names])


#: Column that names the delivery a stored event came with.
DELIVERY = "delivery"


def append_events(df: DataFrame, path: str, ts: str = "timestamp", delivery: str = "first") -> None:
    """Store the events of a delivery, in a folder per day and delivery.

    A delivery that is written again replaces itself, day by day; others stay untouched. Ids are not compared between
    deliveries, see ``streaming.tables.append_once`` for that.

    The rebalance hint lets AQE split a busy day over many writers and merge quiet
    days, so no task gets a whole hot day and no day gets a file per task.
    """
    dated = df.withColumns({"event_date": F.to_date(ts), DELIVERY: F.lit(delivery)}).hint("rebalance", F.col("event_date"))
    writer = dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("event_date", DELIVERY).parquet(path)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def append_dead_letters(letters: DataFrame, path: str, batch_id: int) -> None:
    """Store the dead letters of a batch with one commit; a repeated batch replaces its own. Usable as
    handler of a stream."""
    table = LogTable(letters.sparkSession, path)
    folder = table.new_folder()
    letters.write.parquet(folder)
    table.put(batch_id, {"folder": folder})


def read_dead_letters(spark: SparkSession, path: str) -> DataFrame:
    """The dead letters of all committed batches."""
    rows = LogTable(spark, path).read(schema.DEAD_LETTER_COLUMNS)
    return rows if rows is not None else spark.createDataFrame([], schema.DEAD_LETTER_COLUMNS)


def write_daily_stats(stats: DataFrame, path: str) -> None:
    """Replace the days present in ``stats``; other days stay untouched."""
    (
        stats.hint("rebalance", F.col("day"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day")
        .parquet(path)
    )


def write_counted(df: DataFrame, path: str, name: str = "accepted") -> Observation:
    """Write rows and count them on the way, without a second pass.

    ``Observation.get`` holds ``rows`` once the write is done.
    """
    seen = Observation(name)
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(path)
    return seen


def route(df: DataFrame, is_anomaly: Column, is_valid: Column) -> DataFrame:
    """Add the ``topic`` each event goes to."""
    topic = (
        F.when(~is_valid, schema.TOPIC_EVENTS)
        .when(is_anomaly, schema.TOPIC_ANOMALIES)
        .otherwise(schema.TOPIC_ANALYTICS)
    )
    return df.withColumn("topic", topic)


#: Where messages go that a topic does not take.
FAILED = "failed-events"


def outgoing(routed: DataFrame, message: Column, limit: int = schema.MAX_MESSAGE_BYTES) -> DataFrame:
    """(topic, value): routed rows as messages; those above the byte limit go to the failed ones instead."""
    sized = routed.select("topic", message.alias("value"))
    fits = F.coalesce(F.octet_length("value"), F.lit(0)) <= limit
    return sized.withColumn("topic", F.when(fits, F.col("topic")).otherwise(FAILED))


def write_topics(messages: DataFrame, path: str, batch_id: int) -> None:
    """Write a batch of (topic, value) to all its topics in one pass and with one commit.

    All topics of a batch appear together or not at all, and a repeated batch replaces itself. Usable as handler of a stream
    through ``functools.partial``; see ``kafka.stream_to_topics`` for topics of a broker.
    """
    table = LogTable(messages.sparkSession, path)
    folder = table.new_folder()
    messages.hint("rebalance", F.col("topic")).write.partitionBy("topic").parquet(folder)
    table.put(batch_id, {"folder": folder})


def read_topics(spark: SparkSession, path: str) -> DataFrame:
    """(value, topic) of all committed batches; a filter on the topic prunes folders."""
    rows = LogTable(spark, path).read("value string, topic string")
    return rows if rows is not None else spark.createDataFrame([], "value string, topic string")


def drop_expired(spark: SparkSession, path: str, first_kept_day: str) -> list[str]:
    """Remove day folders older than ``first_kept_day`` (ISO date); returns their names."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    expired = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith("event_date=") and name.removeprefix("event_date=") < first_kept_day:
            fs.delete(status.getPath(), True)
            expired.append(name)
    return expired


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each table: (table_name, rows)."""
    counts = [df.agg(F.lit(name).alias("table_name"), F.count("*").alias("rows")) for name, df in tables.items()]
    whole = counts[0]
    for part in counts[1:]:
        whole = whole.unionAll(part)
    return whole
