"""Topics as sources and sinks. Needs Spark's Kafka connector on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from eventloom import schema

# Delivery settings of the event producer.
DELIVERY = {
    "kafka.acks": "all",
    "kafka.retries": "3",
    "kafka.compression.type": "snappy",
    "kafka.max.request.size": str(schema.MAX_MESSAGE_BYTES),
}


def read_options(servers: str, topic: str, group: str | None = None, per_trigger: int | None = None) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest"}
    if group:
        options["kafka.group.id"] = group
    if per_trigger:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return options


def write_options(servers: str, topic: str | None = None) -> dict[str, str]:
    """Writer options; without ``topic`` the rows must carry a ``topic`` column."""
    options = {"kafka.bootstrap.servers": servers, **DELIVERY}
    if topic:
        options["topic"] = topic
    return options


def stream_topic(spark: SparkSession, servers: str, topic: str = schema.TOPIC_EVENTS, **limits) -> DataFrame:
    """Messages of a topic from the earliest offset: ``value`` text and broker time."""
    raw = spark.readStream.format("kafka").options(**read_options(servers, topic, **limits)).load()
    return raw.select(F.col("value").cast("string").alias("value"), F.col("timestamp").alias("received_at"))


def read_topic(spark: SparkSession, servers: str, topic: str = schema.TOPIC_EVENTS) -> DataFrame:
    raw = spark.read.format("kafka").options(**read_options(servers, topic)).load()
    return raw.select(F.col("value").cast("string").alias("value"), F.col("timestamp").alias("received_at"))


def peek(messages: DataFrame, count: int = 5) -> DataFrame:
    return messages.limit(count)


def write_topic(messages: DataFrame, servers: str, topic: str = schema.TOPIC_EVENTS) -> None:
    """Publish ``value`` rows; no key, as ordering comes from event time."""
    messages.select("value").write.format("kafka").options(**write_options(servers, topic)).save()


def stream_to_topics(routed: DataFrame, servers: str, checkpoint: str) -> DataStreamWriter:
    """Publish rows with (topic, value), each to its own topic."""
    writer = routed.select("topic", "value").writeStream.format("kafka").options(**write_options(servers))
    return writer.option("checkpointLocation", checkpoint)
