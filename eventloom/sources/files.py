"""File sources: stored Parquet tables and folders of JSON messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stream_table(spark: SparkSession, folder: str, name: str, files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files ``{name}*.parquet`` of a folder as a stream, oldest first."""
    pattern = f"{folder}/{name}*.parquet"
    reader = spark.readStream.schema(spark.read.parquet(pattern).schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(pattern)


def spread(df: DataFrame) -> DataFrame:
    """Rows of a scan dealt out over all cores when it has too few splits for them.

    Meant for few or unsplittable files ahead of costly work on each row. A scan with
    at least one split per core stays as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.isStreaming or df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines as raw text, so that bad lines can become dead letters."""
    return spread(spark.read.text(path))


def stream_messages(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path)


def write_messages(messages: DataFrame, path: str) -> None:
    """Append one-column messages as JSON lines."""
    messages.write.mode("append").text(path)
