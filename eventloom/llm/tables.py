"""Intermediate tables of a job, in the folder all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from eventloom.session import workspace


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one if the table has such a column, in whatever case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table and read it back: later steps start from its files, also when an
    executor is lost, and nothing before it is computed again."""
    path = workspace(df.sparkSession, purpose)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
