"""Narrow per-subtype views over the wide event row, and their union."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom import schema


def subtype(df: DataFrame, kind: str) -> DataFrame:
    """Rows of one event type with only the columns that type has."""
    names = schema.BASE_FIELDS + schema.SUBTYPE_FIELDS.get(kind, ())
    return df.where(F.col("event_type") == kind).select(*[n for n in names if n in df.columns])


def plain(df: DataFrame) -> DataFrame:
    """Rows of the types that have no fields of their own."""
    names = [n for n in schema.BASE_FIELDS if n in df.columns]
    return df.where(~F.col("event_type").isin(*schema.SUBTYPE_FIELDS)).select(*names)


def reunite(parts: list[DataFrame]) -> DataFrame:
    """One stream again; columns a part lacks become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
