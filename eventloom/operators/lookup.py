"""Selections: by user, time, type and country; newest rows; retention."""

from __future__ import annotations

from datetime import datetime, time, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions.scalar import interval

#: Partition column of the stored layout.
DAY = "event_date"


def find_events(
    df: DataFrame,
    user_id=None,
    start: datetime | None = None,
    end: datetime | None = None,
    event_types: tuple[str, ...] = (),
    country: str | None = None,
    ts: str = "ts",
) -> DataFrame:
    """Filters that reach the scan; ``start`` is inclusive, ``end`` exclusive.

    On the stored layout, which has the day of ``ts`` as a partition column, bounds on the time also bound
    the day, so that other days are not opened.
    """
    if DAY in df.columns:
        if start is not None:
            df = df.where(F.col(DAY) >= F.lit(start.date()))
        if end is not None:
            last = end.date() if end.time() != time.min else end.date() - timedelta(days=1)
            df = df.where(F.col(DAY) <= F.lit(last))
    if user_id is not None:
        df = df.where(F.col("user_id") == user_id)
    if start is not None:
        df = df.where(F.col(ts) >= F.lit(start.isoformat(" ")).cast(df.schema[ts].dataType))
    if end is not None:
        df = df.where(F.col(ts) < F.lit(end.isoformat(" ")).cast(df.schema[ts].dataType))
    if event_types:
        df = df.where(F.col("event_type").isin(*event_types))
    if country is not None:
        df = df.where(F.col("country") == country)
    return df


def latest(df: DataFrame, count: int, ts: str = "ts", key: str = "event_id") -> DataFrame:
    return df.orderBy(F.desc(ts), F.desc(key)).limit(count)


def retained(df: DataFrame, keep: str, ts: str = "ts") -> DataFrame:
    """Rows of the last ``keep`` before the newest event.

    The newest time is a scalar subquery, so the scan can filter on its value. On the stored layout it is
    looked up in the newest day, and days out of reach are pruned when the subquery's value is known.
    """
    if DAY in df.columns:
        last_day = df.agg(F.max(DAY)).scalar()
        newest = df.where(F.col(DAY) == last_day).agg(F.max(ts)).scalar()
        return df.where((F.col(DAY) >= F.to_date(newest - interval(keep))) & (F.col(ts) >= newest - interval(keep)))
    newest = df.agg(F.max(ts)).scalar()
    return df.where(F.col(ts) >= newest - interval(keep))
