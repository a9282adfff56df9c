"""Windows, sessions and de-duplication on streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_counts(df: DataFrame, delay: str, size: str, slide: str | None, *keys: str, ts: str = "ts") -> DataFrame:
    """Event counts per window and key, emitted once ``delay`` has passed beyond the window."""
    bounds = F.window(ts, size, slide) if slide else F.window(ts, size)
    counted = df.withWatermark(ts, delay).groupBy(bounds.alias("w"), *keys).agg(F.count("*").alias("n"))
    return counted.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "n")


def gap_sessions(df: DataFrame, delay: str, gap: str, key: str = "user_id", ts: str = "ts") -> DataFrame:
    """Sessions per key, emitted once no event within ``delay`` can extend them."""
    grouped = df.withWatermark(ts, delay).groupBy(key, F.session_window(ts, gap).alias("w"))
    counted = grouped.agg(F.count("*").alias("n"))
    return counted.select(key, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


def first_delivery(df: DataFrame, delay: str, key: str = "event_id", ts: str = "ts") -> DataFrame:
    """One row per key among deliveries at most ``delay`` apart in event time."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])
