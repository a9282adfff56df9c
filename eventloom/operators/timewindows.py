"""Tumbling, sliding and session windows over stored events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.functions.scalar import interval


def windowed_counts(df: DataFrame, size: str, slide: str | None, *keys: str, ts: str = "ts") -> DataFrame:
    """Event counts per window and key; tumbling when ``slide`` is None."""
    bounds = F.window(ts, size, slide) if slide else F.window(ts, size)
    counted = df.groupBy(bounds.alias("w"), *keys).agg(F.count("*").alias("n"))
    return counted.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "n")


def gap_sessions(
    df: DataFrame, gap: str, key: str = "user_id", ts: str = "ts", firsts: dict | None = None, lasts: dict | None = None
) -> DataFrame:
    """Sessions per key: events at most ``gap`` apart belong together.

    Events inside one ``gap``-long bucket always share a session, so each bucket
    is aggregated first, on the map side; only bucket rows, at most one per key and
    gap of elapsed time, are ordered to find the breaks. ``firsts`` and ``lasts`` map
    new columns to structs that start with the time; the smallest and largest survive.
    """
    firsts, lasts = firsts or {}, lasts or {}
    buckets = df.groupBy(key, F.window(ts, gap).alias("_bucket")).agg(
        F.min(ts).alias("_first"),
        F.max(ts).alias("_last"),
        F.count("*").alias("_n"),
        *[F.min(e).alias(n) for n, e in firsts.items()],
        *[F.max(e).alias(n) for n, e in lasts.items()],
    )
    in_order = Window.partitionBy(key).orderBy("_first")
    starts = F.coalesce(F.col("_first") - F.lag("_last").over(in_order) > interval(gap), F.lit(True))
    numbered = buckets.withColumn("_starts", starts.cast("int")).withColumn(
        "_session", F.sum("_starts").over(in_order)
    )
    return (
        numbered.groupBy(key, "_session")
        .agg(
            F.min("_first").alias("session_start"),
            F.max("_last").alias("last_event"),
            F.sum("_n").alias("n"),
            *[F.min(n).alias(n) for n in firsts],
            *[F.max(n).alias(n) for n in lasts],
        )
        .withColumn("session_end", F.col("last_event") + interval(gap))
        .drop("_session")
    )


def event_struct(ts: str = "ts", tie: str = "event_id", label: str = "event_type") -> Column:
    return F.struct(F.col(ts), F.col(tie), F.col(label))


def session_edges(df: DataFrame, gap: str, key: str = "user_id", ts: str = "ts") -> DataFrame:
    """Gap sessions with the type of their first and last event."""
    edge = event_struct(ts)
    sessions = gap_sessions(df, gap, key, ts, {"_opening": edge}, {"_closing": edge})
    return sessions.select(
        key,
        "session_start",
        "last_event",
        "n",
        F.col("_opening.event_type").alias("first_type"),
        F.col("_closing.event_type").alias("last_type"),
    )


def session_shape(df: DataFrame, key: str = "session_id", ts: str = "timestamp") -> DataFrame:
    """Sessions by id: whether they open with a login and close with a logout.

    A single login is an open session, not a closed one.
    """
    edge = F.struct(F.col(ts), F.col("event_id"), F.col("event_type"))
    return (
        df.groupBy(key)
        .agg(
            F.min(ts).alias("session_start"),
            F.max(ts).alias("last_event"),
            F.count("*").alias("n"),
            F.min(edge).alias("_opening"),
            F.max(edge).alias("_closing"),
        )
        .select(
            key,
            "session_start",
            "last_event",
            "n",
            (F.col("_opening.event_type") == "login").alias("opens_with_login"),
            (F.col("_closing.event_type") == "logout").alias("closes_with_logout"),
        )
    )


def timeline(df: DataFrame, key: str = "session_id", ts: str = "timestamp") -> DataFrame:
    """Rows in time order inside their session, as files of a store want them.

    The rows are range-partitioned on key and time, so a long session spreads
    over several tasks and stays ordered across them.
    """
    return df.repartitionByRange(F.col(key), F.col(ts)).sortWithinPartitions(key, ts)


def out_of_order(laid_out: DataFrame, key: str = "session_id", ts: str = "timestamp") -> DataFrame:
    """(key, out_of_order): rows of a key that lie after a later row, in the order of partitions and of rows within them."""
    placed = laid_out.select(key, F.col(ts).alias("_at"), F.monotonically_increasing_id().alias("_place"))
    as_laid = Window.partitionBy(key).orderBy("_place")
    return placed.withColumn("_wrong", F.col("_at") < F.lag("_at").over(as_laid)).groupBy(key).agg(
        F.count_if("_wrong").alias("out_of_order")
    )
