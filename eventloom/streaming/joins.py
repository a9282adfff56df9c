"""Streams joined with tables and with each other."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions.scalar import interval


def with_users(df: DataFrame, users: DataFrame, key: str = "user_id") -> DataFrame:
    """Stream rows with the profile of their user as the table has it at that batch."""
    return df.join(users, key, "left")


def clicks_before_purchases(
    clicks: DataFrame, purchases: DataFrame, delay: str, horizon: str, shards: int = 4
) -> DataFrame:
    """Parts of the answer for every purchase: (purchase_id, user_id, purchase_ts, clicks, latest).

    A click counts from its own time until just before ``horizon`` has passed. Minutes that lie wholly in that
    span come in as one row each, how many clicks and the latest, once the watermark has closed
    them; of the two minutes at its ends the single clicks are joined, at once. So a purchase
    meets at most one row per minute of the horizon and the clicks of two minutes, however
    many clicks a busy user makes. Every purchase also gives a row of its own without clicks, which
    keeps those that none led to. The time bounds let the watermark evict the state of all joins.

    The minutes' side is replicated to ``shards`` of the user's purchases, the single clicks are
    dealt by user and minute, so no user's side of a join is one task. ``attributed`` adds the parts up; the answer of a
    purchase is final once the watermark has passed its time.
    """
    one_minute = F.make_dt_interval(mins=F.lit(1))
    minutes = (
        clicks.withWatermark("ts", delay)
        .groupBy("user_id", F.window("ts", "1 minute").alias("w"))
        .agg(
            F.count("*").alias("clicks"),
            F.max(F.struct(F.col("ts").alias("at"), F.col("event_id").alias("id"))).alias("latest"),
        )
        # The last microsecond of the minute.
        .select(F.col("user_id").alias("clicker"), F.window_time("w").alias("minute_end"), "clicks", "latest")
        .withColumn("click_shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    )
    bought = purchases.select(
        F.col("event_id").alias("purchase_id"), "user_id", F.col("ts").alias("purchase_ts")
    ).withWatermark("purchase_ts", delay)
    columns = ["purchase_id", "user_id", "purchase_ts", "clicks", "latest"]
    sharded = bought.withColumn("shard", F.pmod(F.xxhash64("purchase_id"), F.lit(shards)).cast("int"))
    inside = (F.col("minute_end") < F.col("purchase_ts")) & (
        F.col("minute_end") >= F.col("purchase_ts") - interval(horizon) + one_minute
    )
    same_user = (F.col("user_id") == F.col("clicker")) & (F.col("shard") == F.col("click_shard"))
    whole_minutes = sharded.join(minutes, same_user & inside).select(*columns)

    single = clicks.select(
        F.col("user_id").alias("clicker"),
        F.col("ts").alias("click_ts"),
        F.date_trunc("minute", "ts").alias("minute"),
        F.lit(1).cast("long").alias("clicks"),
        F.struct(F.col("ts").alias("at"), F.col("event_id").alias("id")).alias("latest"),
    ).withWatermark("click_ts", delay)
    ends = F.array_distinct(
        F.array(F.date_trunc("minute", "purchase_ts"), F.date_trunc("minute", F.col("purchase_ts") - interval(horizon)))
    )
    probes = bought.withColumn("edge", F.explode(ends))
    in_reach = (F.col("click_ts") <= F.col("purchase_ts")) & (F.col("click_ts") > F.col("purchase_ts") - interval(horizon))
    at_ends = probes.join(single, (F.col("user_id") == F.col("clicker")) & (F.col("edge") == F.col("minute")) & in_reach)

    nothing = F.lit(None).cast(minutes.schema["latest"].dataType)
    alone = bought.select("purchase_id", "user_id", "purchase_ts", F.lit(0).cast("long").alias("clicks"), nothing.alias("latest"))
    return whole_minutes.unionAll(at_ends.select(*columns)).unionAll(alone)


def attributed(matches: DataFrame) -> DataFrame:
    """One row per purchase from the stored parts: latest click, if any, and number of clicks."""
    return matches.groupBy("purchase_id", "user_id", "purchase_ts").agg(
        F.max("latest").alias("_last"), F.sum("clicks").alias("clicks_in_reach")
    ).select(
        "purchase_id",
        "user_id",
        "purchase_ts",
        F.col("_last.id").alias("click_id"),
        F.col("_last.at").alias("click_ts"),
        "clicks_in_reach",
    )
