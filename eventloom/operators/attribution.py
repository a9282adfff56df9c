"""Purchases attributed to the clicks that led to them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventloom.functions.scalar import interval, percent
from eventloom.operators.ordered import CHUNK, GROUP, MAX_CHUNK_ROWS, carried_in


def last_touch(clicks: DataFrame, purchases: DataFrame, horizon: str, max_rows: int = MAX_CHUNK_ROWS) -> DataFrame:
    """One row per purchase: the latest click in ``horizon`` and how many there were.

    Both inputs have (event_id, user_id, ts). A click counts from its own time until
    just before ``horizon`` has passed. The result has one row per purchase, matched or
    not, and is found by one ordered sweep over clicks, their expiries and purchases;
    click-purchase pairs are never formed. A purchase without a user or a time has no click.
    """
    key = "user_id"
    clicks = clicks.where(F.col(key).isNotNull() & F.col("ts").isNotNull())
    seen = clicks.select(
        key,
        F.col("ts").alias("_at"),
        F.lit(0).alias("_phase"),
        F.lit(1).alias("_step"),
        F.struct(F.col("ts").alias("at"), F.col("event_id").alias("id")).alias("_click"),
    )
    expired = clicks.select(
        key, (F.col("ts") + interval(horizon)).alias("_at"), F.lit(1).alias("_phase"), F.lit(-1).alias("_step")
    )
    bought = purchases.select(
        key,
        F.col("ts").alias("_at"),
        F.lit(2).alias("_phase"),
        F.lit(0).alias("_step"),
        F.col("event_id").alias("purchase_id"),
    )
    sweep = seen.unionByName(expired, allowMissingColumns=True).unionByName(bought, allowMissingColumns=True)
    carried = carried_in(
        sweep, key, "_at", {"_steps": F.col("_step")}, {"_latest": F.col("_click")}, max_rows
    )
    upto = Window.partitionBy(*GROUP, CHUNK).orderBy("_at", "_phase").rangeBetween(Window.unboundedPreceding, 0)
    swept = carried.select(
        "*",
        F.coalesce(F.max("_click").over(upto), F.col("_latest")).alias("_last"),
        (F.coalesce(F.col("_steps"), F.lit(0)) + F.sum("_step").over(upto)).alias("_in_reach"),
    ).where(F.col("_phase") == 2)
    in_reach = F.col("_last.at") > F.col("_at") - interval(horizon)
    return swept.select(
        "purchase_id",
        key,
        F.col("_at").alias("purchase_ts"),
        F.when(in_reach, F.col("_last.id")).alias("click_id"),
        F.when(in_reach, F.col("_last.at")).alias("click_ts"),
        F.col("_in_reach").cast("bigint").alias("clicks_in_reach"),
    )


def conversion(clicks: DataFrame, attributed: DataFrame) -> DataFrame:
    """Users who clicked, users who bought after a click, and the rate in percent."""
    clicking = clicks.agg(F.count_distinct("user_id").alias("clicking_users"))
    converting = attributed.where(F.col("click_id").isNotNull()).agg(
        F.count_distinct("user_id").alias("converting_users")
    )
    return clicking.select("clicking_users", converting.scalar().alias("converting_users")).withColumn(
        "conversion_rate", percent(F.col("converting_users"), F.col("clicking_users"))
    )
