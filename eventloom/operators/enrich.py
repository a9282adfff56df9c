"""Events joined with users and catalogs.

No join is forced to broadcast: Spark broadcasts a side only below
``spark.sql.autoBroadcastJoinThreshold`` by its measured size, and otherwise
sort-merges, with AQE splitting partitions of hot keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_users(events: DataFrame, users: DataFrame, key: str = "user_id") -> DataFrame:
    """Every event with its user's profile columns, null where unknown."""
    return events.join(users, key, "left")


def orphans(events: DataFrame, users: DataFrame, key: str = "user_id") -> DataFrame:
    return events.join(users.select(key), key, "left_anti")


def known_only(events: DataFrame, users: DataFrame, key: str = "user_id") -> DataFrame:
    return events.join(users.select(key), key, "left_semi")


def with_catalog(events: DataFrame, catalog: DataFrame, key: str) -> DataFrame:
    """Every event with its catalog entry (product, video or page element)."""
    return events.join(catalog, key, "left")


def price_check(sales: DataFrame, catalog: DataFrame, key: str, price: Column, low: Column, high: Column) -> DataFrame:
    """Add ``in_range``: the price lies in the range the catalog gives for the product.

    Unknown products stay, with ``in_range`` false.
    """
    joined = sales.join(catalog, key, "left")
    return joined.withColumn("in_range", F.coalesce(price.between(low, high), F.lit(False)))
