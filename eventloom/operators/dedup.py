"""One row per event id, also across deliveries already stored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_delivery(df: DataFrame, key: str = "event_id", ts: str = "ts") -> DataFrame:
    """Earliest row per key; ties go to the smaller content hash.

    An aggregate rather than a ranked window: copies collapse before the shuffle,
    so a key with very many copies never lands whole in one task.
    """
    rest = [c for c in df.columns if c != key]
    row = F.struct(F.col(ts).alias("_at"), F.xxhash64(*rest).alias("_tie"), *rest)
    best = df.groupBy(key).agg(F.min(row).alias("_row"))
    return best.select(*[F.col(key) if c == key else F.col(f"_row.{c}").alias(c) for c in df.columns])


def not_stored(incoming: DataFrame, stored: DataFrame, key: str = "event_id", ts: str = "ts") -> DataFrame:
    """Events of a delivery that the store does not hold yet."""
    unique = first_delivery(incoming, key, ts)
    return unique.join(stored.select(key), key, "left_anti")


def replay(incoming: DataFrame, repaired: DataFrame, key: str = "event_id", ts: str = "ts") -> DataFrame:
    """Fold repaired dead letters back into the input, once each."""
    both = incoming.unionByName(repaired, allowMissingColumns=True)
    return first_delivery(both, key, ts)
