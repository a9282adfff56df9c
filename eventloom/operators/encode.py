"""Typed events to JSON messages, and packing of events into batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom import schema
from eventloom.functions.scalar import iso_utc, utf8_bytes


def event_json(df: DataFrame) -> Column:
    """JSON text holding the common fields plus those of the row's own subtype.

    Null fields are written out; fields of other subtypes are not.
    """
    options = {"ignoreNullFields": "false"}

    def body(extra: tuple[str, ...]) -> Column:
        names = [n for n in schema.BASE_FIELDS + extra if n in df.columns]
        return F.to_json(F.struct(*[_json_field(n) for n in names]), options)

    text = None
    for kind, extra in schema.SUBTYPE_FIELDS.items():
        matches = F.col("event_type") == kind
        text = F.when(matches, body(extra)) if text is None else text.when(matches, body(extra))
    return text.otherwise(body(()))


def _json_field(name: str) -> Column:
    if name == "timestamp":
        return iso_utc(F.col(name)).alias(name)
    if name == "metadata":
        return F.try_parse_json(F.coalesce(F.col(name), F.lit("{}"))).alias(name)
    return F.col(name)


def encode_events(df: DataFrame) -> DataFrame:
    """Messages as a topic takes them: one ``value`` column, no key."""
    return df.select(event_json(df).alias("value"))


def split_oversize(df: DataFrame, message: str, limit: int = schema.MAX_MESSAGE_BYTES) -> tuple[DataFrame, DataFrame]:
    """Messages within the byte limit, and those above it for the dead-letter branch."""
    size = utf8_bytes(F.col(message))
    return df.where(size <= limit), df.where(size > limit)


def pack_batches(df: DataFrame, batch_of: Column, order: str, created_at: Column) -> DataFrame:
    """Batches of events: (batch_id, events, created_at), events sorted by ``order``.

    ``batch_of`` must bound a batch by construction, for instance a range of
    unique ids, because one batch is one row.
    """
    rest = [c for c in df.columns if c != order]
    element = F.struct(order, *rest)
    return (
        df.groupBy(batch_of.alias("batch_id"))
        .agg(F.sort_array(F.collect_list(element)).alias("events"))
        .withColumn("created_at", created_at)
    )


def unpack_batches(batches: DataFrame) -> DataFrame:
    return batches.select("batch_id", F.inline("events"))
