"""Event schema, value domains and stored-table schemas."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Event types and devices a message may carry.
EVENT_TYPES = (
    "login",
    "logout",
    "page_view",
    "click",
    "purchase",
    "video_watch",
    "search",
    "cart_add",
    "cart_remove",
    "share",
)
DEVICES = ("web", "mobile", "tablet", "desktop")

# Defaults for absent keys.
DEFAULT_DEVICE = "web"
DEFAULT_COUNTRY = "IN"
DEFAULT_CURRENCY = "USD"
DEFAULT_QUANTITY = 1
DEFAULT_RESULTS_COUNT = 0

# Topics, message limit and anomaly threshold.
TOPIC_EVENTS = "user-events"
TOPIC_ANALYTICS = "user-analytics"
TOPIC_ANOMALIES = "user-anomalies"
MAX_MESSAGE_BYTES = 1_000_000
ANOMALY_THRESHOLD = 0.7


@dataclass(frozen=True)
class FieldRule:
    """How one JSON key is read.

    ``kind`` is the declared type. ``required_for`` lists the event types whose
    messages must carry the key ("*" for all), ``nullable_for`` says where an
    explicit null is legal ("*", or every type but those in ``not_null_for``),
    ``owners`` restricts the field to some event types, and ``default`` fills an
    absent key.
    """

    name: str
    kind: str
    owners: tuple[str, ...] = ()
    required_for: tuple[str, ...] = ()
    nullable: bool = True
    not_null_for: tuple[str, ...] = ()
    default: object = None


# Declared order; it is also the order in which faults are reported.
FIELDS = (
    FieldRule("event_id", "string", nullable=False),
    FieldRule("user_id", "string", required_for=("*",), nullable=False),
    FieldRule("session_id", "string", required_for=("*",), nullable=False),
    FieldRule("event_type", "string", required_for=("*",), nullable=False),
    FieldRule("timestamp", "timestamp", nullable=False),
    FieldRule("device", "string", nullable=False, default=DEFAULT_DEVICE),
    FieldRule("country", "string", nullable=False, default=DEFAULT_COUNTRY),
    FieldRule("ip_address", "string"),
    FieldRule("page", "string"),
    FieldRule("referrer", "string"),
    FieldRule("duration_seconds", "double", required_for=("video_watch",), not_null_for=("video_watch",)),
    FieldRule("value", "double", required_for=("purchase",), not_null_for=("purchase",)),
    FieldRule("currency", "string", not_null_for=("purchase",), default=DEFAULT_CURRENCY),
    FieldRule("metadata", "object", nullable=False),
    FieldRule("product_id", "string", owners=("purchase",), required_for=("purchase",), nullable=False),
    FieldRule("quantity", "int", owners=("purchase",), nullable=False, default=DEFAULT_QUANTITY),
    FieldRule("category", "string", owners=("purchase", "search")),
    FieldRule("video_id", "string", owners=("video_watch",), required_for=("video_watch",), nullable=False),
    FieldRule("watched_percentage", "double", owners=("video_watch",), required_for=("video_watch",), nullable=False),
    FieldRule("video_duration", "double", owners=("video_watch",), required_for=("video_watch",), nullable=False),
    FieldRule("element_id", "string", owners=("click",), required_for=("click",), nullable=False),
    FieldRule("element_type", "string", owners=("click",), required_for=("click",), nullable=False),
    FieldRule("x_coordinate", "int", owners=("click",)),
    FieldRule("y_coordinate", "int", owners=("click",)),
    FieldRule("query", "string", owners=("search",), required_for=("search",), nullable=False),
    FieldRule("results_count", "int", owners=("search",), nullable=False, default=DEFAULT_RESULTS_COUNT),
)

_SPARK_TYPES = {
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "object": T.StringType(),
}

# One wide nullable row for every event type; metadata stays JSON text.
EVENT_SCHEMA = T.StructType([T.StructField(f.name, _SPARK_TYPES[f.kind]) for f in FIELDS])

BASE_FIELDS = tuple(f.name for f in FIELDS if not f.owners)
SUBTYPE_FIELDS = {
    kind: tuple(f.name for f in FIELDS if kind in f.owners)
    for kind in ("purchase", "video_watch", "click", "search")
}

STORED_EVENT_COLUMNS = (
    "event_id string, user_id string, session_id string, event_type string, timestamp timestamp, "
    "device string, country string, value decimal(15,2), data string, created_at timestamp"
)
DEAD_LETTER_COLUMNS = (
    "id bigint, event_id string, error_reason string, error_type string, raw_data string, timestamp timestamp"
)
