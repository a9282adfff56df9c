"""Golden messages, boundary values and encoding."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from eventloom import schema
from eventloom.functions.scalar import is_blank, is_ipv4, parse_iso, percent
from eventloom.operators.dedup import first_delivery
from eventloom.operators.decode import decode_events, decode_trusted
from eventloom.operators.encode import encode_events, pack_batches, split_oversize, unpack_batches
from eventloom.operators.quality import with_warnings
from eventloom.operators.validate import accepted, dead_letters, validate
from eventloom.operators.views import plain, reunite, subtype

# The documented example messages.
COMMON = {
    "event_id": "550e8400-e29b-41d4-a716-446655440000",
    "user_id": "user_00001",
    "session_id": "sess_abc123xyz",
    "timestamp": "2024-01-15T10:30:45.123456Z",
    "country": "IN",
}
BASE = {**COMMON, "event_type": "page_view", "device": "web"}
TAGGED = {
    **COMMON,
    "event_type": "purchase",
    "device": "mobile",
    "page": "/checkout",
    "value": 99.99,
    "currency": "USD",
    "metadata": {"product_id": "prod_123", "quantity": 2},
}
PURCHASE = {
    **COMMON,
    "event_type": "purchase",
    "device": "mobile",
    "value": 2499.99,
    "currency": "INR",
    "product_id": "prod_laptop_001",
    "quantity": 1,
    "category": "electronics",
}
VIDEO = {
    **COMMON,
    "event_type": "video_watch",
    "device": "web",
    "video_id": "vid_kafka_tutorial",
    "duration_seconds": 1200,
    "watched_percentage": 85.5,
    "video_duration": 3600,
}
CLICK = {
    **COMMON,
    "event_type": "click",
    "device": "mobile",
    "element_id": "btn_purchase",
    "element_type": "button",
    "x_coordinate": 150,
    "y_coordinate": 250,
}
SEARCH = {
    **COMMON,
    "event_type": "search",
    "device": "web",
    "query": "python kafka tutorial",
    "results_count": 1250,
    "category": "videos",
}


def received():
    return F.expr("timestamp'2024-02-01 00:00:00'")


def decoded(spark, *messages, strict=True):
    texts = [m if isinstance(m, str) else json.dumps(m) for m in messages]
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "n int, value string")
    result = decode_events(df, strict=strict, received_at=received(), keep=("n",))
    return sorted(result.collect(), key=lambda r: r.n)


def without(message, key):
    return {k: v for k, v in message.items() if k != key}


NBSP = " "
BOUNDARIES = [
    ({**BASE, "user_id": ""}, "blank_user_id"),
    ({**BASE, "user_id": " "}, "blank_user_id"),
    ({**BASE, "user_id": "\t\n"}, "blank_user_id"),
    ({**BASE, "user_id": NBSP}, "blank_user_id"),
    ({**BASE, "user_id": " a"}, ""),
    ({**BASE, "session_id": " "}, "blank_session_id"),
    ({**BASE, "value": -0.01}, "negative_value"),
    ({**BASE, "value": 0}, ""),
    ({**BASE, "value": None}, ""),
    (without(PURCHASE, "value"), "missing_value"),
    ({**PURCHASE, "value": -1}, "negative_value"),
    ({**PURCHASE, "quantity": 0}, "nonpositive_quantity"),
    ({**PURCHASE, "quantity": -1}, "nonpositive_quantity"),
    (without(PURCHASE, "quantity"), ""),
    ({**VIDEO, "watched_percentage": 0}, ""),
    ({**VIDEO, "watched_percentage": 100}, ""),
    ({**VIDEO, "watched_percentage": -0.01}, "watched_percentage_out_of_range"),
    ({**VIDEO, "watched_percentage": 100.01}, "watched_percentage_out_of_range"),
    ({**BASE, "event_type": "Login"}, "unknown_event_type"),
    ({**BASE, "event_type": "unknown"}, "unknown_event_type"),
    (without(BASE, "event_type"), "missing_event_type"),
    (without(BASE, "device"), ""),
    ({**BASE, "device": "tv"}, "unknown_device"),
    ({**BASE, "device": None}, "null_device"),
    ({**BASE, "currency": None}, ""),
    ({**PURCHASE, "currency": None}, "null_currency"),
    ({**BASE, "metadata": None}, "null_metadata"),
    (without(CLICK, "element_id"), "missing_element_id"),
    (without(SEARCH, "query"), "missing_query"),
    (without(VIDEO, "video_id"), "missing_video_id"),
    ({**PURCHASE, "value": "1.5"}, ""),
    ({**PURCHASE, "quantity": "2"}, ""),
    ({**PURCHASE, "quantity": 2.0}, ""),
    ({**PURCHASE, "quantity": 2.5}, "type_quantity"),
    ({**PURCHASE, "value": "abc"}, "type_value"),
    ({**BASE, "user_id": 123}, "type_user_id"),
    ({**PURCHASE, "value": "NaN"}, "non_finite_value"),
    ({**PURCHASE, "value": "Infinity"}, "non_finite_value"),
    ({**BASE, "timestamp": "2024-01-15T10:30:45"}, ""),
    ({**BASE, "timestamp": "yesterday"}, "type_timestamp"),
    ({**BASE, "surprise": 1}, ""),
    ("{bad", "malformed_json"),
    ("[1]", "malformed_json"),
    ({**BASE, "user_id": "", "device": "tv"}, "blank_user_id,unknown_device"),
]


def test_golden_examples(spark):
    rows = decoded(spark, PURCHASE, VIDEO, CLICK, SEARCH, TAGGED)
    assert [r.faults for r in rows] == [[], [], [], [], ["missing_product_id"]]
    assert decoded(spark, TAGGED, strict=False)[0].faults == []
    purchase, video, click, search, _ = rows
    assert (purchase.value, purchase.currency, purchase.quantity) == (2499.99, "INR", 1)
    assert (video.duration_seconds, video.watched_percentage, video.video_duration) == (1200.0, 85.5, 3600.0)
    assert (click.element_id, click.x_coordinate, click.y_coordinate) == ("btn_purchase", 150, 250)
    assert (search.query, search.results_count, search.category) == ("python kafka tutorial", 1250, "videos")


def test_boundary_rows(spark):
    rows = decoded(spark, *[m for m, _ in BOUNDARIES])
    assert [",".join(r.faults) for r in rows] == [fault for _, fault in BOUNDARIES]


def test_defaults_and_conversions(spark):
    bare = {k: COMMON[k] for k in ("user_id", "session_id")}
    first, second, again, converted = decoded(
        spark,
        {**bare, "event_type": "login"},
        {**bare, "event_type": "logout"},
        {**bare, "event_type": "login"},
        {**PURCHASE, "value": "1.5", "quantity": "2"},
    )
    assert (first.device, first.country, first.currency, first.metadata) == ("web", "IN", "USD", "{}")
    assert first.timestamp == datetime(2024, 2, 1)
    assert first.event_id == again.event_id != second.event_id
    assert first.quantity is None and decoded(spark, without(PURCHASE, "quantity"))[0].quantity == 1
    assert (converted.value, converted.quantity) == (1.5, 2)


def test_kept_text_and_times(spark):
    texts = ["2024-01-15T10:30:45.123456Z", "2024-01-15T10:30:45.123456", "2024-01-15T16:00:45.123456+05:30"]
    rows = decoded(spark, *[{**BASE, "timestamp": t, "user_id": " a"} for t in texts], {**BASE, "timestamp": 1705314645})
    assert {r.timestamp for r in rows[:3]} == {datetime(2024, 1, 15, 10, 30, 45, 123456)}
    assert rows[3].timestamp == datetime(2024, 1, 15, 10, 30, 45)
    assert rows[0].user_id == " a"


def test_dead_letters_and_accepted_add_up(spark):
    df = spark.createDataFrame([(json.dumps(m) if not isinstance(m, str) else m,) for m, _ in BOUNDARIES], "value string")
    checked = decode_events(df, received_at=received())
    letters = dead_letters(checked, F.col("raw"), received())
    bad = [fault for _, fault in BOUNDARIES if fault]
    assert letters.count() == len(bad)
    assert accepted(checked).count() == len(BOUNDARIES) - len(bad)
    both = letters.where("error_reason = 'blank_user_id,unknown_device'").first()
    assert both.error_type == "blank_user_id" and json.loads(both.raw_data)["device"] == "tv"


def test_typed_validation_matches_decoding(spark):
    rows = decoded(spark, *[m for m, f in BOUNDARIES if "type_" not in f and "null_" not in f and f != "malformed_json"])
    df = spark.createDataFrame([r[1:-2] for r in rows], schema.EVENT_SCHEMA)
    faults = [r.faults for r in validate(df).collect()]
    assert sorted(map(str, faults)) == sorted(str(r.faults) for r in rows)


def test_encode_keeps_own_fields_and_nulls(spark):
    rows = spark.createDataFrame([(json.dumps(m),) for m in (PURCHASE, BASE)], "value string")
    texts = [r.value for r in encode_events(accepted(decode_events(rows, received_at=received()))).collect()]
    purchase, base = (json.loads(t) for t in texts)
    assert purchase["product_id"] == "prod_laptop_001" and "video_id" not in purchase
    assert "product_id" not in base and base["value"] is None and base["metadata"] == {}
    assert base["timestamp"] == "2024-01-15T10:30:45.123456"


def test_trusted_path_agrees_on_good_messages(spark):
    df = spark.createDataFrame([(json.dumps(m),) for m in (PURCHASE, VIDEO, CLICK, SEARCH)] + [("{bad",)], "value string")
    fast = decode_trusted(df).collect()
    full = decode_events(df, received_at=received()).collect()
    assert [r.malformed for r in fast] == [False] * 4 + [True]
    for quick, slow in zip(fast[:4], full[:4], strict=True):
        for name in ("event_id", "user_id", "timestamp", "value", "quantity", "watched_percentage", "x_coordinate"):
            if quick[name] is not None:
                assert quick[name] == slow[name]


def test_batches_round_trip(spark):
    df = spark.range(250).select(F.col("id").alias("event_id"), (F.col("id") * 2).alias("value"))
    batches = pack_batches(df, F.expr("event_id DIV 100"), "event_id", received())
    assert sorted(len(r.events) for r in batches.collect()) == [50, 100, 100]
    back = unpack_batches(batches).select("event_id", "value")
    assert sorted(back.collect()) == sorted(df.collect())


def test_golden_examples_share_one_id(spark):
    df = spark.createDataFrame([(json.dumps(m),) for m in (PURCHASE, VIDEO, CLICK, SEARCH)], "value string")
    events = decode_events(df, received_at=received()).drop("faults", "raw")
    assert first_delivery(events, ts="timestamp").count() == 1


def test_views_unite_to_the_whole(spark):
    df = spark.createDataFrame([(json.dumps(m),) for m in (PURCHASE, VIDEO, CLICK, SEARCH, BASE)], "value string")
    wide = accepted(decode_events(df, received_at=received()))
    clicks = subtype(wide, "click")
    assert "element_id" in clicks.columns and "product_id" not in clicks.columns
    parts = [subtype(wide, kind) for kind in schema.SUBTYPE_FIELDS] + [plain(wide)]
    assert sorted(map(str, reunite(parts).select(wide.columns).collect())) == sorted(map(str, wide.collect()))


def test_warnings(spark):
    messages = [
        VIDEO,
        {**VIDEO, "duration_seconds": 900, "watched_percentage": 25.0},
        {**CLICK, "x_coordinate": 1921},
        {**CLICK, "x_coordinate": 1920, "y_coordinate": 1080},
        {**BASE, "ip_address": "1.2.3.256"},
        {**BASE, "ip_address": "1.2.3.255"},
    ]
    df = spark.createDataFrame([(i, json.dumps(m)) for i, m in enumerate(messages)], "n int, value string")
    warned = with_warnings(decode_events(df, received_at=received(), keep=("n",))).orderBy("n").collect()
    assert [r.warnings for r in warned] == [["video_inconsistent"], [], ["click_off_screen"], [], ["bad_ip_address"], []]


def test_oversize_messages(spark):
    df = spark.createDataFrame([("a" * 10,), ("é" * 10,)], "value string")
    sent, oversize = split_oversize(df, "value", limit=10)
    assert (sent.count(), oversize.count()) == (1, 1)


@pytest.mark.parametrize(
    ("text", "blank"), [("", True), (" ", True), ("\t\n", True), (NBSP, True), ("　", True), ("\x1c", True), ("a", False)]
)
def test_blank(spark, text, blank):
    assert spark.createDataFrame([(text,)], "t string").select(is_blank(F.col("t"))).first()[0] is blank


def test_scalars(spark):
    row = spark.createDataFrame([(1, 0, "1.2.3", "10:30")], "a int, b int, ip string, t string").select(
        percent(F.col("a"), F.col("b")).alias("none"),
        percent(F.col("a"), F.lit(3)).alias("third"),
        is_ipv4(F.col("ip")).alias("ip"),
        parse_iso(F.lit("no time")).alias("bad"),
    ).first()
    assert (row.none, row.third, row.ip, row.bad) == (0.0, 33.33, False, None)
