"""Streams in several batches, retries, late rows, monitoring, stores and topics."""

from __future__ import annotations

import json
import os
import random
import time
from collections import Counter
from datetime import datetime, timedelta
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

from eventloom import schema
from eventloom.operators import lookup, metrics
from eventloom.sources import files, kafka, store
from eventloom.sources.idindex import IdIndex
from eventloom.sources.logtable import LogTable, State
from eventloom.streaming import joins, monitor, runs, state, tables, windows

START = datetime(2024, 1, 1)
EVENT = "event_id int, user_id bigint, ts timestamp, event_type string, value double"


def day_rows(day: int, count: int = 30):
    kinds = ("purchase", "click", "view")
    return [
        (day * 1000 + i, i % 4 + 1, START + timedelta(days=day, minutes=40 * i), kinds[i % 3], float(i)) for i in range(count)
    ]


def arrive(spark, path, *days):
    for rows in days:
        spark.createDataFrame(rows, EVENT).coalesce(1).write.mode("append").parquet(path)


def stream(spark, path, per_trigger=1):
    return spark.readStream.schema(EVENT).option("maxFilesPerTrigger", per_trigger).parquet(path)


@pytest.fixture
def space(tmp_path):
    return str(tmp_path)


def test_upsert_over_batches_equals_batch_rollup(spark, space):
    days = [day_rows(0), day_rows(1) + day_rows(0)[:10], day_rows(2) + day_rows(1)[5:9] * 2]
    arrive(spark, f"{space}/in", *days)
    handle = tables.upsert_users(f"{space}/events", f"{space}/users")
    runs.run_available(runs.per_batch(stream(spark, f"{space}/in"), handle, f"{space}/checkpoint"))
    whole = spark.createDataFrame(day_rows(0) + day_rows(1) + day_rows(2), EVENT)
    expected = sorted(metrics.user_rollup(whole).collect())
    assert sorted(tables.read_users(spark, f"{space}/users").collect()) == expected
    # The same batch again, as after a failure, changes nothing.
    handle(spark.createDataFrame(days[2], EVENT), 2)
    assert sorted(tables.read_users(spark, f"{space}/users").collect()) == expected
    assert spark.read.parquet(f"{space}/events").count() == whole.count()
    assert tables.compact_users(spark, f"{space}/users")
    assert sorted(tables.read_users(spark, f"{space}/users").collect()) == expected
    # The newest batch once more: its entry is still its own.
    handle(spark.createDataFrame(days[2], EVENT), 2)
    assert sorted(tables.read_users(spark, f"{space}/users").collect()) == expected


def test_redelivery_at_another_time_and_a_second_checkpoint(spark, space):
    later = [(i, user, at + timedelta(hours=2), kind, value) for i, user, at, kind, value in day_rows(0)]
    arrive(spark, f"{space}/in", day_rows(0), later, day_rows(1))
    handle = tables.upsert_users(f"{space}/events", f"{space}/users")
    for checkpoint in ("c1", "c2"):
        runs.run_available(runs.per_batch(stream(spark, f"{space}/in"), handle, f"{space}/{checkpoint}"))
        stored = spark.read.parquet(f"{space}/events")
        assert stored.count() == stored.select("event_id").distinct().count() == 60
        totals = tables.read_users(spark, f"{space}/users").agg(F.sum("total_events"), F.sum("total_purchases")).first()
        assert tuple(totals) == (60, 20)
    batches = LogTable(spark, f"{space}/users").state().batches
    assert len({key.split("/")[0] for key in batches}) == 2


def test_state_accepts_text_ids(spark, space):
    rows = [(f"user_{i % 3:05d}", i, START + timedelta(minutes=i), "purchase", 1.5) for i in range(9)]
    schema = "user_id string, event_id int, ts timestamp, event_type string, value double"
    spark.createDataFrame(rows, schema).write.parquet(f"{space}/in")
    totals = state.running_totals(spark.readStream.schema(schema).parquet(f"{space}/in"))
    runs.run_available(runs.per_batch(totals, tables.keep_changes(f"{space}/out"), f"{space}/c", "update"))
    found = state.combined(tables.latest_changes(spark, f"{space}/out", "user_id", "shard")).collect()
    assert {(r.user_id, r.total_purchases, float(r.total_spent)) for r in found} == {(f"user_{i:05d}", 3, 4.5) for i in range(3)}


class KeptMap:
    """A map state with timers that counts how often it is reached."""

    def __init__(self):
        self.kept, self.timers, self.calls = {}, [], 0

    def reach(self, result):
        self.calls += 1
        return result

    def exists(self):
        return self.reach(bool(self.kept))

    def containsKey(self, key):
        return self.reach(key in self.kept)

    def getValue(self, key):
        return self.reach(self.kept[key])

    def updateValue(self, key, value):
        self.kept[key] = self.reach(value)

    def removeKey(self, key):
        del self.kept[self.reach(key)]

    def iterator(self):
        return iter(self.reach(list(self.kept.items())))

    def getMapState(self, *_):
        return self

    def listTimers(self):
        return self.reach(iter(self.timers))

    def deleteTimer(self, at):
        self.timers.remove(self.reach(at))

    def registerTimer(self, at):
        self.timers.append(self.reach(at))


def test_a_group_of_totals_takes_many_users(spark):
    """One block of results per group, and a few calls of the state per user."""
    kept, processor = KeptMap(), state.RunningTotals(shards=4)
    processor.init(kept)
    for batch in (1, 2):
        kept.calls = 0
        users = [f"u{i}" for i in range(500)]
        parts = [pd.DataFrame({"part": 6, "user": users, "at_us": at * batch, "is_purchase": True, "cents": at}) for at in (20, 10, 30)]
        blocks = list(processor.handleInputRows((6,), iter(parts), None))
        assert len(blocks) == 1 and kept.calls <= 3 * 500 + 1
        found = set(blocks[0].itertuples(index=False, name=None))
        assert found == {(u, 2, 3 * batch, 3 * batch, 60 * batch, 10, 30 * batch) for u in users}


def test_totals_over_batches_with_missing_values(spark, space):
    rows = [(i, None if i % 7 == 0 else i % 40 + 2**60, None if i % 3 == 0 or i % 40 == 5 else START + timedelta(minutes=i), "purchase" if i % 2 else None, float(i)) for i in range(400)]
    rows += [(None, 1, START, "purchase", None), (None, 1, START, "purchase", 2.5)]
    arrive(spark, f"{space}/in", rows[:150], rows[150:300], rows[300:])
    totals = state.running_totals(stream(spark, f"{space}/in"), shards=2)
    runs.run_available(runs.per_batch(totals, tables.keep_changes(f"{space}/out"), f"{space}/c", "update"), state_partitions=2)
    changes = spark.read.parquet(f"{space}/out")
    assert changes.schema["user_id"].dataType.simpleString() == "bigint"
    found = {tuple(r) for r in state.combined(tables.latest_changes(spark, f"{space}/out", "user_id", "shard")).collect()}
    expected = set()
    for user in {r[1] for r in rows}:
        own = [r for r in rows if r[1] == user]
        times, spent = [r[2] for r in own if r[2]], [r[4] for r in own if r[3] == "purchase"]
        total = Decimal(str(sum(v for v in spent if v is not None))).quantize(Decimal("0.01"))
        expected.add((user, min(times, default=None), max(times, default=None), len(own), len(spent), total))
    assert found == expected and len(expected) == 42


def test_changes_keep_the_newest_state(spark, space):
    arrive(spark, f"{space}/in", day_rows(0), day_rows(1), day_rows(2))
    rollup = metrics.user_rollup(stream(spark, f"{space}/in"))
    runs.run_available(runs.per_batch(rollup, tables.keep_changes(f"{space}/out"), f"{space}/c1", "update"))
    totals = state.running_totals(stream(spark, f"{space}/in"), shards=3)
    runs.run_available(runs.per_batch(totals, tables.keep_changes(f"{space}/shards"), f"{space}/c2", "update"))
    expected = sorted(metrics.user_rollup(spark.createDataFrame(day_rows(0) + day_rows(1) + day_rows(2), EVENT)).collect())
    latest = tables.latest_changes(spark, f"{space}/out", "user_id").select("user_id", *rollup.columns[1:])
    assert sorted(latest.collect()) == expected
    combined = state.combined(tables.latest_changes(spark, f"{space}/shards", "user_id", "shard"))
    assert sorted(combined.collect()) == expected


def test_late_rows_are_counted_one_by_one(spark, space):
    arrive(spark, f"{space}/in", day_rows(9), day_rows(5), day_rows(8))
    handle = tables.split_late(f"{space}/split", "24 hours")
    runs.run_available(runs.per_batch(stream(spark, f"{space}/in"), handle, f"{space}/checkpoint"))
    newest = max(r[2] for r in day_rows(9))
    expected = [r[0] for r in day_rows(5) + day_rows(8) if r[2] < newest - timedelta(hours=24)]
    late = [r.event_id for r in spark.read.parquet(f"{space}/split/late").collect()]
    assert sorted(late) == sorted(expected) and expected
    assert spark.read.parquet(f"{space}/split/on_time").count() == 90 - len(late)


def test_stream_equals_batch_on_closed_windows(spark, space):
    arrive(spark, f"{space}/in", *[day_rows(d) for d in range(5)])
    counted = windows.windowed_counts(stream(spark, f"{space}/in"), "24 hours", "1 day", None, "event_type")
    runs.run_available(runs.append_files(counted, f"{space}/out", f"{space}/checkpoint"))
    whole = spark.createDataFrame([r for d in range(5) for r in day_rows(d)], EVENT)
    newest = whole.agg(F.max("ts")).first()[0]
    batch = whole.groupBy(F.window("ts", "1 day").alias("w"), "event_type").count()
    closed = batch.where(F.col("w.end") <= F.lit(newest - timedelta(hours=24)))
    expected = closed.select(F.col("w.start"), F.col("w.end"), "event_type", "count").collect()
    assert sorted(spark.read.parquet(f"{space}/out").collect()) == sorted(expected) and expected


def test_rejected_messages_branch_off(spark, space):
    good = {"user_id": "u", "session_id": "s", "event_type": "login", "timestamp": "2024-01-01T00:00:00"}
    texts = [json.dumps(good), json.dumps({**good, "user_id": " "}), "{bad"]
    files.write_messages(spark.createDataFrame([(t,) for t in texts], "value string"), f"{space}/in")
    assert files.read_messages(spark, f"{space}/in").count() == 3
    arriving = files.stream_messages(spark, f"{space}/in").withColumn("at", F.current_timestamp())
    handle = tables.split_rejected(f"{space}/valid", f"{space}/dead", "at")
    runs.run_available(runs.per_batch(arriving, handle, f"{space}/checkpoint"))
    assert spark.read.parquet(f"{space}/valid").count() == 1
    dead = spark.read.parquet(f"{space}/dead")
    assert sorted(r.error_type for r in dead.collect()) == ["blank_user_id", "malformed_json"]


def test_unbounded_run_stops_and_reports(spark, space):
    log = monitor.ProgressLog()
    spark.streams.addListener(log)
    try:
        arrive(spark, f"{space}/in", day_rows(0), day_rows(1))
        watched = monitor.counted(stream(spark, f"{space}/in"), F.col("event_type") == "view")
        writer = runs.append_files(watched, f"{space}/out", f"{space}/checkpoint").queryName("watched")
        query = runs.run_for(writer, "200 milliseconds", seconds=8)
        assert not query.isActive
        deadline = time.time() + 10
        while log.latest.get("watched", {}).get("rows", 0) < 60 and time.time() < deadline:
            time.sleep(0.2)
        assert log.latest["watched"]["rows"] == 60 and log.latest["watched"]["behind"] == 0
        assert log.metrics["watched"] == {"sent": 60, "failed": 20}
    finally:
        spark.streams.removeListener(log)


def test_daily_stats_replace_only_their_days(spark, space):
    first = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2)], "day string, n int")
    store.write_daily_stats(first, f"{space}/daily")
    store.write_daily_stats(spark.createDataFrame([("2024-01-02", 5)], "day string, n int"), f"{space}/daily")
    rows = spark.read.parquet(f"{space}/daily").select(F.col("day").cast("string"), "n").collect()
    assert sorted(map(tuple, rows)) == [("2024-01-01", 1), ("2024-01-02", 5)]


def test_a_repeated_delivery_replaces_itself(spark, space):
    batch = spark.createDataFrame(day_rows(0) + day_rows(1), EVENT)
    for delivery in ("a", "a", "b"):
        store.append_events(batch if delivery == "a" else batch.limit(5), f"{space}/events", ts="ts", delivery=delivery)
    assert store.read_events(spark, f"{space}/events").groupBy("delivery").count().orderBy("delivery").collect() == [("a", 60), ("b", 5)]
    letters = spark.createDataFrame([(1, "e1", "no user", "blank_user_id", "{}", START), (2, None, None, None, "", None)], schema.DEAD_LETTER_COLUMNS)
    assert store.read_dead_letters(spark, f"{space}/dead").count() == 0
    for batch_id in (0, 0, 1):
        store.append_dead_letters(letters, f"{space}/dead", batch_id)
    assert sorted(r.id for r in store.read_dead_letters(spark, f"{space}/dead").collect()) == [1, 1, 2, 2]
    store.append_dead_letters(letters.limit(1), f"{space}/dead", 1)
    assert store.read_dead_letters(spark, f"{space}/dead").count() == 3


def test_store_prunes_and_expires_days(spark, space):
    whole = spark.createDataFrame([r for d in range(3) for r in day_rows(d)], EVENT)
    store.append_events(whole, f"{space}/events", ts="ts")
    one_day = store.read_events(spark, f"{space}/events").where("event_date = DATE'2024-01-02'")
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and one_day.count() == 30
    assert store.drop_expired(spark, f"{space}/events", "2024-01-02") == ["event_date=2024-01-01"]
    assert store.read_events(spark, f"{space}/events").count() == 60


def test_lookups_reach_the_scan(spark, folder):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    events = spark.read.parquet(f"{folder}/events.parquet")
    found = lookup.find_events(events, user_id=7, start=START, event_types=("click",)).select("event_id")
    plan = found._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :]
    for text in ("EqualTo(user_id,7)", "GreaterThanOrEqual(ts,2024-01-01", "EqualTo(event_type,click)"):
        assert text in pushed
    assert "props" not in plan


def test_topic_options():
    written = kafka.write_options("broker:9092", "user-events")
    assert written["kafka.acks"] == "all" and written["kafka.retries"] == "3"
    assert written["kafka.compression.type"] == "snappy" and written["kafka.max.request.size"] == "1000000"
    read = kafka.read_options("broker:9092", "user-events", group="g", per_trigger=5)
    assert read["startingOffsets"] == "earliest" and read["maxOffsetsPerTrigger"] == "5"


def test_peek_reads_a_few(spark):
    assert kafka.peek(spark.range(100)).count() == 5


def test_stream_attribution_is_exact(spark, space):
    """Clicks of the purchase's own minute and of the minute at the far end count; nobody is left out."""
    day = timedelta(days=1)
    at = START + timedelta(hours=30, seconds=30)
    clicks = [
        (1, 1, at - timedelta(seconds=2)), (2, 1, at - day), (3, 1, at - day + timedelta(seconds=1)),
        (4, 1, at - timedelta(minutes=7)), (5, 1, at - timedelta(minutes=7, seconds=3)), (6, 1, at + timedelta(seconds=1)),
        (7, 2, at - day - timedelta(seconds=1)), (8, 3, at), (9, 9, at + timedelta(hours=4)),
    ]
    bought = [(100, 1, at), (101, 2, at), (102, 3, at), (103, 4, at), (104, 1, at.replace(second=0)), (109, 9, at + timedelta(hours=4))]
    rows = [(i, u, t, "click", 1.0) for i, u, t in clicks] + [(i, u, t, "purchase", 1.0) for i, u, t in bought]
    arrive(spark, f"{space}/in", *[[r for r in rows if (r[2] < at - timedelta(hours=1)) == first] for first in (True, False)])
    source = stream(spark, f"{space}/in")
    parts = joins.clicks_before_purchases(source.where("event_type = 'click'"), source.where("event_type = 'purchase'"), "1 hour", "24 hours")
    with_settings = runs.append_files(parts, f"{space}/out", f"{space}/checkpoint")
    run = runs.run_available(with_settings, state_partitions=2)
    assert runs.watermark_of(run).startswith("2024-01-02T09:00:30")
    found = joins.attributed(spark.read.schema(parts.schema).parquet(f"{space}/out")).collect()
    got = {r.purchase_id: (r.click_id, r.clicks_in_reach) for r in found}
    assert got == {100: (1, 4), 101: (None, 0), 102: (8, 1), 103: (None, 0), 104: (4, 4), 109: (9, 1)}


HISTORY_EVENT = EVENT + ", country string"


def history_rows(count, seed):
    rng = random.Random(seed)
    at = START
    rows = []
    for i in range(count):
        # Some events share a time.
        at += timedelta(minutes=rng.choice([0, 5, 45, 200]))
        rows.append((i, rng.choice([1, 1, 1, 2, 3]), at, rng.choice(["purchase", "purchase", "click"]), 1.0, rng.choice(["IN", "IN", "US", None])))
    return rows


def history_plainly(rows):
    out = {}
    for i, user, at, kind, _, _ in rows:
        before = [r for r in rows if r[1] == user and (r[2], r[0]) < (at, i)]
        places = Counter(r[5] for r in before if r[5] is not None)
        home = min(places, key=lambda c: (-places[c], c), default=None)
        near = [r for r in rows if r[1] == user and r[3] == "purchase" and at - timedelta(hours=24) <= r[2] <= at]
        same_hour = sum(r[2].hour == at.hour for r in before) + 1
        out[i] = (len(near) if kind == "purchase" else None, same_hour, len(before) + 1, len(before), home)
    return out


def test_history_over_batches_and_a_restart(spark, space):
    rows = history_rows(240, 3)
    # Batches break where the time moves on, so that events of one time are in one batch.
    edges = [i for i in range(1, len(rows)) if rows[i][2] > rows[i - 1][2]][30::40] + [len(rows)]
    batches = [rows[a:b] for a, b in zip([0, *edges[:-1]], edges)]
    assert len(batches) >= 4

    def run_on(some):
        for part in some:
            spark.createDataFrame(part, HISTORY_EVENT).coalesce(1).write.mode("append").parquet(f"{space}/in")
        source = spark.readStream.schema(HISTORY_EVENT).option("maxFilesPerTrigger", 1).parquet(f"{space}/in")
        known = state.with_history(source, "24 hours", keep=("event_type",))
        runs.run_available(runs.append_files(known, f"{space}/out", f"{space}/checkpoint"), state_partitions=2)
        return known

    run_on(batches[:2])
    known = run_on(batches[2:])
    found = spark.read.schema(known.schema).parquet(f"{space}/out").collect()
    got = {r.event_id: (r.rapid, r.hour_events, r.user_events, r.earlier_events, r.home_country) for r in found}
    assert len(found) == len(rows) and got == history_plainly(rows)


def test_history_of_silent_users_is_forgotten(spark, space):
    day = timedelta(days=1)
    days = [
        [(0, 1, START, "purchase", 1.0, "IN"), (1, 2, START, "purchase", 1.0, "IN"), (2, 1, None, "click", 1.0, "IN")],
        [(3, 2, START + 2 * day, "purchase", 1.0, "IN")],
        [(4, 2, START + 7 * day, "purchase", 1.0, "IN")],
        [(5, 2, START + 8 * day, "purchase", 1.0, "IN")],
        [(6, 1, START + 9 * day, "purchase", 1.0, "US"), (7, 2, START + 9 * day, "purchase", 1.0, "IN")],
    ]
    for part in days:
        spark.createDataFrame(part, HISTORY_EVENT).coalesce(1).write.mode("append").parquet(f"{space}/in")
    source = spark.readStream.schema(HISTORY_EVENT).option("maxFilesPerTrigger", 1).parquet(f"{space}/in")
    known = state.with_history(source, "1 hour", "24 hours", "6 days")
    runs.run_available(runs.append_files(known, f"{space}/out", f"{space}/checkpoint"), state_partitions=2)
    found = spark.read.schema(known.schema).parquet(f"{space}/out").collect()
    got = {r.event_id: (r.rapid, r.user_events, r.home_country) for r in found}
    assert got[2] == (None, None, None) or got[2] == (None, None, "IN")
    assert got[6] == (1, 1, None)
    assert got[7] == (2, 5, "IN")


def test_a_bucket_of_histories_takes_many_users(spark):
    """One block of results per bucket and a few calls of the state per user; one timer finds the silent users."""
    hour, columns = 3_600_000_000, ["event_id", "country", *state.HISTORY_COLUMNS]
    kept, processor = KeptMap(), state.UserHistory(24 * hour, 48 * hour, columns)
    processor.init(kept)

    def known(watermark, *parts):
        """Events (user, hour); the later of a user comes first."""
        kept.calls = 0
        frames = [
            pd.DataFrame([(f"{u}-{h}", u, h * hour, h % 24, "IN" if h % 2 else "US", True) for u, h in part], columns=["event_id", "user_key", "at_us", "hour", "country", "is_purchase"])
            for part in parts
        ]
        blocks = list(processor.handleInputRows((1,), iter(frames), TimerValues(0, watermark)))
        assert len(blocks) == 1
        return {r[0]: r[2:] for r in blocks[0].itertuples(index=False, name=None)}

    users = [f"u{i}" for i in range(300)]
    found = known(0, [(u, 31) for u in users], [(u, 7) for u in users] + [("gone", 1)])
    assert kept.calls <= 301 + 2 and kept.timers == [49 * 3_600_000 + 1]
    assert all(found[f"{u}-7"] == (1, 1, 1, 0, None) and found[f"{u}-31"] == (2, 2, 2, 1, "IN") for u in users)
    found = known(30 * 3_600_000, [(u, 32) for u in users])
    assert kept.calls <= 300 * 3 + 2 and len(kept.timers) == 1
    assert all(found[f"{u}-32"] == (2, 1, 3, 2, "IN") for u in users)
    # Who has been silent for 48 hours is new once the timer has come; it comes for the first of the others then.
    del kept.timers[:]
    list(processor.handleExpiredTimer((1,), TimerValues(0, 50 * 3_600_000), ExpiredTimerInfo(49 * 3_600_000 + 1)))
    assert set(kept.kept) == {(u,) for u in users} and kept.timers == [80 * 3_600_000 + 1]
    assert known(50 * 3_600_000, [("gone", 51)])["gone-51"] == (1, 1, 1, 0, None)
    del kept.timers[:]
    list(processor.handleExpiredTimer((1,), TimerValues(0, 82 * 3_600_000), ExpiredTimerInfo(80 * 3_600_000 + 1)))
    assert list(kept.kept) == [("gone",)] and kept.timers == [99 * 3_600_000 + 1]
    # A user whose events lie before those of all others is the first to be forgotten.
    known(82 * 3_600_000, [("early", 48)])
    assert kept.timers == [96 * 3_600_000 + 1]


def test_history_with_missing_users_and_ids(spark, space):
    rows = [(None if i % 11 == 3 else i, None if i % 5 == 0 else 2**60 + i % 3, START + timedelta(minutes=10 * i), "purchase", 1.0, "IN") for i in range(60)]
    rows += [(100, 2**60, None, "purchase", 1.0, "IN"), (101, None, None, "click", 1.0, None)]
    for part in (rows[:20], rows[20:]):
        spark.createDataFrame(part, HISTORY_EVENT).coalesce(1).write.mode("append").parquet(f"{space}/in")
    source = spark.readStream.schema(HISTORY_EVENT).option("maxFilesPerTrigger", 1).parquet(f"{space}/in")
    known = state.with_history(source, "24 hours")
    assert known.columns == ["event_id", "user_id", "country", *state.HISTORY_COLUMNS]
    runs.run_available(runs.append_files(known, f"{space}/out", f"{space}/checkpoint"), state_partitions=2)
    found = spark.read.schema(known.schema).parquet(f"{space}/out").collect()
    for user in (None, 2**60, 2**60 + 1, 2**60 + 2):
        own = sorted((r.user_events, r.rapid, r.earlier_events) for r in found if r.user_id == user and r.user_events is not None)
        assert own == [(n + 1, n + 1, n) for n in range(sum(r[1] == user and r[2] is not None for r in rows))] and own
    assert sorted((r.event_id, r.user_events, r.rapid) for r in found if r.event_id in (100, 101)) == [(100, None, None), (101, None, None)]


def files_below(path):
    return sum(name.endswith(".parquet") for _, _, names in os.walk(path) for name in names)


def test_id_index_finds_all_stored_ids_in_bounded_files(spark, space):
    index = IdIndex(spark, f"{space}/ids", buckets=4)
    ids = lambda low, high: spark.range(low, high).select(F.concat(F.lit("e"), F.col("id")).alias("event_id"), F.lit(1).alias("x"))
    opened = []
    for batch in range(11):
        df = ids(100 * batch, 100 * batch + 150)
        fresh = index.without_stored(df, batch)
        assert sorted(r.event_id for r in fresh.collect()) == sorted(f"e{i}" for i in range(100 * batch + (50 if batch else 0), 100 * batch + 150))
        index.add(fresh, batch)
        entries = index.table.state().entries
        assert sum(e["rows"] for e in entries) == 100 * batch + 150
        opened.append(sum(files_below(e["folder"]) + files_below(e["filter"]) for e in entries))
    # Folders are merged: one merged and eight waiting at most, each with four buckets and a filter.
    assert max(opened) <= 9 * 5 and opened[-1] < 9 * 5
    # New ids seldom pass the filters, stored ids always do.
    assert index.suspects(ids(0, 1150), entries).count() == 1150
    assert index.suspects(ids(10_000, 12_000), entries).count() < 2000 * 0.5
    odd = spark.createDataFrame([(None, 1), ("e7", 1), ("new", 1)], "event_id string, x int")
    assert sorted((r.event_id or "") for r in index.without_stored(odd, 99).collect()) == ["", "new"]


def test_users_are_compacted_inside_the_run(spark, space):
    arrive(spark, f"{space}/in", *[day_rows(d, 9) for d in range(8)])
    handle = tables.upsert_users(f"{space}/events", f"{space}/users", least=3)
    runs.run_available(runs.per_batch(stream(spark, f"{space}/in"), handle, f"{space}/checkpoint"))
    state = LogTable(spark, f"{space}/users").state()
    assert len(state.merged) == 1 and len(state.batches) <= 4
    expected = sorted(metrics.user_rollup(spark.createDataFrame([r for d in range(8) for r in day_rows(d, 9)], EVENT)).collect())
    assert sorted(tables.read_users(spark, f"{space}/users").collect()) == expected


def test_log_table_keeps_concurrent_commits_and_survives_failures(spark, space):
    table = LogTable(spark, f"{space}/t")
    for batch in range(4):
        table.put(batch, {"folder": f"b{batch}"})

    def failing(entries):
        raise OSError("disk full")

    with pytest.raises(OSError, match="disk full"):
        table.compact(failing, 1)
    assert len(table.state().batches) == 4 and table.state().merged == []

    def slow(entries):
        # Meanwhile the stream commits its next batch.
        table.put(4, {"folder": "b4"})
        return {"folder": "m0"}

    assert table.compact(slow, 1)
    state = table.state()
    assert [e["folder"] for e in state.entries] == ["m0", "b3", "b4"]

    def beaten(entries):
        # Another compaction comes first: this one must not bring merged batches back.
        table.commit(lambda s: State({k: v for k, v in s.batches.items() if v["folder"] == "b4"}, [{"folder": "m1"}]))
        return {"folder": "m2"}

    assert not table.compact(beaten, 1)
    assert [e["folder"] for e in table.state().entries] == ["m1", "b4"]


def test_changes_of_a_later_run_win(spark, space):
    schema = "user_id int, total int"
    early, late = "run-z", "run-a"
    for run, batch, total in ((early, 7, 500), (late, 0, 3)):
        spark.sparkContext.setLocalProperty("sql.streaming.queryId", run)
        try:
            tables.keep_changes(f"{space}/out")(spark.createDataFrame([(1, total)], schema), batch)
        finally:
            spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)
    assert [r.total for r in tables.latest_changes(spark, f"{space}/out", "user_id").collect()] == [3]


def test_topics_of_a_batch_appear_together(spark, space):
    rows = [("user-events", "a"), ("user-anomalies", "b" * 30), ("user-analytics", "c"), ("user-events", None)]
    routed = spark.createDataFrame(rows, "topic string, body string")
    messages = store.outgoing(routed, F.col("body"), limit=10)
    store.write_topics(messages, f"{space}/topics", 0)
    store.write_topics(messages, f"{space}/topics", 1)
    # The last batch again, as after a failure; then one that fails before its commit.
    store.write_topics(messages, f"{space}/topics", 1)
    spark.range(3).select(F.lit("lost").alias("value"), F.lit("user-events").alias("topic")).write.partitionBy("topic").parquet(
        LogTable(spark, f"{space}/topics").new_folder()
    )
    counts = {r.topic: r["count"] for r in store.read_topics(spark, f"{space}/topics").groupBy("topic").count().collect()}
    assert counts == {"user-events": 4, "user-analytics": 2, store.FAILED: 2}
    one = store.read_topics(spark, f"{space}/topics").where("topic = 'user-analytics'")
    assert "PartitionFilters: [isnotnull(topic" in one._jdf.queryExecution().executedPlan().toString()
    assert store.read_topics(spark, f"{space}/none").count() == 0


def test_time_bounds_prune_stored_days(spark, space):
    whole = spark.createDataFrame([r for d in range(6) for r in day_rows(d)], EVENT)
    store.append_events(whole, f"{space}/events", ts="ts")
    events = store.read_events(spark, f"{space}/events")
    found = lookup.find_events(events, start=START + timedelta(days=1, hours=2), end=START + timedelta(days=3))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    rows = [r for d in range(6) for r in day_rows(d)]
    assert found.count() == sum(START + timedelta(days=1, hours=2) <= r[2] < START + timedelta(days=3) for r in rows)
    assert {r.event_date.day for r in found.select("event_date").distinct().collect()} == {2, 3}
    newest = max(r[2] for r in rows)
    kept = lookup.retained(events, "30 hours")
    assert sorted(r.event_id for r in kept.collect()) == sorted(r[0] for r in rows if r[2] >= newest - timedelta(hours=30))
    scans = [part.split("]")[0] for part in kept._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1:]]
    assert any("event_date" in s and "Subquery" in s for s in scans)


def test_redelivered_batches_are_stored_once(spark, space):
    df = spark.createDataFrame(day_rows(0), EVENT)
    for delivery in (0, 1, 1):
        tables.append_once(df, delivery, f"{space}/events")
    assert spark.read.parquet(f"{space}/events").count() == 30


def test_users_follow_their_newest_country(spark, space):
    """Country and metadata come from the newest event that has them, also if it arrives first."""
    schema = EVENT + ", country string, metadata string"
    days = [
        [(1, 1, START + timedelta(hours=9), "click", 1.0, "US", "new"), (2, 2, START, "click", 1.0, None, None)],
        [(3, 1, START, "click", 1.0, "IN", "old"), (4, 1, START + timedelta(hours=10), "click", 1.0, None, "newest")],
    ]
    for part in days:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{space}/in")
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{space}/in")
    handle = tables.upsert_users(f"{space}/events", f"{space}/users")
    runs.run_available(runs.per_batch(source, handle, f"{space}/checkpoint"))
    found = {r.user_id: (r.total_events, r.country, r.metadata) for r in tables.read_users(spark, f"{space}/users").collect()}
    assert found == {1: (3, "US", "newest"), 2: (1, None, None)}
