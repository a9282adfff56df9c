"""Chunked per-user computations, sessions and ranks against plain Python."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from eventloom.operators import attribution, ordered, ranking, timewindows

START = datetime(2024, 1, 1, 23, 0)


def sample(count: int, seed: int):
    """Events on a coarse grid with ties; user 1 owns about a third of them."""
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        user = 1 if rng.random() < 0.35 else rng.randint(2, 9)
        at = START + timedelta(minutes=10 * rng.randint(0, 400))
        rows.append((i, user, at, rng.choice(["click", "purchase"]), rng.randint(1, 50)))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "event_id int, user_id int, ts timestamp_ntz, event_type string, value int")


@pytest.fixture(scope="module")
def rows():
    return sample(900, 5)


@pytest.mark.parametrize("chunk", [2_000_000, 60, 1])
def test_gaps_and_running_totals(spark, rows, chunk):
    df = frame(spark, rows)
    gaps = {r.event_id: r.previous_ts for r in ordered.previous_time(df, "user_id", "ts", "event_id", chunk).collect()}
    totals = ordered.running_total(df, "user_id", "ts", "event_id", F.col("value"), "total", chunk)
    sums = {r.event_id: r.total for r in totals.collect()}
    last, total = {}, {}
    for event, user, at, _, value in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        assert gaps[event] == last.get(user)
        total[user] = total.get(user, 0) + value
        assert sums[event] == total[user]
        last[user] = at
    assert len(gaps) == len(sums) == len(rows)


@pytest.mark.parametrize("chunk", [2_000_000, 40, 1])
def test_trailing_count(spark, rows, chunk):
    counted = ordered.trailing_count(frame(spark, rows), "user_id", "ts", "6 hours", "n", chunk).collect()
    assert len(counted) == len(rows)
    for r in counted:
        near = [x for x in rows if x[1] == r.user_id and r.ts - timedelta(hours=6) <= x[2] <= r.ts]
        assert r.n == len(near)


@pytest.mark.parametrize("chunk", [2_000_000, 1])
def test_rows_without_user_or_time_stay(spark, chunk):
    made = [(i, u, None if m is None else START + timedelta(minutes=m), kind, 1 + i) for i, (u, m, kind) in enumerate([
        (1, 0, "click"), (1, 5, "purchase"), (1, None, "purchase"), (1, None, "click"),
        (None, 0, "click"), (None, 7, "purchase"), (None, None, "purchase"), (2, None, "purchase"),
    ])]
    df = frame(spark, made)
    df.createOrReplaceTempView("incomplete")
    expected = spark.sql(
        """SELECT event_id, lag(ts) OVER o AS previous_ts, sum(value) OVER o AS total FROM incomplete
        WINDOW o AS (PARTITION BY user_id ORDER BY ts NULLS LAST, event_id)"""
    )
    gaps = ordered.previous_time(df, "user_id", "ts", "event_id", chunk).select("event_id", "previous_ts")
    totals = ordered.running_total(df, "user_id", "ts", "event_id", F.col("value"), "total", chunk).select("event_id", "total")
    assert sorted(gaps.collect(), key=lambda r: r.event_id) == sorted(expected.select("event_id", "previous_ts").collect(), key=lambda r: r.event_id)
    assert sorted(totals.collect()) == sorted(expected.select("event_id", "total").collect())
    counted = ordered.trailing_count(df, "user_id", "ts", "6 minutes", "n", chunk)
    assert sorted((r.event_id, r.n) for r in counted.collect()) == [(0, 1), (1, 2), (2, 2), (3, 2), (4, 1), (5, 1), (6, 1), (7, 1)]
    clicks, purchases = df.where("event_type = 'click'"), df.where("event_type = 'purchase'")
    found = attribution.last_touch(clicks, purchases, "3 hours", chunk).collect()
    assert sorted((r.purchase_id, r.click_id, r.clicks_in_reach) for r in found) == [(1, 0, 1), (2, None, 0), (5, None, 0), (6, None, 0), (7, None, 0)]


def test_third_of_three_rapid_purchases(spark):
    rows = [(i, 1, START + timedelta(seconds=30 * i), "purchase", 1) for i in range(3)]
    counted = ordered.trailing_count(frame(spark, rows), "user_id", "ts", "60 seconds", "n").orderBy("ts").collect()
    assert [r.n for r in counted] == [1, 2, 3]


@pytest.mark.parametrize("chunk", [2_000_000, 70, 1])
def test_last_touch(spark, rows, chunk):
    df = frame(spark, rows)
    clicks, purchases = df.where("event_type = 'click'"), df.where("event_type = 'purchase'")
    found = attribution.last_touch(clicks, purchases, "3 hours", chunk).collect()
    assert len(found) == purchases.count()
    for r in found:
        near = [
            (x[2], x[0])
            for x in rows
            if x[3] == "click" and x[1] == r.user_id and r.purchase_ts - timedelta(hours=3) < x[2] <= r.purchase_ts
        ]
        assert r.clicks_in_reach == len(near)
        assert (r.click_ts, r.click_id) == (max(near) if near else (None, None))


def test_chunks_fit_each_key_and_month(spark):
    """A hot user's month is cut by its own counts, other users and its quiet months stay whole."""
    hot = [(i, 1, datetime(2024, 1, 31, 20) + timedelta(seconds=20 * i), "click", 1) for i in range(1000)]
    burst = [(2000 + i, 3, datetime(2024, 3, 5, 12, 0, 7), "click", 1) for i in range(500)]
    calm = [(3000 + i, 2, datetime(2024, 1, 1) + timedelta(days=i), "click", 1) for i in range(60)]
    df = frame(spark, hot + burst + calm)
    placed = ordered.carried_in(df, "user_id", "ts", {"_rows": F.lit(1)}, {}, max_rows=150)
    chunks = {}
    for r in placed.collect():
        chunks.setdefault((r.user_id, r["_month"] % 12), {}).setdefault(r["_chunk"], []).append(r["_rows"] or 0)
    assert {k: len(v) for k, v in chunks.items()} == {(1, 1): 4, (1, 2): 2, (3, 3): 1, (2, 1): 1, (2, 2): 1}
    assert all(len(rows) < 150 + 180 for rows in chunks[1, 1].values())
    before = 0
    for month in (1, 2):
        for _, rows in sorted(chunks[1, month].items()):
            assert set(rows) == {before}
            before += len(rows)
    totals = ordered.running_total(df, "user_id", "ts", "event_id", F.col("value"), "total", 150)
    assert sorted(r.total for r in totals.where("user_id = 3").collect()) == list(range(1, 501))


def test_ordered_plans_run_nothing_early(spark, rows):
    """Planning starts no job, and rows are shuffled once between the source and the row-level window."""
    df = frame(spark, rows)
    jobs = lambda: max(spark.sparkContext.statusTracker().getJobIdsForGroup(None), default=-1)
    before = jobs()
    gaps = ordered.previous_time(df, "user_id", "ts", "event_id")
    gaps._jdf.queryExecution().executedPlan()
    assert jobs() == before
    plan = gaps._jdf.queryExecution().executedPlan().toString()
    above_join = plan[plan.index("Window") : plan.index("SortMergeJoin")] if "SortMergeJoin" in plan else ""
    assert "Exchange" not in above_join


def test_gap_sessions_break_only_beyond_the_gap(spark):
    minutes = [0, 30, 60, 91, 200, 229, 258]
    rows = [(i, 1, START + timedelta(minutes=m), "click", 1) for i, m in enumerate(minutes)]
    sessions = timewindows.gap_sessions(frame(spark, rows), "30 minutes").orderBy("session_start").collect()
    assert [r.n for r in sessions] == [3, 1, 3]
    assert sessions[0].session_end == START + timedelta(minutes=90)


def test_gap_sessions_match_brute_force(spark, rows):
    sessions = timewindows.gap_sessions(frame(spark, rows), "45 minutes").collect()
    expected = []
    for user in {r[1] for r in rows}:
        times = sorted(r[2] for r in rows if r[1] == user)
        begin, previous, n = times[0], times[0], 0
        for at in times:
            if at - previous > timedelta(minutes=45):
                expected.append((user, begin, previous, n))
                begin, n = at, 0
            previous, n = at, n + 1
        expected.append((user, begin, previous, n))
    assert sorted((r.user_id, r.session_start, r.last_event, r.n) for r in sessions) == sorted(expected)


def session(spark, size: int):
    types = ["login", *["page_view"] * max(size - 2, 0), *(["logout"] if size > 1 else [])][:size]
    rows = [("s1", f"e{i:02d}", START + timedelta(minutes=5 * i), kind) for i, kind in enumerate(types)]
    return spark.createDataFrame(rows, "session_id string, event_id string, timestamp timestamp, event_type string")


def test_session_shapes(spark):
    full = timewindows.session_shape(session(spark, 20)).first()
    assert (full.n, full.opens_with_login, full.closes_with_logout) == (20, True, True)
    single = timewindows.session_shape(session(spark, 1)).first()
    assert (single.n, single.opens_with_login, single.closes_with_logout) == (1, True, False)
    assert timewindows.session_shape(session(spark, 0)).count() == 0
    one = timewindows.gap_sessions(session(spark, 20), "30 minutes", key="session_id", ts="timestamp")
    assert one.count() == 1
    gaps = ordered.previous_time(session(spark, 20), "session_id", "timestamp", "event_id")
    assert {r.gap_seconds for r in gaps.where("previous_ts IS NOT NULL").collect()} == {300.0}


def test_timeline_is_in_order(spark):
    shuffled = session(spark, 20).orderBy(F.rand(3))
    times = [r.timestamp for r in timewindows.timeline(shuffled).collect()]
    assert times == sorted(times)


@pytest.mark.parametrize("slices", [1, 7, 200])
def test_ranks_over_all_rows(spark, slices):
    rng = random.Random(2)
    values = [(i, rng.choice([0, 0, 0, 1, 2, 5, rng.randint(0, 1000)])) for i in range(600)]
    df = spark.createDataFrame(values, "user_id int, spent int")
    df.createOrReplaceTempView("spending")
    expected = spark.sql(
        """SELECT user_id, rank() OVER o AS rank, dense_rank() OVER o AS dense_rank, percent_rank() OVER o AS percent_rank,
            cast(ceil(cume_dist() OVER o * 4) AS int) AS quartile FROM spending WINDOW o AS (ORDER BY spent DESC)"""
    )
    ranked = ranking.rank_all(df, "spent", slices).select(expected.columns)
    assert sorted(ranked.collect()) == sorted(expected.collect())


def test_rank_of_nothing_and_of_a_single_row(spark):
    assert ranking.rank_all(spark.createDataFrame([], "user_id int, spent int"), "spent").count() == 0
    row = ranking.rank_all(spark.createDataFrame([(1, 5)], "user_id int, spent int"), "spent").first()
    assert (row.rank, row.dense_rank, row.percent_rank, row.quartile) == (1, 1, 0.0, 4)


def test_ranks_of_rows_without_a_value(spark):
    values = [(1, 5.0), (2, None), (3, 7.5), (4, None), (5, 5.0), (6, float("nan"))]
    df = spark.createDataFrame(values, "user_id int, spent double")
    order = Window.orderBy(F.desc("spent"))
    share = F.ceil(F.cume_dist().over(order) * 4).cast("int")
    expected = df.select("user_id", F.rank().over(order).alias("rank"), F.dense_rank().over(order).alias("dense_rank"), F.percent_rank().over(order).alias("percent_rank"), share.alias("quartile"))
    for slices in (1, 3, 200):
        found = ranking.rank_all(df, "spent", slices).select(expected.columns)
        assert sorted(found.collect()) == sorted(expected.collect())


def test_out_of_order_rows_are_seen(spark):
    shuffled = session(spark, 20).orderBy(F.rand(3)).persist()
    assert timewindows.out_of_order(shuffled).first().out_of_order > 0
    assert timewindows.out_of_order(timewindows.timeline(shuffled)).first().out_of_order == 0
