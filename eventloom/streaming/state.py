"""State per user that built-in streaming aggregates cannot hold.

``with_history`` keeps what the rules on single events need to know of a user's past: events per hour of day and per
country, and the purchases of the last day. ``running_totals`` keeps plain sums, for which the
built-in aggregate in update mode is the first choice; its state is kept per user and shard, so
that the events of a hot user are spread over several tasks, and the shards are added up when read.
Both processors take a bucket of users at a time and keep an entry per user.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# Send the processor by value, so that executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATE = "events bigint, purchases bigint, cents bigint, first_us bigint, last_us bigint"
NO_TIME = -(2**63)

#: Users are hashed to this many groups. A call of the processor and a result block cost about a millisecond however few
#: rows they hold, so a group takes many users; a group is also what tasks share out, so there are many groups.
BUCKETS = 1024


class RunningTotals(StatefulProcessor):
    """Counts, spending in cents and first and last time per user, for the users of one bucket and shard.

    Each user has an entry of its own in the state, and only users with new events are read and written.
    """

    def __init__(self, shards: int):
        self._shards = shards

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._totals = handle.getMapState("totals", "user string", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        totals = {}
        for part in rows:
            for user, *sums in sums_per_user(part):
                totals[user] = added(totals[user], sums) if user in totals else sums
        stored = self._totals.exists()
        for user, sums in totals.items():
            before = self._totals.getValue((user,)) if stored and self._totals.containsKey((user,)) else None
            if before is not None:
                totals[user] = added(before, sums)
            self._totals.updateValue((user,), tuple(totals[user]))
        columns = ["user", "shard", *[c.split()[0] for c in STATE.split(", ")]]
        result = pd.DataFrame([(user, key[0] % self._shards, *sums) for user, sums in totals.items()], columns=columns)
        yield result.astype({"first_us": "Int64", "last_us": "Int64"})

    def close(self) -> None:
        pass


def sums_per_user(part: pd.DataFrame) -> Iterator[tuple]:
    """(user, events, purchases, cents, first time, last time) of the rows of a part."""
    codes, users = pd.factorize(part["user"], use_na_sentinel=False)
    at, cents = part["at_us"].to_numpy(), part["cents"].to_numpy()
    count = len(users)
    purchases, spent = np.zeros(count, np.int64), np.zeros(count, np.int64)
    first, last = np.full(count, 2**63 - 1), np.full(count, NO_TIME)
    np.add.at(purchases, codes, part["is_purchase"].to_numpy(np.int64))
    np.add.at(spent, codes, cents)
    timed = at > NO_TIME
    np.minimum.at(first, codes[timed], at[timed])
    np.maximum.at(last, codes[timed], at[timed])
    events = np.bincount(codes, minlength=count)
    for user, *sums, low, high in zip(*[c.tolist() for c in (users, events, purchases, spent, first, last)], strict=True):
        yield user if isinstance(user, str) else None, *sums, *((None, None) if high == NO_TIME else (low, high))


def added(a: Sequence, b: Sequence) -> list:
    """Totals of two sets of rows."""
    times = [fold((x, y)) if None not in (x, y) else x if y is None else y for fold, x, y in ((min, a[3], b[3]), (max, a[4], b[4]))]
    return [a[0] + b[0], a[1] + b[1], a[2] + b[2], *times]


def running_totals(df: DataFrame, shards: int = 4) -> DataFrame:
    """Updated totals per user and shard for every batch; ``df`` has the event columns."""
    is_purchase = F.coalesce(F.col("event_type") == "purchase", F.lit(False))
    cents = F.when(is_purchase, F.round(F.col("value") * 100)).otherwise(0).cast("bigint")
    shard = F.pmod(F.xxhash64("event_id"), F.lit(shards))
    prepared = df.select(
        (F.pmod(F.xxhash64("user_id"), F.lit(BUCKETS)) * shards + shard).cast("int").alias("part"),
        # As text, a missing id among the rows leaves the others exact.
        F.col("user_id").cast("string").alias("user"),
        F.coalesce(F.unix_micros(F.col("ts").cast("timestamp")), F.lit(NO_TIME)).alias("at_us"),
        is_purchase.alias("is_purchase"),
        F.coalesce(cents, F.lit(0)).alias("cents"),
    )
    totals = prepared.groupBy("part").transformWithStateInPandas(
        RunningTotals(shards), f"user string, shard int, {STATE}", outputMode="Update", timeMode="None"
    )
    return totals.withColumn("user", F.col("user").cast(df.schema["user_id"].dataType)).withColumnRenamed("user", "user_id")


def combined(latest: DataFrame) -> DataFrame:
    """Shards of a user added up."""
    return latest.groupBy("user_id").agg(
        F.timestamp_micros(F.min("first_us")).alias("first_seen"),
        F.timestamp_micros(F.max("last_us")).alias("last_seen"),
        F.sum("events").alias("total_events"),
        F.sum("purchases").alias("total_purchases"),
        (F.sum("cents") / F.lit(100).cast("decimal(3,0)")).cast("decimal(25,2)").alias("total_spent"),
    )


HISTORY = "rapid bigint, hour_events bigint, user_events bigint, earlier_events bigint, home_country string"
HISTORY_COLUMNS = [c.split()[0] for c in HISTORY.split(", ")]


#: Events in time, the newest of them, events per hour of day and per country, and times of purchases still in reach.
PAST = "n bigint, newest_us bigint, hours array<bigint>, countries map<string, bigint>, bought array<bigint>"

#: As ``BUCKETS``, for histories: more, since a task holds a batch of a bucket's events.
HISTORY_BUCKETS = 8192


class UserHistory(StatefulProcessor):
    """What the users of a bucket did so far, and for each new event what was known of its user up to it.

    Events of a batch are taken in order of time and id. Each user has an entry of its own in the state (``PAST``), and only
    users with new events are read and written. A timer on event time, one per bucket and no later than the first of its
    users has been silent for ``forget_us``, drops the histories of such users.
    """

    def __init__(self, horizon_us: int, forget_us: int, columns: list[str]):
        self._horizon, self._forget, self._columns = horizon_us, forget_us, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._past = handle.getMapState("past", "user string", PAST)

    def _end(self, newest: int) -> int:
        """When a user with this newest event has been silent for too long, in milliseconds."""
        return (newest + self._forget) // 1000 + 1

    def _wake_by(self, end: int, timers: list[int]) -> None:
        """See to it that the bucket's timer comes no later than this."""
        if timers and timers[0] <= end:
            return
        for timer in timers:
            self._handle.deleteTimer(timer)
        self._handle.registerTimer(end)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts = list(rows)
        part = parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)
        users, starts, order = in_order(part)
        ordered = {c: part[c].array.take(order) for c in {*self._columns[: -len(HISTORY_COLUMNS)], "at_us", "hour", "is_purchase"}}
        at, country, hour = np.asarray(ordered["at_us"]), ordered["country"].tolist(), ordered["hour"].tolist()
        timed = at > NO_TIME
        bought = timed & np.asarray(ordered["is_purchase"], bool)
        within, earlier, in_hour, homes = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64), [], []
        stored, ends = self._past.exists(), []
        for user, start, end in zip(users, starts, [*starts[1:], len(at)], strict=True):
            seen, newest, hours, places, reach = self._past.getValue((user,)) if stored and self._past.containsKey((user,)) else NOTHING
            hours, places = list(hours), dict(places)
            home = min(places, key=lambda c: (-places[c], c), default=None)
            # Events without a time come first: they carry no history and leave none.
            first = start + int(np.count_nonzero(~timed[start:end]))
            earlier[start:first], earlier[first:end] = seen, np.arange(seen, seen + end - first)
            in_hour += [0] * (first - start)
            homes += [home] * (first - start)
            if first == end:
                continue
            for h, c in zip(hour[first:end], country[first:end], strict=True):
                hours[h] += 1
                in_hour.append(hours[h])
                homes.append(home)
                if c is not None:
                    places[c] = places.get(c, 0) + 1
                    if home is None or (-places[c], c) < (-places[home], home):
                        home = c
            times = at[first:end]
            purchases = np.sort(np.concatenate([np.array(reach, np.int64), times[bought[first:end]]]))
            low = np.searchsorted(purchases, times - self._horizon, "left")
            within[first:end] = np.searchsorted(purchases, times, "right") - low
            newest = max(newest, int(times[-1]))
            reach = purchases[purchases >= newest - self._horizon].tolist()
            self._past.updateValue((user,), (seen + end - first, newest, hours, places, reach))
            ends.append(self._end(newest))
        if ends:
            self._wake_by(min(ends), list(self._handle.listTimers()) if stored else [])
        known = {
            "rapid": pd.arrays.IntegerArray(within, ~bought),
            "hour_events": pd.arrays.IntegerArray(np.array(in_hour, np.int64), ~timed),
            "user_events": pd.arrays.IntegerArray(earlier + 1, ~timed),
            "earlier_events": earlier,
            "home_country": np.array(homes, object),
        }
        ordered |= known
        yield pd.DataFrame({c: ordered[c] for c in self._columns}, copy=False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark, ends = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs() + 1), []
        for user, past in list(self._past.iterator()):
            end = self._end(past[1])
            if end < watermark:
                self._past.removeKey(tuple(user))
            else:
                ends.append(end)
        if ends:
            self._wake_by(min(ends), [])
        return iter([])

    def close(self) -> None:
        pass


#: The history of a user who is not known.
NOTHING = (0, NO_TIME, (0,) * 24, {}, ())


def in_order(part: pd.DataFrame) -> tuple[list[str | None], list[int], np.ndarray]:
    """Users of a part, where each begins, and the order of its rows by user, time and id; rows without an id come last."""
    codes, users = pd.factorize(part["user_key"], use_na_sentinel=False)
    at = part["at_us"].to_numpy()
    order = np.lexsort((at, codes))
    if ((np.diff(codes[order]) == 0) & (at[order][1:] == at[order][:-1])).any():
        ids, distinct = pd.factorize(part["event_id"], sort=True)
        order = np.lexsort((np.where(ids < 0, len(distinct), ids), at, codes))
    starts = np.flatnonzero(np.diff(codes[order], prepend=-1)).tolist()
    return [u if isinstance(u, str) else None for u in users], starts, order


def micros_of(length: str) -> int:
    """Length of an interval like ``24 hours``."""
    number, unit = length.split()
    seconds = {"second": 1, "minute": 60, "hour": 3600, "day": 86_400}[unit.removesuffix("s")]
    return int(number) * seconds * 1_000_000


def with_history(
    df: DataFrame, delay: str, horizon: str = "24 hours", forget: str = "400 days", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Stream of events (event_id, user_id, ts, event_type, country) with the user's history up to each.

    Adds, for the event and what arrived before it: ``rapid`` (purchases within ``horizon`` up to a purchase, both ends
    included), ``hour_events`` and ``user_events`` (the user's events in that hour of day, and in all), ``earlier_events``
    and ``home_country`` of the events before. Events of a batch count in order of time; what arrives in a later
    batch counts later, and what the watermark (``delay``) has passed is dropped by the stream. Rows without a time carry
    no history and leave none. Columns named in ``keep`` are handed on.

    The rules need a user's events in order, so a user is in one task; it holds one batch of the events of a bucket of users.
    """
    is_purchase = F.coalesce(F.col("event_type") == "purchase", F.lit(False))
    kept = [c for c in keep if c not in ("event_id", "user_id", "ts", "country")]
    prepared = df.withWatermark("ts", delay).select(
        "event_id",
        # As text, a missing id among the rows leaves the others exact.
        F.col("user_id").cast("string").alias("user_key"),
        F.pmod(F.xxhash64("user_id"), F.lit(HISTORY_BUCKETS)).cast("int").alias("bucket"),
        "ts",
        F.coalesce(F.unix_micros(F.col("ts").cast("timestamp")), F.lit(NO_TIME)).alias("at_us"),
        F.coalesce(F.hour("ts"), F.lit(-1)).alias("hour"),
        "country",
        is_purchase.alias("is_purchase"),
        *kept,
    )
    given = ["event_id", "user_key", "country", *kept]
    kinds = {f.name: f.dataType.simpleString() for f in prepared.schema}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in given) + ", " + HISTORY
    processor = UserHistory(micros_of(horizon), micros_of(forget), [*given, *HISTORY_COLUMNS])
    known = prepared.groupBy("bucket").transformWithStateInPandas(processor, schema, outputMode="Append", timeMode="EventTime")
    user_type = df.schema["user_id"].dataType
    return known.withColumn("user_key", F.col("user_key").cast(user_type)).withColumnRenamed("user_key", "user_id")
