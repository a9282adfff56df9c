"""Streaming queries: a file stream is run to its end and the sink is read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.operators import anomalies, metrics
from eventloom.plans import driver
from eventloom.plans.batch import LAST_TOUCH, sessions_sql
from eventloom.plans.driver import MESSAGES_SQL
from eventloom.plans.registry import query
from eventloom.plans.scoring import PLACED_SQL, RULES_SQL, Z_SQL, placed_events
from eventloom.session import prepare, workspace
from eventloom.sources.files import stream_table
from eventloom.streaming import joins, monitor, runs, state, tables, windows


def events(spark: SparkSession, folder: str) -> DataFrame:
    return runs.event_time(stream_table(prepare(spark), folder, "events"))


def of_type(df: DataFrame, kind: str) -> DataFrame:
    return df.where(F.col("event_type") == kind)


def collected(df: DataFrame, spark: SparkSession, name: str) -> DataFrame:
    """Append a stream to files until its input is used up, and read them."""
    space = workspace(spark, name)
    runs.run_available(runs.append_files(df, f"{space}/out", f"{space}/checkpoint"))
    return spark.read.schema(df.schema).parquet(f"{space}/out")


def handled(df: DataFrame, handle, space: str, mode: str = "append") -> None:
    runs.run_available(runs.per_batch(df, handle, f"{space}/checkpoint", mode))


def naive(df: DataFrame, *columns: str) -> DataFrame:
    """Instants as naive UTC times, as the source tables have them."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


@query("stream_append_count", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def stream_append_count(spark, folder):
    stored = collected(events(spark, folder), spark, "append")
    return stored.groupBy("event_type").agg(F.count("*").alias("n"))


@query(
    "stream_tumbling_counts",
    """SELECT * FROM (SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start,
        time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end, event_type, count(*) AS n FROM events GROUP BY ALL)
    WHERE window_end <= (SELECT max(ts) - INTERVAL 24 HOUR FROM events)""",
)
def stream_tumbling_counts(spark, folder):
    """Windows closed by a watermark a day behind the newest event."""
    counted = windows.windowed_counts(events(spark, folder), "24 hours", "1 day", None, "event_type")
    return naive(collected(counted, spark, "tumbling"), "window_start", "window_end")


@query(
    "stream_sliding_counts",
    """SELECT * FROM (SELECT time_bucket(INTERVAL 6 HOUR, ts) - k * INTERVAL 6 HOUR AS window_start,
        time_bucket(INTERVAL 6 HOUR, ts) - k * INTERVAL 6 HOUR + INTERVAL 1 DAY AS window_end, count(*) AS n
        FROM events, range(4) r(k) GROUP BY ALL)
    WHERE window_end <= (SELECT max(ts) - INTERVAL 24 HOUR FROM events)""",
)
def stream_sliding_counts(spark, folder):
    counted = windows.windowed_counts(events(spark, folder), "24 hours", "1 day", "6 hours")
    return naive(collected(counted, spark, "sliding"), "window_start", "window_end")


@query(
    "stream_gap_sessions",
    sessions_sql("30 MINUTE")
    + """SELECT * FROM (SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS n
        FROM g GROUP BY user_id, sid) WHERE session_end <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""",
)
def stream_gap_sessions(spark, folder):
    sessions = windows.gap_sessions(events(spark, folder), "1 hour", "30 minutes")
    return naive(collected(sessions, spark, "sessions"), "session_start", "session_end")


@query("stream_dedup", "SELECT event_id, ts, event_type FROM events")
def stream_dedup(spark, folder):
    """Every event arrives twice."""
    twice = events(spark, folder).unionByName(events(spark, folder)).select("event_id", "ts", "event_type")
    return naive(collected(windows.first_delivery(twice, "24 hours"), spark, "dedup"), "ts")


USERS_SQL = """SELECT user_id, min(ts) AS first_seen, max(ts) AS last_seen, count(*) AS total_events,
    count(*) FILTER (event_type = 'purchase') AS total_purchases,
    CAST(sum(CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(15,2)) ELSE 0 END) AS DECIMAL(25,2)) AS total_spent
    FROM events GROUP BY user_id"""


@query("stream_user_rollup", USERS_SQL)
def stream_user_rollup(spark, folder):
    """Built-in aggregate in update mode; the newest row per user is the current state."""
    space = workspace(spark, "rollup")
    handled(metrics.user_rollup(events(spark, folder)), tables.keep_changes(f"{space}/changes"), space, "update")
    return naive(tables.latest_changes(spark, f"{space}/changes", "user_id"), "first_seen", "last_seen")


@query("stream_user_state", USERS_SQL)
def stream_user_state(spark, folder):
    """The same totals kept by a stateful processor."""
    space = workspace(spark, "state")
    totals = state.running_totals(events(spark, folder))
    handled(totals, tables.keep_changes(f"{space}/changes"), space, "update")
    latest = tables.latest_changes(spark, f"{space}/changes", "user_id", "shard")
    return naive(state.combined(latest), "first_seen", "last_seen")


@query(
    "stream_upsert_users",
    USERS_SQL.replace(
        "FROM events",
        """, arg_max(CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) < 50 THEN 'IN' ELSE 'US' END, (ts, event_id)) AS country,
        arg_max(props, (ts, event_id)) AS metadata FROM events""",
    ),
)
def stream_upsert_users(spark, folder):
    """Events stored once although purchases arrive twice, and users kept up to date."""
    space = workspace(spark, "upsert")
    delivered = driver.placed(events(spark, folder).unionByName(of_type(events(spark, folder), "purchase")))
    handled(delivered, tables.upsert_users(f"{space}/events", f"{space}/users"), space)
    return naive(tables.read_users(spark, f"{space}/users"), "first_seen", "last_seen")


@query(
    "stream_enrich",
    """SELECT event_id, user_id, c_mktsegment AS segment, n_name AS country
    FROM events LEFT JOIN customer ON user_id = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey""",
)
def stream_enrich(spark, folder):
    joined = joins.with_users(events(spark, folder), driver.users(spark, folder))
    return collected(joined.select("event_id", "user_id", "segment", "country"), spark, "enrich")


@query(
    "stream_click_to_purchase",
    LAST_TOUCH
    + """SELECT * FROM touched WHERE purchase_ts <= (SELECT date_trunc('millisecond',
        least(max(ts) FILTER (event_type = 'click'), max(ts) FILTER (event_type = 'purchase'))) - INTERVAL 1 HOUR FROM events)""",
)
def stream_click_to_purchase(spark, folder):
    """Two streams with an interval join: purchases that the watermark has passed, with all their clicks."""
    clicks, purchases = of_type(events(spark, folder), "click"), of_type(events(spark, folder), "purchase")
    space = workspace(spark, "attribution")
    parts = joins.clicks_before_purchases(clicks, purchases, "1 hour", "24 hours")
    run = runs.run_available(runs.append_files(parts, f"{space}/out", f"{space}/checkpoint"))
    stored = spark.read.schema(parts.schema).parquet(f"{space}/out")
    final = F.col("purchase_ts") <= F.lit(runs.watermark_of(run)).cast("timestamp")
    return naive(joins.attributed(stored.where(final)), "purchase_ts", "click_ts")


@query(
    "stream_dead_letters",
    MESSAGES_SQL
    + """SELECT CASE WHEN faults = '' THEN 'accepted' ELSE split_part(faults, ',', 1) END AS outcome, count(*) AS n
    FROM checked GROUP BY 1""",
)
def stream_dead_letters(spark, folder):
    """A stream of messages divided into accepted events and dead letters."""
    space = workspace(spark, "dead")
    incoming = driver.messages(events(spark, folder))
    handled(incoming, tables.split_rejected(f"{space}/valid", f"{space}/dead", "ts"), space)
    valid = spark.read.parquet(f"{space}/valid").select(F.lit("accepted").alias("outcome"))
    dead = spark.read.parquet(f"{space}/dead").select(F.col("error_type").alias("outcome"))
    return valid.unionAll(dead).groupBy("outcome").agg(F.count("*").alias("n"))


@query(
    "stream_anomalies",
    Z_SQL
    + ", "
    + PLACED_SQL
    + """, o AS (SELECT *, row_number() OVER so_far AS i, count(*) OVER (PARTITION BY user_id, hour(ts) ORDER BY ts, event_id
            ROWS UNBOUNDED PRECEDING) AS hour_events, count(*) FILTER (event_type = 'purchase') OVER (PARTITION BY user_id ORDER BY ts
            RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND CURRENT ROW) AS bought
        FROM placed WINDOW so_far AS (PARTITION BY user_id ORDER BY ts, event_id)),
    c AS (SELECT a.event_id, b.country, count(*) AS n FROM o a JOIN o b ON a.user_id = b.user_id AND b.i < a.i GROUP BY ALL),
    home AS (SELECT event_id, arg_min(country, (-n, country)) AS home_country FROM c WHERE country IS NOT NULL GROUP BY 1),
    hits AS (SELECT o.event_id, o.user_id, z > 3 AS high_value, k + 1 >= 50 AND o.event_type = 'purchase' AS bulk,
        bought >= 3 AND o.event_type = 'purchase' AS rapid, hour_events::DOUBLE / i <= 0.02 AND i >= 20 AS odd_hour,
        coalesce(country <> home_country AND i > 5, false) AS away, stated
        FROM o JOIN z USING (event_id) LEFT JOIN home ON home.event_id = o.event_id)
    SELECT * FROM ("""
    + RULES_SQL
    + ") WHERE flagged",
)
def stream_anomalies(spark, folder):
    """Events flagged in flight: each against its user's history so far and a baseline of values fixed at the start."""
    baseline = anomalies.fixed_baseline(anomalies.value_baseline(driver.events(spark, folder)))
    placed = placed_events(spark, folder, events(spark, folder)).withColumn("k", driver.feature())
    scored = flagged_in_flight(anomalies.with_z_score(placed, baseline))
    return collected(scored.where("flagged").select("event_id", "user_id", "score", "flagged", "rules"), spark, "anomalies")


def flagged_in_flight(df: DataFrame) -> DataFrame:
    """Rules on a stream of events with ``z``, ``country``, ``metadata`` and ``k``."""
    known = state.with_history(df, "24 hours", keep=("event_type", "z", "k", "metadata"))
    is_purchase = F.coalesce(F.col("event_type") == "purchase", F.lit(False))
    rules = anomalies.usual_rules(is_purchase, F.col("k") + 1)
    away, score = rules["unusual_location"]
    rules["unusual_location"] = (away & (F.col("earlier_events") >= anomalies.KNOWN_HOME_EVENTS), score)
    return anomalies.scored(known, rules, stated=anomalies.stated_score(F.col("metadata")))


@query(
    "stream_late_events",
    """SELECT CASE WHEN ts < TIMESTAMP '2024-01-16' AND ts < (SELECT max(ts) FROM events) - INTERVAL 24 HOUR
        THEN 'late' ELSE 'on_time' END AS arrival, count(*) AS n FROM events GROUP BY 1""",
)
def stream_late_events(spark, folder):
    """The newer half of the month arrives before the older half; the latter is late."""
    space = workspace(spark, "late")
    source = driver.events(spark, folder).select("event_id", "ts")
    split = F.lit("2024-01-16").cast("timestamp_ntz")
    for part in (source.where(F.col("ts") >= split), source.where(F.col("ts") < split)):
        part.write.mode("append").parquet(f"{space}/in")
        arrived = runs.event_time(spark.readStream.schema(source.schema).parquet(f"{space}/in"))
        handled(arrived, tables.split_late(f"{space}/split", "24 hours"), space)
    counts = [
        spark.read.parquet(f"{space}/split/{name}").agg(F.lit(name).alias("arrival"), F.count("*").alias("n"))
        for name in ("late", "on_time")
    ]
    return counts[0].unionAll(counts[1]).where(F.col("n") > 0)


@query(
    "stream_timed_run",
    "SELECT event_type, count(*) AS n, count(*) FILTER (event_type = 'error') AS failed FROM events GROUP BY 1",
)
def stream_timed_run(spark, folder):
    """A stream that looks for input all the time, stopped once none is left."""
    space = workspace(spark, "timed")
    writer = runs.append_files(events(spark, folder), f"{space}/out", f"{space}/checkpoint")
    runs.run_until_idle(writer, "200 milliseconds", seconds=1800)
    stored = spark.read.parquet(f"{space}/out")
    return stored.groupBy("event_type").agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("failed"))


@query(
    "stream_progress",
    """SELECT count(*) AS rows_read, count(*) AS sent, count(*) FILTER (event_type = 'error') AS failed,
        (epoch_us(max(ts)) - epoch_us(date_trunc('millisecond', max(ts)) - INTERVAL 1 HOUR)) / 1000000.0::DOUBLE AS lag_seconds
    FROM events""",
)
def stream_progress(spark, folder):
    """What a run reports of itself: rows read, rows sent and failed as observed on the way, and how far the watermark is behind."""
    space = workspace(spark, "progress")
    watched = monitor.counted(events(spark, folder).withWatermark("ts", "1 hour"), F.col("event_type") == "error")
    kinds = watched.dropDuplicatesWithinWatermark(["event_id"])
    run = runs.run_available(runs.append_files(kinds, f"{space}/out", f"{space}/checkpoint"))
    seen = monitor.totals(run)
    lag = metrics.lag_behind(spark.read.parquet(f"{space}/out"), F.lit(runs.watermark_of(run)).cast("timestamp"))
    return lag.select(*[F.lit(seen[c]).cast("long").alias(c) for c in ("rows_read", "sent", "failed")], "lag_seconds")
