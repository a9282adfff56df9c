"""Queries on decoding, validation, dead letters, encoding and storage."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from eventloom.functions.scalar import hashed_id, iso_utc, parse_iso, user_label
from eventloom.operators import anomalies, dedup, encode, enrich, lookup, metrics, quality, validate, views
from eventloom.operators.decode import decode_events
from eventloom.plans import driver
from eventloom.plans.driver import MESSAGES_SQL
from eventloom.plans.registry import query
from eventloom.session import workspace
from eventloom.sources import store
from eventloom.streaming import tables

K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"


def decoded(spark, folder):
    incoming = driver.messages(driver.events(spark, folder))
    return decode_events(incoming, received_at=F.col("ts").cast("timestamp"), keep=("row_id", "ts"))


@query(
    "encode_events",
    f"""SELECT CAST(event_id AS VARCHAR) AS event_id, printf('user_%05d', user_id) AS user_id,
        'sess_' || substr(sha256(concat_ws('|', user_id, CAST(ts AS DATE))), 1, 12) AS session_id,
        CASE event_type WHEN 'view' THEN 'page_view' WHEN 'signup' THEN 'login' WHEN 'error' THEN 'logout'
             ELSE event_type END AS event_type,
        ts AS event_ts, value, CASE event_type WHEN 'purchase' THEN 'INR' ELSE 'USD' END AS currency,
        CASE WHEN event_type = 'purchase' THEN 'prod_' || {K} END AS product_id,
        CASE WHEN event_type = 'purchase' THEN {K} + 1 END AS quantity,
        CASE WHEN event_type = 'click' THEN 'btn_' || {K} END AS element_id,
        {K} AS k, 0 AS fault_count
    FROM events""",
)
def encode_events(spark, folder):
    """Typed rows to JSON and back; every field must survive."""
    sent = encode.encode_events(driver.clean_events(driver.events(spark, folder)))
    back = decode_events(sent, received_at=F.lit(None).cast("timestamp"))
    return back.select(
        "event_id",
        "user_id",
        "session_id",
        "event_type",
        F.col("timestamp").cast("timestamp_ntz").alias("event_ts"),
        "value",
        "currency",
        "product_id",
        "quantity",
        "element_id",
        F.get_json_object("metadata", "$.k").cast("int").alias("k"),
        F.size("faults").alias("fault_count"),
    )


@query(
    "iso_round_trip",
    "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS iso_text, ts AS parsed_ts FROM events",
)
def iso_round_trip(spark, folder):
    df = driver.events(spark, folder).select("event_id", iso_utc(F.col("ts")).alias("iso_text"))
    return df.withColumn("parsed_ts", parse_iso(F.concat("iso_text", F.lit("Z"))).cast("timestamp_ntz"))


@query("validate_events", MESSAGES_SQL + "SELECT event_id, faults FROM checked")
def validate_events(spark, folder):
    return decoded(spark, folder).select(
        F.col("row_id").alias("event_id"), F.concat_ws(",", "faults").alias("faults")
    )


@query(
    "validate_typed",
    """SELECT event_id, concat_ws(',',
        CASE WHEN event_type IN ('view', 'signup', 'error') THEN 'unknown_event_type' END,
        CASE WHEN event_type = 'purchase' AND value < 10 THEN 'missing_value' END) AS faults
    FROM events""",
)
def validate_typed(spark, folder):
    """The rules on typed columns: unknown types, and purchases whose small values were lost."""
    small_purchase = (F.col("event_type") == "purchase") & (F.col("value") < 10)
    df = driver.events(spark, folder).withColumn("value", F.when(~small_purchase, F.col("value")))
    checked = validate.validate(df.withColumn("user_id", user_label(F.col("user_id"))))
    return checked.select("event_id", F.concat_ws(",", "faults").alias("faults"))


@query(
    "dead_letters",
    MESSAGES_SQL
    + """SELECT CASE WHEN k NOT IN (83, 89) THEN CAST(event_id AS VARCHAR) END AS event_id,
        faults AS error_reason, split_part(faults, ',', 1) AS error_type, ts AS failed_at
    FROM checked WHERE faults <> ''""",
)
def dead_letters(spark, folder):
    """Rejected messages written to the dead-letter table and read back."""
    checked = decoded(spark, folder)
    letters = validate.dead_letters(checked, F.col("raw"), F.col("ts").cast("timestamp"))
    path = workspace(spark, "dead-letters")
    for _ in range(2):  # a repeated batch replaces itself
        store.append_dead_letters(letters, path, 0)
    stored = store.read_dead_letters(spark, path)
    return stored.select(
        "event_id", "error_reason", "error_type", F.col("timestamp").cast("timestamp_ntz").alias("failed_at")
    )


@query(
    "defaults_filled",
    MESSAGES_SQL
    + """SELECT event_id, CASE WHEN k BETWEEN 24 AND 30 THEN 'web' WHEN k < 50 THEN 'mobile' WHEN k < 70 THEN 'tablet'
            ELSE 'desktop' END AS device,
        CASE WHEN k < 40 THEN 'IN' ELSE 'US' END AS country,
        CASE WHEN kind = 'purchase' THEN 'INR' ELSE 'USD' END AS currency,
        CASE WHEN kind = 'purchase' THEN CASE WHEN k IN (35, 36) THEN 2 WHEN k BETWEEN 40 AND 50 THEN 1
            WHEN k >= 90 THEN 60 ELSE k + 1 END END AS quantity,
        CASE WHEN kind = 'search' THEN CASE WHEN k = 76 THEN 0 ELSE (k - 50) * 3 END END AS results_count,
        CASE WHEN k = 15 THEN 12.34::DOUBLE WHEN k IN (17, 18) THEN NULL ELSE value END AS value, ts AS event_ts
    FROM checked WHERE faults = ''""",
)
def defaults_filled(spark, folder):
    """Accepted messages: defaults for absent keys and converted numbers."""
    good = validate.accepted(decoded(spark, folder))
    return good.select(
        F.col("row_id").alias("event_id"),
        "device",
        "country",
        "currency",
        "quantity",
        "results_count",
        "value",
        F.col("timestamp").cast("timestamp_ntz").alias("event_ts"),
    )


@query(
    "quality_warnings",
    MESSAGES_SQL
    + """SELECT event_id, warnings FROM (SELECT event_id, concat_ws(',',
        CASE WHEN kind = 'video_watch' AND k < 60 THEN 'video_inconsistent' END,
        CASE WHEN kind = 'click' AND (k * 25 > 1920 OR k * 12 > 1080) THEN 'click_off_screen' END,
        CASE WHEN k >= 95 THEN 'bad_ip_address' END) AS warnings
    FROM checked WHERE faults = '') WHERE warnings <> ''""",
)
def quality_warnings(spark, folder):
    warned = quality.with_warnings(validate.accepted(decoded(spark, folder))).where(F.size("warnings") > 0)
    return warned.select(F.col("row_id").alias("event_id"), F.concat_ws(",", "warnings").alias("warnings"))


@query(
    "replay_dead_letters",
    MESSAGES_SQL
    + """SELECT event_id, CASE WHEN faults = '' THEN 'accepted' ELSE 'repaired' END AS origin FROM checked
    WHERE faults = '' OR faults IN ('blank_user_id', 'blank_session_id', 'blank_user_id,blank_session_id')""",
)
def replay_dead_letters(spark, folder):
    """Dead letters that only lacked ids are repaired and folded back, once each."""
    path = workspace(spark, "checked")
    decoded(spark, folder).select("event_id", "timestamp", "faults").write.parquet(path)
    checked = spark.read.parquet(path)
    repairable = F.forall("faults", lambda f: f.isin("blank_user_id", "blank_session_id"))
    fixed = validate.rejected(checked).where(repairable).drop("faults").withColumn("origin", F.lit("repaired"))
    good = validate.accepted(checked).withColumn("origin", F.lit("accepted"))
    folded = dedup.replay(good, fixed.unionAll(fixed), ts="timestamp")
    return folded.select(F.col("event_id").cast("bigint").alias("event_id"), "origin")


@query(
    "search_stats",
    MESSAGES_SQL
    + """SELECT 'topic ' || (k // 10) AS query, count(*) AS searches,
        round(avg(CASE WHEN k = 76 THEN 0 ELSE (k - 50) * 3 END), 3) AS mean_results,
        round(count(*) FILTER (k IN (50, 76)) * 100.0::DOUBLE / count(*), 2) AS zero_result_rate
    FROM checked WHERE faults = '' AND kind = 'search' GROUP BY 1""",
)
def search_stats(spark, folder):
    return metrics.search_stats(validate.accepted(decoded(spark, folder)))


@query(
    "video_stats",
    MESSAGES_SQL
    + """SELECT 'vid_' || (k // 10) AS video_id, count(*) AS views,
        sum(CASE WHEN k < 60 THEN 1200 ELSE 36 * k END)::DOUBLE AS watch_seconds,
        round(count(*) FILTER (k >= 90 OR k = 54) * 100.0::DOUBLE / count(*), 2) AS completion_rate
    FROM checked WHERE faults = '' AND kind = 'video_watch' GROUP BY 1""",
)
def video_stats(spark, folder):
    return metrics.video_stats(validate.accepted(decoded(spark, folder)))


@query(
    "device_breakdown",
    MESSAGES_SQL
    + """SELECT CASE WHEN k BETWEEN 24 AND 30 THEN 'web' WHEN k < 50 THEN 'mobile' WHEN k < 70 THEN 'tablet'
            ELSE 'desktop' END AS device, CASE WHEN k < 40 THEN 'IN' ELSE 'US' END AS country,
        kind AS event_type, count(*) AS n
    FROM checked WHERE faults = '' GROUP BY ALL""",
)
def device_breakdown(spark, folder):
    return metrics.breakdown(validate.accepted(decoded(spark, folder)), "device", "country", "event_type")


@query(
    "sink_batch_counts",
    """SELECT event_type, count(*) AS stored, (SELECT count(*) FROM events) AS accepted
    FROM events GROUP BY event_type""",
)
def sink_batch_counts(spark, folder):
    """A batch written with its rows counted on the way, then counted again from the sink."""
    path = workspace(spark, "sink")
    seen = store.write_counted(driver.events(spark, folder), path)
    stored = spark.read.parquet(path).groupBy("event_type").agg(F.count("*").alias("stored"))
    return stored.withColumn("accepted", F.lit(seen.get["rows"]).cast("bigint"))


@query(
    "oversize_split",
    """SELECT CASE WHEN strlen(text) <= 10000 THEN 'sent' ELSE 'oversize' END AS branch, count(*) AS messages,
        CAST(sum(strlen(text)) AS BIGINT) AS total_bytes FROM documents GROUP BY 1""",
)
def oversize_split(spark, folder):
    """Texts as messages: those beyond the limit of a topic end up among the failed ones, in the same pass."""
    texts = driver.table(spark, folder, "documents").select("text", F.lit("sent").alias("topic"))
    path = workspace(spark, "messages")
    store.write_topics(store.outgoing(texts, F.col("text"), limit=10000), path, 0)
    branch = F.when(F.col("topic") == store.FAILED, "oversize").otherwise(F.col("topic")).alias("branch")
    return store.read_topics(spark, path).groupBy(branch).agg(
        F.count("*").alias("messages"), F.sum(F.octet_length("value")).cast("bigint").alias("total_bytes")
    )


@query("decode_props", f"SELECT event_id, {K} AS k FROM events")
def decode_props(spark, folder):
    parsed = driver.events(spark, folder).select("event_id", F.try_parse_json("props").alias("p"))
    return parsed.select("event_id", F.try_variant_get("p", "$.k", "int").alias("k"))


@query(
    "batch_pack_counts",
    """SELECT event_id // 100 AS batch_id, CAST(count(*) AS INTEGER) AS events,
        CAST(sum(CAST(value AS DECIMAL(15,2))) AS DECIMAL(25,2)) AS total_value
    FROM events GROUP BY 1""",
)
def batch_pack_counts(spark, folder):
    """Batches of a hundred ids; unique ids bound the size of a batch."""
    unique = dedup.first_delivery(driver.events(spark, folder))
    batches = encode.pack_batches(unique, F.expr("event_id DIV 100"), "event_id", F.expr("timestamp'2024-02-01 00:00:00'"))
    zero = F.lit(0).cast("decimal(25,2)")
    values = F.transform("events", lambda e: e["value"].cast("decimal(15,2)"))
    total = F.aggregate(values, zero, lambda acc, v: (acc + v).cast("decimal(25,2)"))
    return batches.select("batch_id", F.size("events").alias("events"), total.alias("total_value"))


@query(
    "store_events_daily",
    "SELECT CAST(ts AS DATE) AS event_date, count(*) AS stored FROM events GROUP BY 1",
)
def store_events_daily(spark, folder):
    """Events in the stored layout, delivered twice, stored once by day and read back."""
    path = workspace(spark, "events")
    rows = store.stored_layout(driver.clean_events(driver.events(spark, folder)), F.current_timestamp())
    for delivery in (0, 1):
        tables.append_once(rows, delivery, path, ts="timestamp")
    return store.read_events(spark, path).groupBy("event_date").agg(F.count("*").alias("stored"))


@query(
    "storage_latency",
    f"""WITH stored AS (SELECT CASE event_type WHEN 'view' THEN 'page_view' WHEN 'signup' THEN 'login' WHEN 'error' THEN 'logout'
            ELSE event_type END AS event_type, CAST(2000 * {K} + event_id % 7 - 3
            + CASE WHEN event_type IN ('click', 'purchase') THEN 0 ELSE 3600000000 END AS BIGINT) AS latency FROM events)
    SELECT event_type, count(*) AS n, round(quantile_cont(latency, 0.5) / 1000000.0::DOUBLE, 6) AS p50,
        round(quantile_cont(latency, 0.9) / 1000000.0::DOUBLE, 6) AS p90, round(quantile_cont(latency, 0.99) / 1000000.0::DOUBLE, 6) AS p99,
        round(count(*) FILTER (latency <= 100000) * 100.0::DOUBLE / count(*), 2) AS within_target,
        count(*) FILTER (latency < 0) AS early
    FROM stored WHERE latency IS NOT NULL GROUP BY 1""",
)
def storage_latency(spark, folder):
    """Event to storage over the stored layout. Clicks and purchases arrive at once; all events come again an hour
    later, when only the others are new."""
    arrived = driver.clean_events(driver.events(spark, folder))
    delay = F.get_json_object("metadata", "$.k").cast("long") * 2000 + F.col("event_id").cast("long") % 7 - 3
    path = workspace(spark, "events")
    prompt = arrived.where(F.col("event_type").isin("click", "purchase"))
    for delivery, (rows, wait) in enumerate([(prompt, 0), (arrived, 3_600_000_000)]):
        created = F.timestamp_micros(F.unix_micros("timestamp") + delay + wait)
        tables.append_once(store.stored_layout(rows, created), delivery, path, ts="timestamp")
    return metrics.storage_latency(store.read_events(spark, path), "event_type", {"p50": 0.5, "p90": 0.9, "p99": 0.99})


@query(
    "route_topics",
    """WITH s AS (SELECT event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(15,2))) AS DOUBLE) AS s,
        CAST(sum(CAST(value AS DECIMAL(15,2)) * CAST(value AS DECIMAL(15,2))) AS DOUBLE) AS q FROM events GROUP BY 1)
    SELECT CASE WHEN e.event_type = 'error' THEN 'user-events'
        WHEN (e.value - s.s / s.n) / sqrt((s.q - s.s * s.s / s.n) / (s.n - 1)) > 3 THEN 'user-anomalies'
        ELSE 'user-analytics' END AS topic, count(*) AS n
    FROM events e JOIN s USING (event_type) GROUP BY 1""",
)
def route_topics(spark, folder):
    """Failures stay on the input topic, outliers go to anomalies, the rest to analytics: written to their topics, read back."""
    df = driver.events(spark, folder)
    scored = anomalies.with_z_score(df, anomalies.baseline_map(anomalies.value_baseline(df)))
    routed = store.route(scored, F.col("z") > anomalies.Z_LIMIT, F.col("event_type") != "error")
    path = workspace(spark, "topics")
    store.write_topics(store.outgoing(routed, F.to_json(F.struct(*df.columns))), path, 0)
    return store.read_topics(spark, path).groupBy("topic").agg(F.count("*").alias("n"))


def events_by_day(spark, folder):
    path = workspace(spark, "events-by-day")
    store.append_events(driver.events(spark, folder), path, ts="ts")
    return store.read_events(spark, path)


@query(
    "retention_stored",
    "SELECT event_id, ts FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 60 HOUR",
)
def retention_stored(spark, folder):
    """The last days of the stored layout; older days are not opened."""
    return lookup.retained(events_by_day(spark, folder), "60 hours").select("event_id", "ts")


@query(
    "lookup_stored",
    """SELECT event_id, user_id, ts, value FROM events
    WHERE ts >= TIMESTAMP '2024-01-05 06:00:00' AND ts < TIMESTAMP '2024-01-08' AND event_type = 'purchase'""",
)
def lookup_stored(spark, folder):
    found = lookup.find_events(
        events_by_day(spark, folder), start=datetime(2024, 1, 5, 6), end=datetime(2024, 1, 8), event_types=("purchase",)
    )
    return found.select("event_id", "user_id", "ts", "value")


@query(
    "retention_filter",
    "SELECT event_id, ts FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 24 HOUR",
)
def retention_filter(spark, folder):
    return lookup.retained(driver.events(spark, folder), "24 hours").select("event_id", "ts")


TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@query(
    "table_counts",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in TABLES),
)
def table_counts(spark, folder):
    return store.table_counts({t: driver.table(spark, folder, t) for t in TABLES})


@query(
    "lookup_events",
    """SELECT event_id, user_id, ts, event_type, value FROM events WHERE user_id = 7
        AND ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20' AND event_type IN ('click', 'purchase')""",
)
def lookup_events(spark, folder):
    found = lookup.find_events(
        driver.events(spark, folder),
        user_id=7,
        start=datetime(2024, 1, 5),
        end=datetime(2024, 1, 20),
        event_types=("click", "purchase"),
    )
    return found.select("event_id", "user_id", "ts", "event_type", "value")


@query(
    "lookup_by_country",
    """SELECT event_id, n_name AS country FROM events JOIN customer ON user_id = c_custkey
        JOIN nation ON c_nationkey = n_nationkey
    WHERE n_name = 'NATION_10' AND event_type = 'purchase'""",
)
def lookup_by_country(spark, folder):
    joined = enrich.with_users(driver.events(spark, folder), driver.users(spark, folder))
    return lookup.find_events(joined, event_types=("purchase",), country="NATION_10").select("event_id", "country")


@query(
    "subtype_views",
    """SELECT CASE event_type WHEN 'view' THEN 'page_view' WHEN 'signup' THEN 'login' WHEN 'error' THEN 'logout'
            ELSE event_type END AS event_type, count(*) AS n,
        count(*) FILTER (event_type <> 'purchase') AS null_products,
        count(*) FILTER (event_type <> 'click') AS null_elements
    FROM events GROUP BY 1""",
)
def subtype_views(spark, folder):
    """Views per subtype, united again; fields of other subtypes come back as null."""
    wide = driver.clean_events(driver.events(spark, folder))
    parts = [views.subtype(wide, "purchase"), views.subtype(wide, "click"), views.plain(wide)]
    return views.reunite(parts).groupBy("event_type").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("product_id").isNull()).alias("null_products"),
        F.count_if(F.col("element_id").isNull()).alias("null_elements"),
    )


@query(
    "id_format",
    """SELECT event_id, printf('user_%05d', user_id) AS user_label,
        'sess_' || substr(sha256(concat_ws('|', user_id, event_id)), 1, 12) AS session_label FROM events""",
)
def id_format(spark, folder):
    return driver.events(spark, folder).select(
        "event_id",
        user_label(F.col("user_id")).alias("user_label"),
        hashed_id("sess_", 12, F.col("user_id"), F.col("event_id")).alias("session_label"),
    )


@query("dedup_events", "SELECT event_id, user_id, ts, event_type, value FROM events")
def dedup_events(spark, folder):
    """Every event delivered twice, the second time an hour late: the first one stays."""
    df = driver.events(spark, folder).select("event_id", "user_id", "ts", "event_type", "value")
    late = df.withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 HOUR"))
    return dedup.first_delivery(late.unionByName(df))


@query(
    "idempotent_append",
    "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-20'",
)
def idempotent_append(spark, folder):
    """A delivery that overlaps the store and repeats its purchases: what remains to append."""
    df = driver.events(spark, folder).select("event_id", "ts", "event_type")
    stored = df.where(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
    incoming = df.where(F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz"))
    delivery = incoming.unionByName(driver.of_type(incoming, "purchase"))
    return dedup.not_stored(delivery, stored).select("event_id", "ts")
