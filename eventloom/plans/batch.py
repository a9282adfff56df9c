"""Queries on users, days, revenue, features, sessions and order within a user."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom.functions.scalar import money, total_money
from eventloom.operators import attribution, enrich, lookup, metrics, ordered, quantiles, ranking, timewindows
from eventloom.plans import driver
from eventloom.plans.registry import query
from eventloom.session import workspace
from eventloom.sources import store

K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
MONEY = "CAST(sum(CAST(value AS DECIMAL(15,2))) AS DECIMAL(25,2))"
REVENUE = """CAST(sum(CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(15,2)) ELSE 0 END)
    AS DECIMAL(25,2))"""
WITH_COUNTRY = """(SELECT e.*, n_name AS country FROM events e JOIN customer ON user_id = c_custkey
    JOIN nation ON c_nationkey = n_nationkey)"""


def with_country(spark, folder):
    profiles = driver.users(spark, folder).select("user_id", "country")
    return enrich.with_users(driver.events(spark, folder), profiles)


@query(
    "daily_stats",
    f"""SELECT CAST(ts AS DATE) AS day, event_type, country, count(*) AS events, count(DISTINCT user_id) AS users,
        {REVENUE} AS revenue FROM {WITH_COUNTRY} GROUP BY ALL""",
)
def daily_stats(spark, folder):
    return metrics.daily_stats_by_home(driver.events(spark, folder), driver.users(spark, folder))


@query(
    "daily_stats_by_event",
    f"""SELECT CAST(ts AS DATE) AS day, event_type, CASE WHEN {K} < 50 THEN 'IN' ELSE 'US' END AS country,
        count(*) AS events, count(DISTINCT user_id) AS users, {REVENUE} AS revenue FROM events GROUP BY ALL""",
)
def daily_stats_by_event(spark, folder):
    """Daily statistics when each event states its own country, stored by day and read back."""
    placed = driver.events(spark, folder).withColumn("country", F.when(driver.feature() < 50, "IN").otherwise("US"))
    path = workspace(spark, "daily-stats")
    store.write_daily_stats(metrics.daily_stats(placed), path)
    return spark.read.parquet(path)


@query(
    "enrich_users",
    """SELECT event_id, user_id, c_name AS user_name, c_mktsegment AS segment, n_name AS country
    FROM events LEFT JOIN customer ON user_id = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey""",
)
def enrich_users(spark, folder):
    joined = enrich.with_users(driver.events(spark, folder), driver.users(spark, folder))
    return joined.select("event_id", "user_id", "user_name", "segment", "country")


@query(
    "fk_orphans",
    """SELECT event_id, user_id FROM events
    WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)""",
)
def fk_orphans(spark, folder):
    """Events of users missing from a user table with gaps."""
    orphans = enrich.orphans(driver.events(spark, folder), driver.known_users(spark, folder))
    return orphans.select("event_id", "user_id")


@query(
    "fk_kept",
    """SELECT event_id, user_id FROM events
    WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)""",
)
def fk_kept(spark, folder):
    kept = enrich.known_only(driver.events(spark, folder), driver.known_users(spark, folder))
    return kept.select("event_id", "user_id")


def sales_with_parts(spark, folder):
    sales = driver.table(spark, folder, "lineitem").withColumnRenamed("l_partkey", "p_partkey")
    return sales, driver.table(spark, folder, "part")


@query(
    "enrich_catalog",
    """SELECT p_brand, p_type, count(*) AS sales, CAST(sum(CAST(l_quantity AS DECIMAL(15,2))) AS DECIMAL(25,2)) AS quantity
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY ALL""",
)
def enrich_catalog(spark, folder):
    sales, parts = sales_with_parts(spark, folder)
    joined = enrich.with_catalog(sales, parts, "p_partkey")
    return joined.groupBy("p_brand", "p_type").agg(
        F.count("*").alias("sales"), total_money(F.col("l_quantity")).alias("quantity")
    )


@query(
    "price_range_check",
    """SELECT l_orderkey, l_linenumber, coalesce(l_extendedprice / l_quantity
        BETWEEN 0.5::DOUBLE * p_retailprice AND 2.0::DOUBLE * p_retailprice, false) AS in_range
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""",
)
def price_range_check(spark, folder):
    sales, parts = sales_with_parts(spark, folder)
    unit_price = F.try_divide(F.col("l_extendedprice"), F.col("l_quantity"))
    low, high = F.col("p_retailprice") * 0.5, F.col("p_retailprice") * 2.0
    checked = enrich.price_check(sales, parts, "p_partkey", unit_price, low, high)
    return checked.select("l_orderkey", "l_linenumber", "in_range")


LAST_TOUCH = """WITH pairs AS (
    SELECT p.event_id AS purchase_id, p.user_id, p.ts AS purchase_ts, c.event_id AS click_id, c.ts AS click_ts
    FROM events p LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') c
      ON c.user_id = p.user_id AND c.ts <= p.ts AND c.ts > p.ts - INTERVAL 24 HOUR
    WHERE p.event_type = 'purchase'),
touched AS (
    SELECT purchase_id, any_value(user_id) AS user_id, any_value(purchase_ts) AS purchase_ts,
        arg_max(click_id, (click_ts, click_id)) AS click_id, max(click_ts) AS click_ts,
        count(click_id) AS clicks_in_reach
    FROM pairs GROUP BY purchase_id)
"""


def attributed(spark, folder):
    df = driver.events(spark, folder).select("event_id", "user_id", "ts", "event_type")
    return attribution.last_touch(driver.of_type(df, "click"), driver.of_type(df, "purchase"), "24 hours")


@query("click_to_purchase", LAST_TOUCH + "SELECT * FROM touched")
def click_to_purchase(spark, folder):
    return attributed(spark, folder)


@query(
    "conversion_rate",
    LAST_TOUCH
    + """SELECT a.n AS clicking_users, b.n AS converting_users,
        round(coalesce(b.n * 100.0::DOUBLE / nullif(a.n, 0), 0), 2) AS conversion_rate
    FROM (SELECT count(DISTINCT user_id) AS n FROM events WHERE event_type = 'click') a,
         (SELECT count(DISTINCT user_id) AS n FROM touched WHERE click_id IS NOT NULL) b""",
)
def conversion_rate(spark, folder):
    clicks = driver.of_type(driver.events(spark, folder), "click")
    return attribution.conversion(clicks, attributed(spark, folder))


PROFILED = ("event_id", "ts", "user_id", "event_type", "value", "props")


@query(
    "domain_profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_values FROM events" for c in PROFILED
    ),
)
def domain_profile(spark, folder):
    return metrics.domain_profile(driver.events(spark, folder), PROFILED)


@query(
    "delivery_stats",
    """SELECT requested, sent, failed, elapsed_seconds, bytes_sent, round(sent / elapsed, 6) AS events_per_second,
        round(sent * 100.0::DOUBLE / requested, 2) AS success_of_requested,
        round(sent * 100.0::DOUBLE / (sent + failed), 2) AS success_of_finished
    FROM (SELECT count(*) FILTER (event_type <> 'signup') AS requested, count(*) FILTER (event_type <> 'error') AS sent,
        count(*) FILTER (event_type = 'error') AS failed,
        (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0::DOUBLE AS elapsed, round(elapsed, 3) AS elapsed_seconds,
        CAST(sum(CASE WHEN event_type <> 'error' THEN strlen(props) END) AS BIGINT) AS bytes_sent FROM events)""",
)
def delivery_stats(spark, folder):
    """Errors stand for failed sends, and signups for sends nobody asked for in this run."""
    failed, requested = F.col("event_type") == "error", F.col("event_type") != "signup"
    return metrics.delivery_stats(driver.events(spark, folder), failed, F.col("props"), requested)


@query(
    "user_rollup",
    f"""SELECT user_id, min(ts) AS first_seen, max(ts) AS last_seen, count(*) AS total_events,
        count(*) FILTER (event_type = 'purchase') AS total_purchases, {REVENUE} AS total_spent,
        arg_max(CASE WHEN {K} < 50 THEN 'IN' ELSE 'US' END, (ts, event_id)) AS country, arg_max(props, (ts, event_id)) AS metadata
    FROM events GROUP BY user_id""",
)
def user_rollup(spark, folder):
    return metrics.user_rollup(driver.placed(driver.events(spark, folder)))


def sales_by_country(spark, folder):
    bought = driver.of_type(with_country(spark, folder), "purchase")
    return bought.withColumn("day", F.to_date("ts")).withColumn("category", driver.feature())


PURCHASES = f"""(SELECT country, CAST(ts AS DATE) AS day, {K} AS category, value FROM {WITH_COUNTRY}
    WHERE event_type = 'purchase')"""


@query(
    "revenue_grouping_sets",
    f"""SELECT country, day, category, CAST(grouping(country, day, category) AS INTEGER) AS grouping_id,
        count(*) AS sales, {MONEY} AS revenue
    FROM {PURCHASES} GROUP BY GROUPING SETS ((country), (day), (category))""",
)
def revenue_grouping_sets(spark, folder):
    return metrics.revenue_sets(sales_by_country(spark, folder), ("country",), ("day",), ("category",))


@query(
    "revenue_rollup",
    f"""SELECT country, day, CAST(grouping(country, day) AS INTEGER) AS grouping_id, count(*) AS sales,
        {MONEY} AS revenue FROM {PURCHASES} GROUP BY ROLLUP (country, day)""",
)
def revenue_rollup(spark, folder):
    return metrics.revenue_rollup(sales_by_country(spark, folder), "country", "day")


@query(
    "revenue_cube",
    f"""SELECT p_brand, l_returnflag, year, CAST(grouping(p_brand, l_returnflag, year) AS INTEGER) AS grouping_id,
        count(*) AS sales, {MONEY} AS revenue
    FROM (SELECT p_brand, l_returnflag, CAST(year(o_orderdate) AS INTEGER) AS year, l_extendedprice AS value
          FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey)
    GROUP BY CUBE (p_brand, l_returnflag, year)""",
)
def revenue_cube(spark, folder):
    sales, parts = sales_with_parts(spark, folder)
    orders = driver.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.year("o_orderdate").alias("year")
    )
    joined = sales.join(parts, "p_partkey").join(orders, "l_orderkey")
    return metrics.revenue_cube(
        joined.withColumn("value", F.col("l_extendedprice")), "p_brand", "l_returnflag", "year"
    )


@query(
    "clicks_by_feature",
    f"SELECT {K} AS feature, count(*) AS clicks FROM events WHERE event_type = 'click' GROUP BY 1",
)
def clicks_by_feature(spark, folder):
    return metrics.clicks_by_feature(driver.events(spark, folder), driver.feature())


@query(
    "top_features",
    f"""SELECT {K} AS feature, count(*) AS clicks FROM events WHERE event_type = 'click' GROUP BY 1
    ORDER BY clicks DESC, feature LIMIT 10""",
)
def top_features(spark, folder):
    counts = metrics.clicks_by_feature(driver.events(spark, folder), driver.feature())
    return ranking.top(counts, "clicks", "feature", 10)


@query(
    "top_feature_per_day",
    f"""SELECT day, feature, clicks, CAST(rank AS INTEGER) AS rank FROM (
        SELECT *, row_number() OVER (PARTITION BY day ORDER BY clicks DESC, feature) AS rank FROM (
            SELECT CAST(ts AS DATE) AS day, {K} AS feature, count(*) AS clicks
            FROM events WHERE event_type = 'click' GROUP BY ALL)) WHERE rank <= 3""",
)
def top_feature_per_day(spark, folder):
    clicks = driver.of_type(driver.events(spark, folder), "click")
    daily = clicks.groupBy(F.to_date("ts").alias("day"), driver.feature().alias("feature"))
    return ranking.top_per_group(daily.agg(F.count("*").alias("clicks")), "day", "clicks", "feature", 3)


@query(
    "dropoff_histogram",
    f"SELECT CAST(least({K} // 10 + 1, 10) AS INTEGER) AS bucket, count(*) AS n FROM events GROUP BY 1",
)
def dropoff_histogram(spark, folder):
    return metrics.dropoff_histogram(driver.events(spark, folder), driver.feature())


@query(
    "event_mix",
    """SELECT event_type, count(*) AS n, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 2) AS share
    FROM events GROUP BY event_type""",
)
def event_mix(spark, folder):
    return metrics.event_mix(driver.events(spark, folder))


@query(
    "type_pivot",
    "SELECT CAST(ts AS DATE) AS day, "
    + ", ".join(f"count(*) FILTER (event_type = '{t}') AS \"{t}\"" for t in driver.DRIVER_TYPES)
    + " FROM events GROUP BY 1",
)
def type_pivot(spark, folder):
    return metrics.type_pivot(driver.events(spark, folder), F.to_date("ts").alias("day"), driver.DRIVER_TYPES)


@query(
    "daily_active_users",
    "SELECT CAST(ts AS DATE) AS day, count(DISTINCT user_id) AS users FROM events GROUP BY 1",
)
def daily_active_users(spark, folder):
    return metrics.daily_active_users(driver.events(spark, folder))


@query(
    "throughput_error_rate",
    """SELECT date_trunc('hour', ts) AS period, count(*) AS events, count(*) FILTER (event_type = 'error') AS errors,
        round(count(*) FILTER (event_type = 'error') * 100.0::DOUBLE / count(*), 2) AS error_rate
    FROM events GROUP BY 1""",
)
def throughput_error_rate(spark, folder):
    df = metrics.throughput(driver.events(spark, folder), "hour", F.col("event_type") == "error")
    return df.withColumn("period", F.col("period").cast("timestamp_ntz"))


GAPS = """WITH gaps AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous_ts FROM events)
"""


def with_gaps(spark, folder):
    df = driver.events(spark, folder).select("event_id", "user_id", "ts", "event_type")
    return ordered.previous_time(df, "user_id", "ts", "event_id")


@query(
    "event_gaps",
    GAPS
    + """SELECT event_id, user_id, previous_ts,
        round((epoch_us(ts) - epoch_us(previous_ts)) / 1000000.0::DOUBLE, 3) AS gap_seconds FROM gaps""",
)
def event_gaps(spark, folder):
    gaps = with_gaps(spark, folder)
    return gaps.select("event_id", "user_id", "previous_ts", F.round("gap_seconds", 3).alias("gap_seconds"))


POINTS = {"p50": 0.5, "p90": 0.9, "p99": 0.99}


def stored_gaps(spark, folder):
    """Gaps in microseconds, written once: several steps read them."""
    gaps = with_gaps(spark, folder).where(F.col("previous_ts").isNotNull())
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    path = workspace(spark, "gaps")
    gaps.select("event_type", "ts", (micros("ts") - micros("previous_ts")).alias("gap")).write.parquet(path)
    return spark.read.parquet(path)


@query(
    "gap_percentiles",
    GAPS
    + """SELECT event_type, count(*) AS n, round(quantile_cont(s, 0.5), 3) AS p50, round(quantile_cont(s, 0.9), 3) AS p90,
        round(quantile_cont(s, 0.99), 3) AS p99
    FROM (SELECT event_type, (epoch_us(ts) - epoch_us(previous_ts)) / 1000000.0::DOUBLE AS s
          FROM gaps WHERE previous_ts IS NOT NULL) GROUP BY 1""",
)
def gap_percentiles(spark, folder):
    """Percentiles of the seconds since a user's previous event."""
    result = quantiles.exact_percentiles(stored_gaps(spark, folder), "event_type", "gap", POINTS)
    return result.select("event_type", "n", *[F.round(F.col(p) / 1_000_000, 3).alias(p) for p in POINTS])


@query(
    "gap_quantile_sketches",
    GAPS
    + """SELECT event_type, count(*) AS n, true AS p50_close, true AS p90_close, true AS p99_close
    FROM gaps WHERE previous_ts IS NOT NULL GROUP BY 1""",
)
def gap_quantile_sketches(spark, folder):
    """Quantiles of the month from sketches of its days: their ranks are within 2 percent of those asked for."""
    gaps = stored_gaps(spark, folder)
    path = workspace(spark, "gap-sketches")
    quantiles.daily_quantile_sketches(gaps, F.col("gap"), "event_type").write.parquet(path)
    rough = quantiles.merged_quantiles(spark.read.parquet(path), POINTS, "event_type")
    ranked = gaps.join(rough, "event_type").groupBy("event_type").agg(
        F.count("*").alias("n"),
        *[F.avg((F.col("gap") < F.col(p)).cast("double")).alias(f"{p}_below") for p in POINTS],
        *[F.avg((F.col("gap") <= F.col(p)).cast("double")).alias(f"{p}_upto") for p in POINTS],
    )
    close = [((F.col(f"{p}_below") <= q + 0.02) & (F.col(f"{p}_upto") >= q - 0.02)).alias(f"{p}_close") for p, q in POINTS.items()]
    return ranked.select("event_type", "n", *close)


SPANS = ("week", "month")


@query(
    "active_users_by_span",
    " UNION ALL ".join(
        f"""SELECT '{unit}' AS span, CAST(date_trunc('{unit}', ts) AS DATE) AS period, event_type, count(DISTINCT user_id) AS users,
        true AS sketch_close FROM events GROUP BY ALL"""
        for unit in SPANS
    ),
)
def active_users_by_span(spark, folder):
    """Distinct users of weeks and months: exact, and from stored daily sketches, which are within 3 percent."""
    df = driver.events(spark, folder)
    path = workspace(spark, "user-sketches")
    quantiles.daily_user_sketches(df, "event_type").write.parquet(path)
    sketches = spark.read.parquet(path)
    parts = []
    for unit in SPANS:
        exact = df.groupBy(F.to_date(F.date_trunc(unit, "ts")).alias("period"), "event_type").agg(
            F.count_distinct("user_id").alias("users")
        )
        rough = quantiles.users_over(sketches, unit, "event_type").withColumnRenamed("users", "_rough")
        close = F.abs(F.col("_rough") - F.col("users")) <= F.greatest(F.lit(1.0), 0.03 * F.col("users"))
        both = exact.join(rough, ["period", "event_type"])
        parts.append(both.select(F.lit(unit).alias("span"), "period", "event_type", "users", close.alias("sketch_close")))
    return parts[0].unionAll(parts[1])


@query(
    "payload_bytes",
    """SELECT event_type, count(*) AS events, CAST(sum(strlen(props)) AS BIGINT) AS total_bytes,
        round(avg(strlen(props)), 3) AS mean_bytes FROM events GROUP BY 1""",
)
def payload_bytes(spark, folder):
    return metrics.payload_bytes(driver.events(spark, folder), F.col("props"), "event_type")


def sessions_sql(gap: str) -> str:
    return f"""WITH f AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL {gap}
        THEN 0 ELSE 1 END AS brk FROM events),
    g AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY ts) AS sid FROM f)
    """


@query(
    "gap_sessions",
    sessions_sql("30 MINUTE")
    + """SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS n
    FROM g GROUP BY user_id, sid""",
)
def gap_sessions(spark, folder):
    sessions = timewindows.gap_sessions(driver.events(spark, folder), "30 minutes")
    return sessions.select("user_id", "session_start", "session_end", "n")


@query(
    "session_edges",
    sessions_sql("12 HOUR")
    + """SELECT user_id, min(ts) AS session_start, max(ts) AS last_event, count(*) AS n,
        arg_min(event_type, (ts, event_id)) AS first_type, arg_max(event_type, (ts, event_id)) AS last_type
    FROM g GROUP BY user_id, sid""",
)
def session_edges(spark, folder):
    return timewindows.session_edges(driver.events(spark, folder), "12 hours")


@query(
    "session_timeline",
    """SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n, min(ts) AS session_start, max(ts) AS last_event,
        arg_min(event_type, (ts, event_id)) = 'signup' AS opens_with_login,
        arg_max(event_type, (ts, event_id)) = 'error' AS closes_with_logout, 0::BIGINT AS out_of_order
    FROM events GROUP BY ALL""",
)
def session_timeline(spark, folder):
    """Sessions by id (here a user's day), their rows laid out in time order, and their shape."""
    wide = driver.clean_events(driver.events(spark, folder))
    numbered = wide.withColumn("event_id", F.col("event_id").cast("bigint"))
    rows = timewindows.timeline(numbered)
    shape = timewindows.session_shape(rows).join(timewindows.out_of_order(rows), "session_id")
    owner = wide.select("session_id", "user_id").distinct()
    return shape.join(owner, "session_id").select(
        F.regexp_extract("user_id", r"(\d+)", 1).cast("bigint").alias("user_id"),
        F.to_date("session_start").alias("day"),
        "n",
        F.col("session_start").cast("timestamp_ntz").alias("session_start"),
        F.col("last_event").cast("timestamp_ntz").alias("last_event"),
        "opens_with_login",
        "closes_with_logout",
        "out_of_order",
    )


@query(
    "rapid_purchases",
    """SELECT * FROM (SELECT event_id, user_id, ts, count(*) OVER (PARTITION BY user_id ORDER BY ts
        RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND CURRENT ROW) AS purchases_in_reach
    FROM events WHERE event_type = 'purchase') WHERE purchases_in_reach >= 3""",
)
def rapid_purchases(spark, folder):
    bought = driver.of_type(driver.events(spark, folder), "purchase").select("event_id", "user_id", "ts")
    counted = ordered.trailing_count(bought, "user_id", "ts", "24 hours", "purchases_in_reach")
    return counted.where(F.col("purchases_in_reach") >= 3).select("event_id", "user_id", "ts", "purchases_in_reach")


@query(
    "running_spend",
    """SELECT event_id, user_id, CAST(sum(CAST(value AS DECIMAL(15,2))) OVER (PARTITION BY user_id
        ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS DECIMAL(25,2)) AS spent
    FROM events WHERE event_type = 'purchase'""",
)
def running_spend(spark, folder):
    bought = driver.of_type(driver.events(spark, folder), "purchase").select("event_id", "user_id", "ts", "value")
    summed = ordered.running_total(bought, "user_id", "ts", "event_id", money(F.col("value")), "spent")
    return summed.select("event_id", "user_id", F.col("spent").cast("decimal(25,2)").alias("spent"))


@query(
    "spend_rank",
    f"""WITH u AS (SELECT user_id, {MONEY} AS spent FROM events WHERE event_type = 'purchase' GROUP BY 1)
    SELECT user_id, spent, rank() OVER o AS rank, dense_rank() OVER o AS dense_rank,
        round(percent_rank() OVER o, 6) AS percent_rank, CAST(ceil(cume_dist() OVER o * 4) AS INTEGER) AS quartile
    FROM u WINDOW o AS (ORDER BY spent DESC)""",
)
def spend_rank(spark, folder):
    bought = driver.of_type(driver.events(spark, folder), "purchase")
    spent = bought.groupBy("user_id").agg(total_money(F.col("value")).alias("spent"))
    ranked = ranking.rank_all(spent, "spent")
    return ranked.withColumn("percent_rank", F.round("percent_rank", 6))


@query(
    "daily_trend",
    """WITH d AS (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS events FROM events GROUP BY ALL)
    SELECT event_type, day, events, events - lag(events) OVER o AS change,
        round(avg(events) OVER (o ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 3) AS weekly_mean
    FROM d WINDOW o AS (PARTITION BY event_type ORDER BY day)""",
)
def daily_trend(spark, folder):
    daily = metrics.breakdown(driver.events(spark, folder).withColumn("day", F.to_date("ts")), "event_type", "day")
    return metrics.daily_trend(daily.withColumnRenamed("n", "events"), "event_type", "events")


@query(
    "top_customers",
    f"""SELECT user_id, {MONEY} AS spent FROM events WHERE event_type = 'purchase' GROUP BY 1
    ORDER BY spent DESC, user_id LIMIT 20""",
)
def top_customers(spark, folder):
    bought = driver.of_type(driver.events(spark, folder), "purchase")
    spent = bought.groupBy("user_id").agg(total_money(F.col("value")).alias("spent"))
    return ranking.top(spent, "spent", "user_id", 20)


@query(
    "latest_events",
    "SELECT event_id, ts, user_id, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 5",
)
def latest_events(spark, folder):
    return lookup.latest(driver.events(spark, folder).select("event_id", "ts", "user_id", "event_type"), 5)


@query(
    "tumbling_counts",
    """SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end,
        event_type, count(*) AS n FROM events GROUP BY ALL""",
)
def tumbling_counts(spark, folder):
    return timewindows.windowed_counts(driver.events(spark, folder), "1 day", None, "event_type")


@query(
    "sliding_counts",
    """SELECT time_bucket(INTERVAL 6 HOUR, ts) - k * INTERVAL 6 HOUR AS window_start,
        time_bucket(INTERVAL 6 HOUR, ts) - k * INTERVAL 6 HOUR + INTERVAL 1 DAY AS window_end, count(*) AS n
    FROM events, range(4) r(k) GROUP BY ALL""",
)
def sliding_counts(spark, folder):
    return timewindows.windowed_counts(driver.events(spark, folder), "1 day", "6 hours")
