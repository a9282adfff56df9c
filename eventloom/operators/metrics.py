"""Aggregates over users, days, features, videos, searches and deliveries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.functions.scalar import interval, percent, seconds_between, total_money, utf8_bytes
from eventloom.operators.quantiles import exact_percentiles


def is_purchase() -> Column:
    return F.col("event_type") == "purchase"


def revenue() -> Column:
    return total_money(F.when(is_purchase(), F.col("value")))


#: Columns of the users table that follow a user's newest event, where events have them.
FOLLOWED = ("country", "metadata")


def user_partials(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Sums per user that can be added up: those of ``user_rollup``, and for each followed column the time and id
    of the event its value is from."""
    followed = [c for c in FOLLOWED if c in df.columns]
    newest = [
        F.max(F.when(F.col(c).isNotNull(), F.struct(F.col(ts).alias("at"), F.col("event_id").alias("id"), F.col(c).alias("value")))).alias(c)
        for c in followed
    ]
    return df.groupBy("user_id").agg(
        F.min(ts).alias("first_seen"),
        F.max(ts).alias("last_seen"),
        F.count("*").alias("total_events"),
        F.count_if(is_purchase()).alias("total_purchases"),
        revenue().alias("total_spent"),
        *newest,
    )


def merged_partials(partials: DataFrame) -> DataFrame:
    """Partials of several batches as one per user."""
    return partials.groupBy("user_id").agg(
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
        F.sum("total_events").alias("total_events"),
        F.sum("total_purchases").alias("total_purchases"),
        F.sum("total_spent").cast("decimal(25,2)").alias("total_spent"),
        *[F.max(c).alias(c) for c in FOLLOWED if c in partials.columns],
    )


def users_of(partials: DataFrame) -> DataFrame:
    """The users table: sums, and country and metadata as the newest event that has them states them."""
    return partials.withColumns({c: F.col(f"{c}.value") for c in FOLLOWED if c in partials.columns})


def user_rollup(df: DataFrame, ts: str = "ts") -> DataFrame:
    return users_of(user_partials(df, ts))


def daily_stats(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Day x type x country: events, distinct users and revenue."""
    return df.groupBy(F.to_date(ts).alias("day"), "event_type", "country").agg(
        F.count("*").alias("events"),
        F.count_distinct("user_id").alias("users"),
        revenue().alias("revenue"),
    )


def daily_stats_by_home(df: DataFrame, users: DataFrame, ts: str = "ts") -> DataFrame:
    """Daily statistics with the country taken from the user table.

    Events are summed per user, day and type before the join, so a hot user brings a few
    rows to it instead of all its events. A user has one row per day and type, hence
    counting rows counts users.
    """
    per_user = df.groupBy("user_id", F.to_date(ts).alias("day"), "event_type").agg(
        F.count("*").alias("_events"), revenue().alias("_revenue")
    )
    return per_user.join(users.select("user_id", "country"), "user_id", "left").groupBy(
        "day", "event_type", "country"
    ).agg(
        F.sum("_events").alias("events"),
        F.count("user_id").alias("users"),
        F.sum("_revenue").cast("decimal(25,2)").alias("revenue"),
    )


def daily_active_users(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.groupBy(F.to_date(ts).alias("day")).agg(F.count_distinct("user_id").alias("users"))


def domain_profile(df: DataFrame, columns: tuple[str, ...], exact: bool = True) -> DataFrame:
    """Number of different values per column: (column_name, distinct_values).

    ``exact=False`` uses sketches, one pass and no shuffle of the values.
    """
    if not exact:
        sizes = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns])
        pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("distinct_values")) for c in columns]
        return sizes.select(F.inline(F.array(*pairs)))
    parts = [
        df.select(c).distinct().agg(F.lit(c).alias("column_name"), F.count(c).alias("distinct_values"))
        for c in columns
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionAll(part)
    return whole


def event_mix(df: DataFrame) -> DataFrame:
    """Share of each event type; the total spans one row per type."""
    counts = df.groupBy("event_type").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return counts.withColumn("share", percent(F.col("n"), total))


def type_pivot(df: DataFrame, by: Column, types: tuple[str, ...]) -> DataFrame:
    return df.groupBy(by).pivot("event_type", list(types)).count().na.fill(0)


def breakdown(df: DataFrame, *dimensions: str) -> DataFrame:
    return df.groupBy(*dimensions).agg(F.count("*").alias("n"))


def clicks_by_feature(df: DataFrame, feature: Column) -> DataFrame:
    clicks = df.where(F.col("event_type") == "click")
    return clicks.groupBy(feature.alias("feature")).agg(F.count("*").alias("clicks"))


def video_stats(df: DataFrame, completed_at: float = 90.0) -> DataFrame:
    """Watch time and completion per video."""
    watched = df.where(F.col("event_type") == "video_watch")
    return watched.groupBy("video_id").agg(
        F.count("*").alias("views"),
        F.sum("duration_seconds").alias("watch_seconds"),
        percent(F.count_if(F.col("watched_percentage") >= completed_at), F.count("*")).alias("completion_rate"),
    )


def dropoff_histogram(df: DataFrame, watched: Column, buckets: int = 10) -> DataFrame:
    """How many stop in each tenth of the video; 100 percent falls in the last one."""
    bucket = F.least(F.width_bucket(watched.cast("double"), F.lit(0.0), F.lit(100.0), F.lit(buckets)), F.lit(buckets))
    return df.groupBy(bucket.cast("int").alias("bucket")).agg(F.count("*").alias("n"))


def search_stats(df: DataFrame) -> DataFrame:
    searches = df.where(F.col("event_type") == "search")
    return searches.groupBy("query").agg(
        F.count("*").alias("searches"),
        F.round(F.avg("results_count"), 3).alias("mean_results"),
        percent(F.count_if(F.col("results_count") == 0), F.count("*")).alias("zero_result_rate"),
    )


def delivery_stats(df: DataFrame, failed: Column, payload: Column, requested: Column, ts: str = "ts") -> DataFrame:
    """Requested, sent and failed messages with both success rates.

    ``success_of_requested`` divides by what was asked for, ``success_of_finished`` by
    what was either sent or failed. Rates and throughput are 0 when undefined.
    """
    sent, lost = F.count_if(~failed), F.count_if(failed)
    elapsed = seconds_between(F.max(ts), F.min(ts))
    totals = df.agg(
        F.count_if(requested).alias("requested"),
        sent.alias("sent"),
        lost.alias("failed"),
        F.round(elapsed, 3).alias("elapsed_seconds"),
        F.coalesce(F.sum(F.when(~failed, utf8_bytes(payload))), F.lit(0)).alias("bytes_sent"),
        F.round(F.coalesce(F.try_divide(sent.cast("double"), elapsed), F.lit(0.0)), 6).alias("events_per_second"),
    )
    return totals.select(
        "*",
        percent(F.col("sent"), F.col("requested")).alias("success_of_requested"),
        percent(F.col("sent"), F.col("sent") + F.col("failed")).alias("success_of_finished"),
    )


def throughput(df: DataFrame, unit: str, is_error: Column, ts: str = "ts") -> DataFrame:
    return df.groupBy(F.date_trunc(unit, ts).alias("period")).agg(
        F.count("*").alias("events"),
        F.count_if(is_error).alias("errors"),
        percent(F.count_if(is_error), F.count("*")).alias("error_rate"),
    )


def percentiles(df: DataFrame, by: str, whole_units: Column, points: dict[str, float]) -> DataFrame:
    """Exact percentiles of a whole-number measure such as elapsed minutes.

    Equal values are counted before the final step, which therefore sees at most one
    row per group and distinct value.
    """
    counted = df.groupBy(by, whole_units.alias("_v")).agg(F.count("*").alias("_n"))
    return counted.where(F.col("_v").isNotNull()).groupBy(by).agg(
        F.sum("_n").alias("n"),
        *[F.percentile("_v", F.lit(p), F.col("_n")).alias(name) for name, p in points.items()],
    )


def storage_latency(
    stored: DataFrame,
    by: str,
    points: dict[str, float],
    target: str = "100 milliseconds",
    ts: str = "timestamp",
    created: str = "created_at",
) -> DataFrame:
    """Time from an event to its row in the store, per group: number, exact percentiles in seconds, percent
    within ``target``, and how many events carry a time after they were stored.

    Reads three columns of the stored layout. Rows without either time are left out, a null group is a group.
    """
    micros = F.unix_micros(created) - F.unix_micros(ts)
    rows = stored.select(by, micros.alias("_latency")).where(F.col("_latency").isNotNull())
    within = F.lit(0).cast("timestamp") + interval(target) >= F.timestamp_micros("_latency")
    counts = rows.groupBy(F.col(by).alias("_by")).agg(
        percent(F.count_if(within), F.count("*")).alias("within_target"), F.count_if(F.col("_latency") < 0).alias("early")
    )
    exact = exact_percentiles(rows, by, "_latency", points)
    seconds = [F.round(F.col(p) / 1_000_000, 6).alias(p) for p in points]
    return exact.join(counts, F.col(by).eqNullSafe(F.col("_by"))).select(by, "n", *seconds, "within_target", "early")


def payload_bytes(df: DataFrame, payload: Column, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count("*").alias("events"),
        F.sum(utf8_bytes(payload)).cast("bigint").alias("total_bytes"),
        F.round(F.avg(utf8_bytes(payload)), 3).alias("mean_bytes"),
    )


def daily_trend(daily: DataFrame, group: str, metric: str, day: str = "day") -> DataFrame:
    """Change against the day before and the mean of seven days, on daily rows."""
    order = Window.partitionBy(group).orderBy(day)
    week = order.rowsBetween(-6, 0)
    return daily.select(
        group,
        day,
        metric,
        (F.col(metric) - F.lag(metric).over(order)).alias("change"),
        F.round(F.avg(metric).over(week), 3).alias("weekly_mean"),
    )


def revenue_sets(df: DataFrame, *sets: tuple[str, ...]) -> DataFrame:
    """Revenue for several groupings in one pass, told apart by ``grouping_id``."""
    columns = list(dict.fromkeys(name for group in sets for name in group))
    groups = [[F.col(n) for n in group] for group in sets]
    return _subtotals(_finest(df, columns).groupingSets(groups, *[F.col(n) for n in columns]))


def revenue_rollup(df: DataFrame, *columns: str) -> DataFrame:
    return _subtotals(_finest(df, list(columns)).rollup(*columns))


def revenue_cube(df: DataFrame, *columns: str) -> DataFrame:
    return _subtotals(_finest(df, list(columns)).cube(*columns))


def _finest(df: DataFrame, columns: list[str]) -> DataFrame:
    """Sums at the finest level, so that only these rows are copied per grouping."""
    return df.groupBy(*columns).agg(F.count("*").alias("_sales"), total_money(F.col("value")).alias("_revenue"))


def _subtotals(grouped) -> DataFrame:
    return grouped.agg(
        F.grouping_id().cast("int").alias("grouping_id"),
        F.sum("_sales").alias("sales"),
        F.sum("_revenue").cast("decimal(25,2)").alias("revenue"),
    )


def lag_behind(df: DataFrame, watermark: Column, ts: str = "ts") -> DataFrame:
    """Seconds between the newest event and the watermark."""
    return df.agg(seconds_between(F.max(ts), watermark).alias("lag_seconds"))
