"""Rule scores for events that deviate from what is usual."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.functions.scalar import money
from eventloom.schema import ANOMALY_THRESHOLD

# Scores of the known anomaly kinds and the bulk quantity.
HIGH_VALUE_SCORE = 0.95
BULK_SCORE = 0.85
OTHER_SCORE = 0.8
BULK_QUANTITY = 50

Z_LIMIT = 3.0
RAPID_PURCHASES = 3

# Choices: a user needs this many events before an hour or a country counts as unusual.
RARE_HOUR_SHARE = 0.02
KNOWN_USER_EVENTS = 20
KNOWN_HOME_EVENTS = 5


def value_baseline(df: DataFrame, by: str = "event_type") -> DataFrame:
    """Mean and standard deviation of ``value`` per type: one row per event type.

    Sums are exact decimals, so the result does not depend on the order of rows.
    """
    amount = money(F.col("value"))
    sums = df.groupBy(by).agg(
        F.count("value").alias("_n"),
        F.sum(amount).cast("double").alias("_s"),
        F.sum(amount * amount).cast("double").alias("_q"),
    )
    variance = F.try_divide(F.col("_q") - F.col("_s") * F.col("_s") / F.col("_n"), F.col("_n") - 1)
    return sums.select(by, F.try_divide("_s", "_n").alias("mean_value"), F.sqrt(variance).alias("sd_value"))


def baseline_map(baseline: DataFrame, by: str = "event_type") -> Column:
    """The baseline, a row per event type and so a handful of rows, as one value of the plan: type -> (mean, sd)."""
    entry = F.struct(F.col(by), F.struct("mean_value", "sd_value"))
    entries = baseline.where(F.col(by).isNotNull()).agg(F.map_from_entries(F.collect_list(entry)).alias("types"))
    return entries.scalar()


def fixed_baseline(baseline: DataFrame, by: str = "event_type") -> Column:
    """The baseline as it is now, as constants: for streams, which would else compute it again for each batch."""
    entries = []
    for row in baseline.where(F.col(by).isNotNull()).collect():
        numbers = F.struct(F.lit(row.mean_value).cast("double").alias("mean_value"), F.lit(row.sd_value).cast("double").alias("sd_value"))
        entries += [F.lit(row[by]), numbers]
    return F.create_map(*entries) if entries else F.lit(None).cast("map<string,struct<mean_value:double,sd_value:double>>")


def with_z_score(df: DataFrame, types: Column, by: str = "event_type") -> DataFrame:
    """Add ``z``; ``types`` comes from ``baseline_map`` or ``fixed_baseline``. Nothing is joined or shuffled."""
    here = F.try_element_at(types, F.col(by))
    return df.withColumn("z", F.try_divide(F.col("value") - here["mean_value"], here["sd_value"]))


def hour_shares(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Share of a user's events per hour of day; 24 rows per user at most."""
    counts = df.groupBy("user_id", F.hour(ts).alias("hour")).agg(F.count("*").alias("hour_events"))
    total = F.sum("hour_events").over(Window.partitionBy("user_id"))
    return counts.withColumn("user_events", total).withColumn(
        "hour_share", F.col("hour_events") / F.col("user_events")
    )


def unusual_hours(df: DataFrame, max_share: float, min_events: int, ts: str = "ts") -> DataFrame:
    """Events in an hour of day that is rare for a user with enough history."""
    rare = hour_shares(df, ts).where((F.col("hour_share") <= max_share) & (F.col("user_events") >= min_events))
    return df.withColumn("hour", F.hour(ts)).join(rare, ["user_id", "hour"])


def home_country(df: DataFrame) -> DataFrame:
    """Most frequent country per user, alphabetical on ties."""
    counts = df.groupBy("user_id", "country").agg(F.count("*").alias("n"))
    best = F.min_by("country", F.struct(-F.col("n"), F.col("country")))
    return counts.groupBy("user_id").agg(best.alias("home_country"))


def unusual_locations(df: DataFrame) -> DataFrame:
    joined = df.join(home_country(df), "user_id")
    return joined.where(F.col("country") != F.col("home_country"))


def user_profiles(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Habits, one row per user: ``hours`` (hour of day -> events), ``user_events`` and ``home_country``."""
    cells = df.groupBy("user_id", F.hour(ts).alias("hour"), "country").agg(F.count("*").alias("n"))
    per_hour = cells.where(F.col("hour").isNotNull()).groupBy("user_id", "hour").agg(F.sum("n").alias("n"))
    hours = per_hour.groupBy("user_id").agg(
        F.map_from_entries(F.collect_list(F.struct("hour", "n"))).alias("hours"), F.sum("n").alias("user_events")
    )
    per_country = cells.where(F.col("country").isNotNull()).groupBy("user_id", "country").agg(F.sum("n").alias("n"))
    homes = per_country.groupBy("user_id").agg(F.min_by("country", F.struct(-F.col("n"), F.col("country"))).alias("home_country"))
    return hours.join(homes, "user_id", "left")


def usual_rules(is_purchase: Column, quantity: Column) -> dict[str, tuple[Column, float]]:
    """All rules on rows with ``z``, ``rapid`` (purchases within a day), ``hour_events``, ``user_events``,
    ``country`` and ``home_country``."""
    share = F.try_divide("hour_events", "user_events")
    return {
        "high_value": (F.col("z") > Z_LIMIT, HIGH_VALUE_SCORE),
        "bulk": (is_purchase & (quantity >= BULK_QUANTITY), BULK_SCORE),
        "rapid_purchases": (F.col("rapid") >= RAPID_PURCHASES, BULK_SCORE),
        "unusual_hour": ((share <= RARE_HOUR_SHARE) & (F.col("user_events") >= KNOWN_USER_EVENTS), OTHER_SCORE),
        "unusual_location": (F.col("country") != F.col("home_country"), OTHER_SCORE),
    }


def scored(
    df: DataFrame,
    rules: dict[str, tuple[Column, float]],
    threshold: float = ANOMALY_THRESHOLD,
    stated: Column | None = None,
) -> DataFrame:
    """Add ``rules``, ``score`` (the highest rule score, else 0) and ``flagged``.

    A score that the event states itself (``stated``) counts like that of a rule; it is named if it reaches the threshold.
    """
    hits = [F.when(F.coalesce(hit, F.lit(False)), F.lit(name)) for name, (hit, _) in rules.items()]
    scores = [F.when(F.coalesce(hit, F.lit(False)), F.lit(s)).otherwise(0.0) for hit, s in rules.values()]
    if stated is not None:
        hits.append(F.when(stated >= threshold, F.lit("stated")))
        scores.append(F.coalesce(stated, F.lit(0.0)))
    best = F.greatest(*scores) if len(scores) > 1 else scores[0]
    return (
        df.withColumn("rules", F.concat_ws(",", *hits))
        .withColumn("score", best)
        .withColumn("flagged", F.col("score") >= threshold)
    )


def stated_score(metadata: Column) -> Column:
    """Score a message carries in its own metadata, if any."""
    return F.get_json_object(metadata, "$.anomaly_score").try_cast("double")
