"""Queries on anomalies, user features and churn."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom.functions.scalar import interval
from eventloom.operators import anomalies, churn, enrich, forest, ordered
from eventloom.plans import driver
from eventloom.plans.registry import query
from eventloom.session import workspace
from eventloom.sources.files import spread

K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
Z_SQL = """WITH s AS (SELECT event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(15,2))) AS DOUBLE) AS s,
    CAST(sum(CAST(value AS DECIMAL(15,2)) * CAST(value AS DECIMAL(15,2))) AS DOUBLE) AS q FROM events GROUP BY 1),
z AS (SELECT e.*, (e.value - s.s / s.n) / sqrt((s.q - s.s * s.s / s.n) / (s.n - 1)) AS z
    FROM events e JOIN s USING (event_type))
"""


@query(
    "anomaly_zscore",
    Z_SQL + "SELECT event_id, user_id, event_type, value, round(z, 6) AS z FROM z WHERE z > 3",
)
def anomaly_zscore(spark, folder):
    df = driver.events(spark, folder)
    scored = anomalies.with_z_score(df, anomalies.baseline_map(anomalies.value_baseline(df))).where(F.col("z") > anomalies.Z_LIMIT)
    return scored.select("event_id", "user_id", "event_type", "value", F.round("z", 6).alias("z"))


HOURS_SQL = """h AS (SELECT user_id, CAST(hour(ts) AS INTEGER) AS hour, count(*) AS hour_events FROM events GROUP BY ALL),
shares AS (SELECT *, CAST(sum(hour_events) OVER (PARTITION BY user_id) AS BIGINT) AS user_events FROM h)
"""


@query(
    "unusual_hour",
    "WITH "
    + HOURS_SQL
    + """SELECT event_id, e.user_id, hour, hour_events, user_events
    FROM events e JOIN shares s ON e.user_id = s.user_id AND hour(e.ts) = s.hour
    WHERE hour_events::DOUBLE / user_events <= 0.02 AND user_events >= 20""",
)
def unusual_hour(spark, folder):
    rare = anomalies.unusual_hours(driver.events(spark, folder), max_share=0.02, min_events=20)
    return rare.select("event_id", "user_id", "hour", "hour_events", "user_events")


@query(
    "unusual_location",
    f"""WITH e AS (SELECT event_id, user_id, CASE WHEN {K} >= 90 THEN 'ABROAD' ELSE n_name END AS country
        FROM events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey),
    c AS (SELECT user_id, country, count(*) AS n FROM e GROUP BY ALL),
    home AS (SELECT user_id, arg_min(country, (-n, country)) AS home_country FROM c GROUP BY 1)
    SELECT event_id, user_id, country, home_country FROM e JOIN home USING (user_id) WHERE country <> home_country""",
)
def unusual_location(spark, folder):
    """Events from a country other than the user's usual one; some are moved abroad first."""
    joined = enrich.with_users(driver.events(spark, folder), driver.users(spark, folder))
    moved = joined.withColumn("country", F.when(driver.feature() >= 90, "ABROAD").otherwise(F.col("country")))
    found = anomalies.unusual_locations(moved.select("event_id", "user_id", "country"))
    return found.select("event_id", "user_id", "country", "home_country")


# Events with the country of their user, some moved abroad, and some that state a score of their own.
PLACED_SQL = f"""placed AS (SELECT e.*, {K} AS k, CASE WHEN {K} >= 90 THEN 'ABROAD' ELSE n_name END AS country,
        CASE WHEN {K} >= 97 THEN {K} / 100.0::DOUBLE END AS stated
    FROM events e LEFT JOIN customer ON user_id = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey)"""
RULES_SQL = """SELECT event_id, user_id, greatest(CASE WHEN high_value THEN 0.95 WHEN bulk OR rapid THEN 0.85 WHEN odd_hour OR away THEN 0.8
            ELSE 0 END::DOUBLE, coalesce(stated, 0)) AS score, high_value OR bulk OR rapid OR odd_hour OR away OR coalesce(stated >= 0.7, false) AS flagged,
        concat_ws(',', CASE WHEN high_value THEN 'high_value' END, CASE WHEN bulk THEN 'bulk' END,
            CASE WHEN rapid THEN 'rapid_purchases' END, CASE WHEN odd_hour THEN 'unusual_hour' END,
            CASE WHEN away THEN 'unusual_location' END, CASE WHEN stated >= 0.7 THEN 'stated' END) AS rules
    FROM hits"""


def placed_events(spark, folder, df):
    """Events with country and metadata: those with ``k`` of 90 or more come from abroad, those with 97 or more state a score."""
    joined = enrich.with_users(df, driver.users(spark, folder).select("user_id", "country"))
    k = driver.feature()
    own = F.concat(F.lit('{"anomaly_score": '), (k / 100).cast("string"), F.lit("}"))
    return joined.withColumns(
        {"country": F.when(k >= 90, "ABROAD").otherwise(F.col("country")), "metadata": F.when(k >= 97, own).otherwise(F.col("props"))}
    )


@query(
    "anomaly_score",
    Z_SQL
    + ", "
    + HOURS_SQL
    + ", "
    + PLACED_SQL
    + """, r AS (SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts
        RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND CURRENT ROW) AS rapid FROM events WHERE event_type = 'purchase'),
    c AS (SELECT user_id, country, count(*) AS n FROM placed GROUP BY ALL),
    home AS (SELECT user_id, arg_min(country, (-n, country)) AS home_country FROM c GROUP BY 1),
    hits AS (SELECT z.event_id, z.user_id, z.z > 3 AS high_value, k + 1 >= 50 AND z.event_type = 'purchase' AS bulk,
        coalesce(rapid >= 3, false) AS rapid, hour_events::DOUBLE / user_events <= 0.02 AND user_events >= 20 AS odd_hour,
        country <> home_country AS away, stated
        FROM z JOIN placed USING (event_id) LEFT JOIN r USING (event_id) JOIN home ON home.user_id = z.user_id
            JOIN shares s ON z.user_id = s.user_id AND hour(z.ts) = s.hour)
    """
    + RULES_SQL,
)
def anomaly_score(spark, folder):
    """All rules on all events; quantity is ``k + 1`` for purchases.

    Purchases and the rest go through branches of their own, as only the former need an order in time;
    habits come in by one join with a row per user.
    """
    df = placed_events(spark, folder, driver.events(spark, folder))
    is_purchase = F.coalesce(F.col("event_type") == "purchase", F.lit(False))
    bought = ordered.trailing_count(df.where(is_purchase), "user_id", "ts", "24 hours", "rapid")
    both = bought.unionByName(df.where(~is_purchase), allowMissingColumns=True)
    habits = both.join(anomalies.user_profiles(df), "user_id", "left")
    known = habits.withColumn("hour_events", F.try_element_at("hours", F.hour("ts")))
    with_z = anomalies.with_z_score(known, anomalies.baseline_map(anomalies.value_baseline(driver.events(spark, folder))))
    rules = anomalies.usual_rules(is_purchase, driver.feature() + 1)
    flagged = anomalies.scored(with_z, rules, stated=anomalies.stated_score(F.col("metadata")))
    return flagged.select("event_id", "user_id", "score", "flagged", "rules")


FOREST_FEATURES = ["value", "hour", "k"]


def forest_rows(spark, folder):
    df = spread(driver.events(spark, folder))
    return df.select("event_id", "value", F.hour("ts").alias("hour"), driver.feature().alias("k"))


@query("anomaly_iforest")
def anomaly_iforest(spark, folder):
    numbers = forest_rows(spark, folder)
    trees = forest.fit_forest(numbers, FOREST_FEATURES, "event_id")
    return forest.score_forest(numbers, trees, FOREST_FEATURES).select("event_id", "value", "isolation_score")


@query(
    "iforest_summary",
    """SELECT 100::BIGINT AS trees, least(256, count(*)) AS least_rows, least(256, count(*)) AS most_rows, true AS whole_trees
    FROM events WHERE value IS NOT NULL""",
)
def iforest_summary(spark, folder):
    """The forest itself: every tree sees a full sample of the whole table."""
    return forest.forest_summary(forest.fit_forest(forest_rows(spark, folder), FOREST_FEATURES, "event_id"))


@query(
    "user_features",
    """SELECT user_id, count(*) AS events, count(DISTINCT CAST(ts AS DATE)) AS active_days,
        count(*) FILTER (event_type = 'click') AS clicks, count(*) FILTER (event_type = 'purchase') AS purchases,
        CAST(sum(CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(15,2)) ELSE 0 END) AS DECIMAL(25,2)) AS spent,
        CAST((SELECT max(CAST(ts AS DATE)) FROM events) - max(CAST(ts AS DATE)) AS INTEGER) AS recency_days
    FROM events GROUP BY user_id""",
)
def user_features(spark, folder):
    return churn.user_features(driver.events(spark, folder))


@query(
    "churn_recency",
    """WITH l AS (SELECT user_id, max(CAST(ts AS DATE)) FILTER (event_type = 'purchase') AS last_day FROM events GROUP BY 1)
    SELECT user_id, last_day, CAST((SELECT max(CAST(ts AS DATE)) FROM events) - last_day AS INTEGER) AS days_silent,
        coalesce((SELECT max(CAST(ts AS DATE)) FROM events) - last_day >= 7, true) AS churned FROM l""",
)
def churn_recency(spark, folder):
    """Purchases are the sign of life here, as no user of this data is wholly silent for a week."""
    return churn.churn_recency(driver.events(spark, folder), F.col("event_type") == "purchase")


@query("churn_model")
def churn_model(spark, folder):
    df = driver.events(spark, folder)
    training = churn.labelled(df, F.col("event_type") == "purchase")
    model = churn.fit_churn(training, workspace(spark, "churn-model"))
    return churn.predict_churn(model, churn.user_features(df))


@query(
    "churn_evaluation",
    """WITH mark AS (SELECT max(ts) AS newest FROM events),
    users(part, user_id, churned) AS (
        SELECT 'train', user_id, count(*) FILTER (event_type = 'purchase' AND ts > newest - INTERVAL 14 DAY
            AND ts <= newest - INTERVAL 7 DAY) = 0
        FROM events, mark GROUP BY user_id HAVING min(ts) <= any_value(newest) - INTERVAL 14 DAY
        UNION ALL SELECT 'test', user_id, count(*) FILTER (event_type = 'purchase' AND ts > newest - INTERVAL 7 DAY) = 0
        FROM events, mark GROUP BY user_id HAVING min(ts) <= any_value(newest) - INTERVAL 7 DAY)
    SELECT count(*) FILTER (part = 'train') AS train_users, count(*) FILTER (part = 'train' AND churned) AS train_churned,
        count(*) FILTER (part = 'test') AS test_users, count(*) FILTER (part = 'test' AND churned) AS test_churned,
        true AS auc_known, count(*) FILTER (part = 'test') AS calibrated_users
    FROM users""",
)
def churn_evaluation(spark, folder):
    """A model of one week judged on the next: rank-sum AUC and calibration over all users of the later week."""
    df = driver.events(spark, folder)
    is_purchase = F.col("event_type") == "purchase"
    earlier = df.where(F.col("ts") <= df.agg(F.max("ts")).scalar() - interval(f"{churn.CHURN_DAYS} days"))
    newest = df.agg(F.max("ts")).scalar() - interval(f"{churn.CHURN_DAYS} days")
    training, test = churn.labelled(earlier, is_purchase, newest=newest), churn.labelled(df, is_purchase)
    path = workspace(spark, "churn-evaluation")
    training.write.parquet(f"{path}/training")
    training = spark.read.parquet(f"{path}/training")
    model = churn.fit_churn(training, f"{path}/model")
    scores = churn.predict_churn(model, test).join(test.select("user_id", "label"), "user_id")
    churn.score_table(scores).write.parquet(f"{path}/scores")
    table = spark.read.parquet(f"{path}/scores")
    judged = churn.rank_sum_auc(table)
    seen = training.agg(F.count("*").alias("train_users"), F.count_if(F.col("label") == 1).alias("train_churned"))
    bins = churn.calibration(table).agg(F.sum("n")).scalar()
    both = (F.col("positives") > 0) & (F.col("negatives") > 0)
    return judged.select(
        seen.select("train_users").scalar().alias("train_users"),
        seen.select("train_churned").scalar().alias("train_churned"),
        (F.col("positives") + F.col("negatives")).alias("test_users"),
        F.col("positives").alias("test_churned"),
        (F.col("auc").between(0, 1) | ~both).alias("auc_known"),
        bins.alias("calibrated_users"),
    )
