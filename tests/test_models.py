"""Anomaly rules, isolation forest, churn, joins, delivery figures."""

from __future__ import annotations

import json
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from eventloom.operators import anomalies, churn, dedup, enrich, forest, metrics

START = datetime(2024, 1, 1)

# The product catalog with price ranges.
PRODUCTS = [
    ("prod_001", "Laptop", "electronics", 50000, 150000),
    ("prod_002", "Phone", "electronics", 20000, 100000),
    ("prod_003", "Headphones", "electronics", 2000, 15000),
    ("prod_004", "Book", "books", 200, 1000),
    ("prod_005", "T-Shirt", "clothing", 500, 2000),
]


def test_labelled_anomalies_are_flagged(spark):
    rows = [(i, "purchase", 100.0 + i % 7, 1, "{}") for i in range(60)]
    rows += [
        (100, "purchase", 999999.99, 100, json.dumps({"anomaly_score": 0.95})),
        (101, "purchase", 103.0, 50, json.dumps({"rapid_purchase": True, "anomaly_score": 0.85})),
        (102, "page_view", None, None, json.dumps({"anomaly_type": "unusual_time", "anomaly_score": 0.8})),
        (103, "page_view", None, None, json.dumps({"anomaly_score": 0.5})),
    ]
    df = spark.createDataFrame(rows, "event_id int, event_type string, value double, quantity int, metadata string")
    scored = anomalies.scored(
        anomalies.with_z_score(df, anomalies.baseline_map(anomalies.value_baseline(df))),
        {
            "high_value": (F.col("z") > anomalies.Z_LIMIT, anomalies.HIGH_VALUE_SCORE),
            "bulk": (F.col("quantity") >= anomalies.BULK_QUANTITY, anomalies.BULK_SCORE),
            "stated": (anomalies.stated_score(F.col("metadata")) >= 0.7, anomalies.OTHER_SCORE),
        },
    )
    flagged = {r.event_id: (r.score, r.rules) for r in scored.where("flagged").collect()}
    assert flagged == {
        100: (0.95, "high_value,bulk,stated"),
        101: (0.85, "bulk,stated"),
        102: (0.8, "stated"),
    }


def test_unusual_places_and_hours(spark):
    rows = [(i, 1, "IN", START + timedelta(days=i, hours=9)) for i in range(40)] + [(99, 1, "US", START + timedelta(hours=3))]
    df = spark.createDataFrame(rows, "event_id int, user_id int, country string, ts timestamp_ntz")
    assert [r.event_id for r in anomalies.unusual_locations(df).collect()] == [99]
    assert [r.event_id for r in anomalies.unusual_hours(df, 0.05, 20).collect()] == [99]
    assert anomalies.unusual_hours(df, 0.05, 100).count() == 0


def test_forest_finds_the_outlier(spark):
    rows = [(i, float(i % 20), float(i % 11)) for i in range(2000)] + [(9999, 500.0, -300.0), (8888, None, 1.0)]
    df = spark.createDataFrame(rows, "event_id int, a double, b double")
    # The outlier enters an eighth of the samples; 30 trees of 128 rows would meet it about twice.
    nodes = forest.fit_forest(df, ["a", "b"], "event_id", trees=100, sample=256)
    assert nodes.count() <= 100 * (2 * 256 - 1)
    scored = forest.score_forest(df, nodes, ["a", "b"])
    assert scored.count() == len(rows)
    known = scored.where("isolation_score IS NOT NULL")
    # The outlier may have missed the sample; it must still stand out.
    best = known.orderBy(F.desc("isolation_score")).first()
    assert best.event_id == 9999
    assert [r.event_id for r in scored.where("isolation_score IS NULL").collect()] == [8888]


def churn_events(spark):
    rows = []
    for user in range(40):
        last_day = 29 if user < 20 else 15
        for day in range(0, last_day + 1, 1 if user < 20 else 3):
            rows.append((user * 100 + day, user, START + timedelta(days=day, hours=user % 5), "purchase", 10.0))
    return spark.createDataFrame(rows, "event_id int, user_id int, ts timestamp_ntz, event_type string, value double")


def test_churn_rule_model_and_reload(spark, tmp_path):
    df = churn_events(spark)
    alive = F.col("event_type") == "purchase"
    rule = {r.user_id: r.churned for r in churn.churn_recency(df, alive).collect()}
    assert [u for u, churned in rule.items() if churned] and all(rule[u] == (u >= 20) for u in rule)
    training = churn.labelled(df, alive)
    assert {r.user_id: r.label for r in training.collect()} == {u: float(u >= 20) for u in range(40)}
    model = churn.fit_churn(training, str(tmp_path / "model"))
    features = churn.user_features(df.where(F.col("ts") <= F.lit("2024-01-23").cast("timestamp_ntz")))
    predicted = {r.user_id: r.churn_probability for r in churn.predict_churn(model, features).collect()}
    assert min(predicted[u] for u in range(20, 40)) > max(predicted[u] for u in range(20))
    again = churn.predict_churn(churn.load_model(str(tmp_path / "model")), features)
    assert {r.user_id: r.churn_probability for r in again.collect()} == predicted


def test_features_stop_at_the_cutoff(spark):
    df = churn_events(spark)
    later = df.withColumn("value", F.when(F.col("ts") > F.lit("2024-01-24").cast("timestamp_ntz"), 1e6).otherwise(F.col("value")))
    before = churn.labelled(df, F.col("event_type") == "purchase").collect()
    assert sorted(before) == sorted(churn.labelled(later, F.col("event_type") == "purchase").collect())


def test_forest_is_the_same_for_any_partitioning(spark):
    rng = random.Random(4)
    # Many copies of the same values, ids that repeat, and rows without a feature.
    rows = [(i // 2, float(rng.choice([0, 0, 0, 1, 2])), rng.random() if i % 5 else 0.5) for i in range(3000)]
    rows += [(None, 1.0, 1.0), (5000, None, 1.0)]
    df = spark.createDataFrame(rows, "id int, a double, b double")
    nodes = [
        sorted(map(tuple, forest.fit_forest(part, ["a", "b"], "id", trees=20, sample=64).collect()))
        for part in (df.coalesce(1), df.repartition(7), df.repartition(13, "a"))
    ]
    assert nodes[0] == nodes[1] == nodes[2]
    samples = forest.tree_samples(df.repartition(5), ["a", "b"], "id", trees=20, sample=64).toPandas()
    assert (samples.groupby("tree").size() == 64).all()
    # Trees sample on their own, from all rows: about 20 * 64 draws meet many different ids.
    assert samples["id"].nunique() > 500
    ids = df.where("a IS NOT NULL").select("id", F.xxhash64(F.lit(7), "id").alias("h")).toPandas()
    ranks = forest.tree_ranks(ids["h"].to_numpy(), 20, 7)
    for tree in (0, 11):
        smallest = sorted(ranks[:, tree])[:64]
        drawn = samples[samples.tree == tree]["rank"].to_numpy().view("uint64") ^ (1 << 63)
        assert sorted(drawn) == smallest
    few = forest.fit_forest(df.limit(10), ["a", "b"], "id", trees=3, sample=64)
    summary = forest.forest_summary(few).first()
    assert (summary.trees, summary.least_rows, summary.most_rows, summary.whole_trees) == (3, 10, 10, True)
    empty = df.where("false")
    assert forest.score_forest(df, forest.fit_forest(empty, ["a", "b"], "id"), ["a", "b"]).where("isolation_score IS NOT NULL").count() == 0


def test_price_ranges(spark):
    catalog = spark.createDataFrame(PRODUCTS, "product_id string, name string, category string, low int, high int")
    sold = [("prod_001", 50000.0, True), ("prod_004", 1000.01, False), ("prod_005", 2000.0, True), ("prod_999", 1.0, False)]
    df = spark.createDataFrame(sold, "product_id string, price double, expected boolean")
    checked = enrich.price_check(df, catalog, "product_id", F.col("price"), F.col("low"), F.col("high"))
    assert checked.count() == len(sold) and checked.where("in_range <> expected").count() == 0


def test_delivery_rates_when_nothing_was_sent(spark):
    df = spark.createDataFrame([], "ts timestamp_ntz, ok boolean, body string")
    row = metrics.delivery_stats(df, ~F.col("ok"), F.col("body"), F.lit(True)).first()
    assert (row.requested, row.sent, row.failed, row.bytes_sent) == (0, 0, 0, 0)
    assert (row.events_per_second, row.success_of_requested, row.success_of_finished) == (0.0, 0.0, 0.0)


def test_copies_collapse_to_the_first(spark):
    copies = spark.range(3000).select(
        F.lit(7).alias("event_id"), (F.lit(START) + F.make_interval(secs=F.col("id"))).alias("ts"), F.col("id").alias("n")
    )
    others = spark.range(10, 20).select(F.col("id").cast("int").alias("event_id"), F.lit(START).alias("ts"), F.col("id").alias("n"))
    unique = dedup.first_delivery(copies.unionByName(others)).collect()
    assert len(unique) == 11 and [r.n for r in unique if r.event_id == 7] == [0]


def test_approximate_domain_sizes(spark):
    df = spark.range(1000).select((F.col("id") % 40).alias("a"), F.lit("x").alias("b"))
    exact = {r.column_name: r.distinct_values for r in metrics.domain_profile(df, ("a", "b")).collect()}
    rough = {r.column_name: r.distinct_values for r in metrics.domain_profile(df, ("a", "b"), exact=False).collect()}
    assert exact == {"a": 40, "b": 1} and abs(rough["a"] - 40) <= 4 and rough["b"] == 1


def test_latency_and_lag(spark):
    rows = [("a", START, START + timedelta(milliseconds=m)) for m in (10, 20, 30, 40)]
    df = spark.createDataFrame(rows, "kind string, ts timestamp_ntz, created_at timestamp_ntz")
    millis = F.round((F.unix_micros(F.col("created_at").cast("timestamp")) - F.unix_micros(F.col("ts").cast("timestamp"))) / 1000)
    assert metrics.percentiles(df, "kind", millis, {"p50": 0.5}).first().p50 == 25.0
    watermark = F.expr("timestamp_ntz'2023-12-31 23:59:00'")
    assert metrics.lag_behind(df, watermark).first().lag_seconds == 60.0
