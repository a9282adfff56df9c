"""Exact percentiles, sketches, rank-sum AUC and calibration against plain computations."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.operators import churn, metrics, quantiles

POINTS = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p99": 0.99, "p100": 1.0}


def measured(seed):
    rng = random.Random(seed)
    rows = [("a", rng.randint(-10**7, 10**11)) for _ in range(500)]
    rows += [("b", 7_000_000)] * 300 + [("b", rng.randint(0, 10)) for _ in range(200)]
    return rows + [("c", 5), (None, 3), (None, 9), ("d", None), ("a", None)]


@pytest.mark.parametrize("widths", [quantiles.MICROS_WIDTHS, (1000, 1), (1,)])
def test_exact_percentiles(spark, widths):
    rows = measured(1)
    df = spark.createDataFrame(rows, "kind string, v long").repartition(5)
    found = {r.kind: r for r in quantiles.exact_percentiles(df, "kind", "v", POINTS, widths).collect()}
    assert set(found) == {"a", "b", "c", None}
    for kind, row in found.items():
        values = np.array(sorted(v for k, v in rows if k == kind and v is not None), float)
        assert row.n == len(values)
        assert [row[p] for p in POINTS] == pytest.approx([float(np.quantile(values, q)) for q in POINTS.values()], abs=1e-3)
    assert quantiles.exact_percentiles(df.where("false"), "kind", "v", POINTS).count() == 0


def test_storage_latency(spark):
    start = datetime(2024, 1, 1)
    rows = [("a", start, start + timedelta(milliseconds=10 * n)) for n in range(21)]
    rows += [("b", start, start - timedelta(seconds=2)), ("b", None, start), ("b", start, None), (None, start, start + timedelta(days=400))]
    df = spark.createDataFrame(rows, "event_type string, timestamp timestamp, created_at timestamp")
    found = {r.event_type: r for r in metrics.storage_latency(df, "event_type", POINTS).collect()}
    assert tuple(found["a"]) == ("a", 21, 0.0, 0.05, 0.1, 0.198, 0.2, 52.38, 0)
    assert tuple(found["b"])[1:3] == (1, -2.0) and tuple(found["b"])[-2:] == (100.0, 1)
    assert found[None].p100 == 400 * 86400 and found[None].within_target == 0 and len(found) == 3
    assert metrics.storage_latency(df.limit(0), "event_type", POINTS).count() == 0


def test_daily_sketches_merge(spark):
    rng = random.Random(2)
    start = datetime(2024, 1, 1)
    rows = [(start + timedelta(hours=rng.randint(0, 24 * 30)), rng.randint(1, 4000), rng.randint(0, 10**6)) for _ in range(20_000)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, user_id int, v long")
    rough = quantiles.merged_quantiles(quantiles.daily_quantile_sketches(df, F.col("v")), {"p50": 0.5, "p90": 0.9}).first()
    values = np.array([r[2] for r in rows])
    assert abs((values <= rough.p50).mean() - 0.5) < 0.02 and abs((values <= rough.p90).mean() - 0.9) < 0.02
    sketches = quantiles.daily_user_sketches(df)
    assert sketches.count() == df.select(F.to_date("ts")).distinct().count()
    for row in quantiles.users_over(sketches, "week").collect():
        exact = len({u for t, u, _ in rows if row.period <= t.date() < row.period + timedelta(days=7)})
        assert abs(row.users - exact) <= 0.03 * exact
    assert {r.period for r in quantiles.users_over(sketches, "month").collect()} == {date(2024, 1, 1)}


def test_auc_and_calibration(spark):
    rng = random.Random(6)
    rows = [(i, float(rng.random() < p), p) for i, p in enumerate([round(rng.random(), 1) for _ in range(400)])]
    scored = spark.createDataFrame(rows, "user_id int, label double, churn_probability double")
    table = churn.score_table(scored)
    good, bad = [p for _, y, p in rows if y], [p for _, y, p in rows if not y]
    expected = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    judged = churn.rank_sum_auc(table).first()
    assert (judged.positives, judged.negatives) == (len(good), len(bad))
    assert float(judged.auc) == pytest.approx(expected)
    bins = {r.bin: r for r in churn.calibration(table).collect()}
    assert sum(r.n for r in bins.values()) == 400 and max(bins) == 9
    third = [y for _, y, p in rows if 0.3 <= p < 0.4]
    assert bins[3].n == len(third) and bins[3].share == pytest.approx(np.mean(third))
    assert churn.rank_sum_auc(churn.score_table(scored.where("label = 1"))).first().auc is None
