"""Percentiles of a measure with any number of distinct values, exact and by sketches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Slices of microseconds: hours, seconds, single values. Each step counts at most 3,600 or a million of them.
MICROS_WIDTHS = (3_600_000_000, 1_000_000, 1)
SKETCH_K = 400


def _located(counts: DataFrame, keys: list[str], wanted: Column) -> DataFrame:
    """Slices that hold a wanted rank: (group, which, offset in the slice, slice)."""
    in_order = Window.partitionBy(*keys).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumn("before", F.coalesce(F.sum("n").over(in_order), F.lit(0)))
    inside = F.filter(wanted, lambda w: (w["rank"] >= F.col("before")) & (w["rank"] < F.col("before") + F.col("n")))
    found = placed.select("group", "slice", "before", F.explode(inside).alias("w"))
    return found.select("group", F.col("w.which").alias("which"), (F.col("w.rank") - F.col("before")).alias("rank"), "slice")


def exact_percentiles(
    df: DataFrame, by: str, value: str, points: dict[str, float], widths: tuple[int, ...] = MICROS_WIDTHS
) -> DataFrame:
    """(by, n, one column per point): percentiles of the whole numbers ``value``, interpolated between neighbours.

    Ranks are located step by step: rows are counted by slices of the first width, the slices that hold a
    wanted rank are counted by slices of the next, down to single values. Every step is a count
    combined on the map side, and no task holds more than the slices of one step. ``by`` has few values: the slices
    found are handed to the next step as one value of the plan. ``df`` is read once per width, so store it if it
    is costly. Null values are left out; null groups are a group.
    """
    rows = df.select(F.col(by).alias("group"), F.col(value).cast("long").alias("v")).where(F.col("v").isNotNull())
    sliced = lambda width: F.floor(F.col("v") / F.lit(width)) if width > 1 else F.col("v")
    counts = rows.groupBy("group", sliced(widths[0]).alias("slice")).agg(F.count("*").alias("n"))
    counts = counts.withColumn("total", F.sum("n").over(Window.partitionBy("group")))
    ranks = []
    for i, p in enumerate(points.values()):
        at = F.lit(p) * (F.col("total") - 1)
        ranks += [F.struct(F.lit(2 * i).alias("which"), F.floor(at).alias("rank")), F.struct(F.lit(2 * i + 1).alias("which"), F.ceil(at).alias("rank"))]
    found = _located(counts, ["group"], F.array(*ranks))
    for last, width in zip(widths[:-1], widths[1:], strict=True):
        slices = found.agg(F.collect_list(F.struct("group", "which", "rank", "slice")).alias("s")).scalar()
        hits = F.filter("_slices", lambda s: s["group"].eqNullSafe(F.col("group")) & (s["slice"] == sliced(last)))  # noqa: B023
        near = rows.withColumn("_slices", slices).select("v", F.explode(hits).alias("h"))
        counts = near.groupBy("h.group", "h.which", "h.rank", sliced(width).alias("slice")).agg(F.count("*").alias("n"))
        found = _located(counts, ["group", "which"], F.array(F.struct("which", "rank")))
    totals = rows.groupBy("group").agg(F.count("*").alias("n"))
    ends = found.groupBy("group").agg(
        *[F.max(F.when(F.col("which") == i, F.col("slice") * widths[-1])).alias(f"_{i}") for i in range(2 * len(points))]
    )
    same = totals["group"].eqNullSafe(ends["group"])
    joined = totals.join(ends, same).select(totals["group"].alias(by), "n", *ends.columns[1:])
    columns = []
    for i, (name, p) in enumerate(points.items()):
        at = F.lit(p) * (F.col("n") - 1)
        low, high = F.col(f"_{2 * i}").cast("double"), F.col(f"_{2 * i + 1}").cast("double")
        columns.append((low + (high - low) * (at - F.floor(at))).alias(name))
    return joined.select(by, "n", *columns)


def daily_quantile_sketches(df: DataFrame, value: Column, *keys: str, ts: str = "ts") -> DataFrame:
    """(day, keys, sketch): quantile sketches of a whole-number measure, a few kilobytes each."""
    return df.where(value.isNotNull()).groupBy(F.to_date(ts).alias("day"), *keys).agg(
        F.kll_sketch_agg_bigint(value, F.lit(SKETCH_K)).alias("sketch")
    )


def merged_quantiles(sketches: DataFrame, points: dict[str, float], *keys: str) -> DataFrame:
    """Quantiles over any set of days, from their sketches alone; about 1 percent of rank off."""
    whole = sketches.groupBy(*keys).agg(F.kll_merge_agg_bigint("sketch").alias("_all"))
    return whole.select(*keys, *[F.kll_sketch_get_quantile_bigint("_all", F.lit(p)).alias(n) for n, p in points.items()])


def daily_user_sketches(df: DataFrame, *keys: str, ts: str = "ts", lg_k: int = 14) -> DataFrame:
    """(day, keys, sketch): distinct-user sketches, 16 kilobytes at most, with a standard error under 0.7 percent."""
    return df.groupBy(F.to_date(ts).alias("day"), *keys).agg(F.hll_sketch_agg("user_id", F.lit(lg_k)).alias("sketch"))


def users_over(sketches: DataFrame, unit: str, *keys: str) -> DataFrame:
    """(period, keys, users): distinct users per week, month or other unit, from the daily sketches alone."""
    period = F.to_date(F.date_trunc(unit, F.col("day"))).alias("period")
    return sketches.groupBy(period, *keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("users"))
