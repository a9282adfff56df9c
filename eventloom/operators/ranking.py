"""Top-k, top-k per group and ranks over all users."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top(df: DataFrame, by: str, tie: str, count: int) -> DataFrame:
    return df.orderBy(F.desc(by), F.asc(tie)).limit(count)


def top_per_group(df: DataFrame, group: str, by: str, tie: str, count: int) -> DataFrame:
    """Best rows of each group; Spark drops hopeless rows before the shuffle."""
    order = Window.partitionBy(group).orderBy(F.desc(by), F.asc(tie))
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def rank_all(df: DataFrame, by: str, slices: int = 200) -> DataFrame:
    """Ranks over the whole table, highest ``by`` first.

    Adds ``rank``, ``dense_rank``, ``percent_rank`` and ``quartile`` (1 is the top
    quarter by cumulative share). A global window would run in one task; instead the
    distinct values are cut into slices of about equal size, each slice is ranked on its
    own, and the sizes of the slices above (at most ``slices`` rows) are added. Rows whose ``by`` is
    null come last and share a rank, as with ``NULLS LAST``; NaN counts as the highest value.
    """
    values = df.groupBy(by).agg(F.count("*").alias("_rows"))
    as_double = values.withColumn("_key", F.col(by).cast("double"))
    shares = F.array(*[F.lit(i / slices) for i in range(1, max(slices, 2))])
    quantiles = as_double.agg(F.percentile_approx(F.nanvl("_key", F.lit(None).cast("double")), shares, F.lit(4 * slices))).first()[0]
    cuts = sorted(set(quantiles or []))
    splits = [float("-inf"), *(cuts or [0.0]), float("inf")]
    cutter = Bucketizer(splits=splits, inputCol="_key", outputCol="_slice", handleInvalid="keep")
    sliced = cutter.transform(as_double).withColumn("_slice", F.coalesce("_slice", F.lit(-1.0))).drop("_key")

    above = Window.orderBy(F.desc("_slice")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.desc("_slice")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per_slice = sliced.groupBy("_slice").agg(F.sum("_rows").alias("_r"), F.count("*").alias("_v"))
    offsets = per_slice.select(
        "_slice",
        F.coalesce(F.sum("_r").over(above), F.lit(0)).alias("_rows_above"),
        F.coalesce(F.sum("_v").over(above), F.lit(0)).alias("_values_above"),
        F.sum("_r").over(everything).alias("_all"),
    )
    inside = Window.partitionBy("_slice").orderBy(F.desc(by))
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    ranked = sliced.join(offsets, "_slice").select(
        by,
        "_all",
        "_rows",
        (F.col("_rows_above") + F.coalesce(F.sum("_rows").over(before), F.lit(0)) + 1).alias("rank"),
        (F.col("_values_above") + F.row_number().over(inside)).alias("dense_rank"),
    )
    share = (F.col("rank") + F.col("_rows") - 1) / F.col("_all")
    graded = ranked.select(
        F.col(by).alias("_by"),
        "rank",
        "dense_rank",
        F.when(F.col("_all") == 1, 0.0).otherwise((F.col("rank") - 1) / (F.col("_all") - 1)).alias("percent_rank"),
        F.ceil(share * 4).cast("int").alias("quartile"),
    )
    return df.join(graded, F.col(by).eqNullSafe(F.col("_by"))).drop("_by")
