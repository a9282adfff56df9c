"""Per-key ordered computations that survive a hot key.

A plain ``OVER (PARTITION BY user ORDER BY ts)`` puts all rows of a user into one
task. Here a key's rows are cut into months, and a month with more than ``max_rows`` rows
into chunks of whole hours with about that many, by counts that are part of the plan: each key
and month gets chunks that fit it, whatever other keys do, and nothing runs while planning.
What comes before a row is carried in two steps, from earlier chunks of the month and
from earlier months; both are aggregates of few rows, combined on the map side. The
row-level window only ever spans one chunk. Rows of one key within one hour stay
together, sorted with spilling, however many there are.

No row is lost: rows without a key form a group of their own, as in ``PARTITION BY``, and rows
without a time come after all others of their key, as with ``NULLS LAST``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from eventloom.functions.scalar import interval, seconds_between

#: A key and month, in columns that are never null, so that plain equality finds every group.
GROUP = ["_key", "_keyless", "_month"]
CHUNK = "_chunk"
MAX_CHUNK_ROWS = 2_000_000
HOURS_OF_MONTH = 31 * 24


NO_MONTH = 2**31 - 1


def with_group(df: DataFrame, key: str, ts: str) -> DataFrame:
    kind = df.schema[key].dataType
    if isinstance(kind, NumericType):
        present = F.coalesce(F.col(key), F.lit(0).cast(kind))
    elif isinstance(kind, StringType):
        present = F.coalesce(F.col(key), F.lit(""))
    else:
        present = F.struct(key)
    month = F.coalesce(F.year(ts) * 12 + F.month(ts), F.lit(NO_MONTH))
    return df.select("*", present.alias("_key"), F.isnull(key).alias("_keyless"), month.alias("_month"))


def hour_of_month(ts: str) -> Column:
    return (F.dayofmonth(ts) - 1) * 24 + F.hour(ts)


def carries(df: DataFrame, ts: str, sums: dict, maxima: dict, max_rows: int) -> DataFrame:
    """One row per group of ``with_group``: totals and maxima over the key's earlier months, and
    ``_hours``, for each hour of a month in several chunks its chunk and what the month's earlier chunks add.
    Hours of the first chunk are null there."""
    hours = df.groupBy(*GROUP, hour_of_month(ts).alias("_hour")).agg(
        F.count("*").alias("_n"),
        *[F.sum(e).alias(n) for n, e in sums.items()],
        *[F.max(e).alias(n) for n, e in maxima.items()],
    )
    in_month = Window.partitionBy(*GROUP).orderBy(F.col("_hour").asc_nulls_last())
    rows_before = F.sum("_n").over(in_month.rowsBetween(Window.unboundedPreceding, -1))
    chunked = hours.withColumn(CHUNK, F.floor(F.coalesce(rows_before, F.lit(0)) / max_rows).cast("int"))
    chunks_before = Window.partitionBy(*GROUP).orderBy(CHUNK).rangeBetween(Window.unboundedPreceding, -1)
    added = [F.sum(n).over(chunks_before).alias(n) for n in sums] + [F.max(n).over(chunks_before).alias(n) for n in maxima]
    with_added = chunked.withColumn("_added", F.struct(CHUNK, *added))
    later = F.collect_list(F.when(F.col(CHUNK) > 0, F.struct("_hour", "_added")))
    months = with_added.groupBy(*GROUP).agg(
        *[F.sum(n).alias(n) for n in sums], *[F.max(n).alias(n) for n in maxima], later.alias("_later")
    )
    at = lambda i: F.get(F.filter("_later", lambda entry: entry["_hour"] == i), F.lit(0))["_added"]
    dense = F.transform(F.sequence(F.lit(0), F.lit(HOURS_OF_MONTH - 1)), at)
    earlier = Window.partitionBy("_key", "_keyless").orderBy("_month").rowsBetween(Window.unboundedPreceding, -1)
    return months.select(
        *GROUP,
        *[F.sum(n).over(earlier).alias(n) for n in sums],
        *[F.max(n).over(earlier).alias(n) for n in maxima],
        F.when(F.size("_later") > 0, dense).alias("_hours"),
    )


def carried_in(df: DataFrame, key: str, ts: str, sums: dict, maxima: dict, max_rows: int = MAX_CHUNK_ROWS) -> DataFrame:
    """Add, to every row, its group, its chunk, and totals and maxima over the key's earlier chunks.

    ``sums`` and ``maxima`` map a new column name to the expression to aggregate.
    """
    grouped = with_group(df, key, ts)
    before = carries(grouped, ts, sums, maxima, max_rows)
    joined = grouped.join(before, GROUP, "left")
    placed = joined.withColumn("_here", F.get("_hours", hour_of_month(ts)))
    both = lambda n, add: F.when(F.col(f"_here.{n}").isNull(), F.col(n)).otherwise(add(n)).alias(n)
    plus = lambda n: F.coalesce(F.col(n), F.lit(0)) + F.col(f"_here.{n}")
    top = lambda n: F.greatest(F.col(n), F.col(f"_here.{n}"))
    return placed.select(
        *df.columns,
        *GROUP,
        F.coalesce(F.col(f"_here.{CHUNK}"), F.lit(0)).alias(CHUNK),
        *[both(n, plus) for n in sums],
        *[both(n, top) for n in maxima],
    )


def previous_time(df: DataFrame, key: str, ts: str, tie: str, max_rows: int = MAX_CHUNK_ROWS) -> DataFrame:
    """Add ``previous_ts``, the key's preceding event time, and ``gap_seconds``."""
    carried = carried_in(df, key, ts, {}, {"_before": F.col(ts)}, max_rows)
    within = Window.partitionBy(*GROUP, CHUNK).orderBy(F.col(ts).asc_nulls_last(), tie)
    previous = F.when(F.row_number().over(within) == 1, F.col("_before")).otherwise(F.lag(ts).over(within))
    return (
        carried.withColumn("previous_ts", previous)
        .withColumn("gap_seconds", seconds_between(F.col(ts), F.col("previous_ts")))
        .drop(*GROUP, CHUNK, "_before")
    )


def running_total(
    df: DataFrame, key: str, ts: str, tie: str, amount: Column, name: str, max_rows: int = MAX_CHUNK_ROWS
) -> DataFrame:
    """Add ``name``: the key's sum of ``amount`` up to and including the row."""
    valued = df.withColumn("_amount", amount)
    carried = carried_in(valued, key, ts, {"_before": F.col("_amount")}, {}, max_rows)
    upto = Window.partitionBy(*GROUP, CHUNK).orderBy(F.col(ts).asc_nulls_last(), tie).rowsBetween(Window.unboundedPreceding, 0)
    total = F.coalesce(F.col("_before"), F.lit(0)) + F.sum("_amount").over(upto)
    return carried.withColumn(name, total).drop(*GROUP, CHUNK, "_before", "_amount")


def trailing_count(
    df: DataFrame, key: str, ts: str, horizon: str, name: str, max_rows: int = MAX_CHUNK_ROWS
) -> DataFrame:
    """Add ``name``: the key's events within ``horizon`` up to the row, both ends included.

    Every event counts +1 when it arrives and -1 once it is out of reach; the running
    sum of those steps is the count. That needs two rows per event, not a frame that
    holds a hot key's whole trailing window. Events without a time count each other.
    """
    arrivals = df.withColumn("_at", F.col(ts)).withColumn("_step", F.lit(1)).withColumn("_phase", F.lit(0))
    expiries = df.select(
        key,
        (F.col(ts) + interval(horizon)).alias("_at"),
        F.lit(-1).alias("_step"),
        F.lit(1).alias("_phase"),
    )
    steps = arrivals.unionByName(expiries, allowMissingColumns=True)
    carried = carried_in(steps, key, "_at", {"_before": F.col("_step")}, {}, max_rows)
    upto = Window.partitionBy(*GROUP, CHUNK).orderBy("_at", "_phase").rangeBetween(Window.unboundedPreceding, 0)
    count = F.coalesce(F.col("_before"), F.lit(0)) + F.sum("_step").over(upto)
    return (
        carried.withColumn(name, count)
        .where(F.col("_phase") == 0)
        .drop(*GROUP, CHUNK, "_before", "_at", "_step", "_phase")
    )
