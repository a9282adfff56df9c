"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.tables import stored


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every vertex of ``edges`` (a, b); the component is its least id.

    Rounds of contraction: each label hooks on the neighbour of least random rank, if that is
    below its own, and takes over the hook of that neighbour. The share of edges that
    stay between different labels falls by a constant factor each round, also on long paths.
    Neighbours are reduced by a minimum before the shuffle, so vertices of high degree do no
    harm. Loops, repeated edges and edges with a null end are allowed and change nothing.
    """
    edges = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).na.drop()
    both = edges.union(edges.select("b", "a"))
    labels = stored(both.select(F.col("a").alias("id")).distinct().withColumn("label", F.col("id")), "labels")
    links = stored(both.where("a <> b").distinct(), "links")
    turn = 0
    while links.limit(1).count():
        turn += 1
        rank = lambda c: F.struct(F.xxhash64(F.lit(turn), c).alias("rank"), F.col(c).alias("label"))  # noqa: B023, E731
        least = links.groupBy("a").agg(F.min(rank("b")).alias("least"))
        hooks = least.where(F.col("least") < rank("a")).select(F.col("a").alias("label"), F.col("least.label").alias("next"))
        hooks = stored(hooks, "hooks")
        far = hooks.select(F.col("label").alias("next"), F.col("next").alias("second"))
        hooks = stored(hooks.join(far, "next", "left").select("label", F.coalesce("second", "next").alias("next")), "jumps")
        labels = stored(labels.join(hooks, "label", "left").select("id", F.coalesce("next", "label").alias("label")), "labels")
        for end in ("a", "b"):
            to = hooks.select(F.col("label").alias(end), F.col("next").alias("to"))
            other = "b" if end == "a" else "a"
            links = links.join(to, end, "left").select(F.coalesce("to", end).alias(end), other)
        links = stored(links.where("a <> b").select("a", "b").distinct(), "links")
    names = labels.groupBy("label").agg(F.min("id").alias("component"))
    return labels.join(names, "label").select("id", "component")
