"""Isolation forest (Liu, Ting and Zhou 2008) fitted and applied with Spark.

Every tree has its own random sample of the whole table: the ``sample`` rows with the smallest hash of
tree and row id. A smallest-k is mergeable, so each task keeps its own k rows per tree, and the
union of what tasks kept holds the samples, however the rows are partitioned. Each tree is grown from its sample in
its own task; scoring runs over all partitions of the data with the finished forest, whose size
depends on the number of trees and the sample size only.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Send these functions by value, so that executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NODE_COLUMNS = "tree int, node int, feature int, cut double, left int, right int, path double, rows int"
EULER_GAMMA = 0.5772156649015329


def mean_path(n):
    """Mean depth of an unsuccessful search in a binary tree of ``n`` rows."""
    n = np.asarray(n, dtype=float)
    big = 2.0 * (np.log(np.maximum(n - 1, 1)) + EULER_GAMMA) - 2.0 * (n - 1) / np.maximum(n, 1)
    return np.where(n > 2, big, np.where(n == 2, 1.0, 0.0))


def grow(tree: int, rows: np.ndarray, seed: int) -> list[tuple]:
    """Nodes of one tree: inner nodes carry a cut, leaves the path length they stand for; all say how many rows reached them."""
    rng = np.random.default_rng([seed, tree])
    limit = int(np.ceil(np.log2(max(len(rows), 2))))
    nodes, waiting = [], [(0, rows, 0)]
    next_node = 1
    while waiting:
        node, part, depth = waiting.pop()
        low, high = part.min(axis=0), part.max(axis=0)
        varied = np.flatnonzero(high > low)
        if depth >= limit or len(part) <= 1 or len(varied) == 0:
            nodes.append((tree, node, -1, 0.0, -1, -1, float(depth + mean_path(len(part))), len(part)))
            continue
        feature = int(rng.choice(varied))
        cut = float(rng.uniform(low[feature], high[feature]))
        goes_left = part[:, feature] <= cut
        left, right = next_node, next_node + 1
        next_node += 2
        nodes.append((tree, node, feature, cut, left, right, 0.0, len(part)))
        waiting.append((left, part[goes_left], depth + 1))
        waiting.append((right, part[~goes_left], depth + 1))
    return nodes


def tree_ranks(ids: np.ndarray, trees: int, seed: int) -> np.ndarray:
    """Random rank of every row (hashed id) in every tree: a 64-bit finalizer over both."""
    of_tree = np.random.default_rng([seed, 1]).integers(0, 2**64, trees, dtype=np.uint64)
    x = ids.astype(np.int64).view(np.uint64)[:, None] ^ of_tree[None, :]
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def tree_samples(
    df: DataFrame, features: list[str], row_id: str, trees: int = 100, sample: int = 256, seed: int = 7
) -> DataFrame:
    """(tree, rank, id, features): the sample of each tree, rows without missing features.

    ``rank`` is random per tree and ``row_id``; rows that share an id follow each other by their features.
    """
    hashed = F.xxhash64(F.lit(seed), F.col(row_id)).alias("_hash")
    numbers = [F.col(f).cast("double").alias(f) for f in features]
    rows = df.select(F.col(row_id).alias("id"), hashed, *numbers).na.drop(subset=features)
    id_type = df.schema[row_id].dataType.simpleString()
    columns = ["id", *features]

    def smallest(batches):
        task = TaskContext.get().partitionId()
        kept = pd.DataFrame({"tree": np.zeros(0, int), "rank": np.zeros(0, np.uint64)})
        bound = np.full(trees, np.iinfo(np.uint64).max)
        for batch in batches:
            for begin in range(0, len(batch), 4096):
                part = batch.iloc[begin : begin + 4096]
                ranks = tree_ranks(part["_hash"].to_numpy(), trees, seed)
                at, tree = np.nonzero(ranks <= bound)
                new = part.iloc[at][columns].assign(tree=tree, rank=ranks[at, tree])
                both = pd.concat([kept, new]) if len(kept) else new
                both = both.sort_values(["tree", "rank", *features])
                kept = both[both.groupby("tree").cumcount() < sample]
                size = kept.groupby("tree")["rank"].agg(["size", "max"])
                full = size[size["size"] == sample]
                bound[full.index.to_numpy(dtype=int)] = full["max"].to_numpy(np.uint64)
        if len(kept):
            # Signed numbers in the order of the unsigned ranks.
            signed = (kept["rank"].to_numpy(np.uint64) ^ np.uint64(1 << 63)).view(np.int64)
            yield kept.assign(rank=signed, task=task)[["tree", "rank", "task", *columns]]

    schema = f"tree int, rank long, task int, id {id_type}, " + ", ".join(f"`{f}` double" for f in features)
    found = rows.mapInPandas(smallest, schema)
    order = ["rank", *features]
    # Two steps, so that no task sees what all tasks kept for a tree.
    for keys in (["tree", F.col("task") % 64], ["tree"]):
        found = found.withColumn("_place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
        found = found.where(F.col("_place") <= sample)
    return found.drop("task", "_place")


def fit_forest(
    df: DataFrame, features: list[str], row_id: str, trees: int = 100, sample: int = 256, seed: int = 7
) -> DataFrame:
    """Forest as a table of nodes, at most ``trees * (2 * sample - 1)`` rows; without rows there are no nodes."""

    def grow_tree(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        in_order = group.sort_values(["rank", *features])
        nodes = grow(int(key[0]), in_order[features].to_numpy(), seed)
        return pd.DataFrame(nodes, columns=[c.split()[0] for c in NODE_COLUMNS.split(", ")])

    samples = tree_samples(df, features, row_id, trees, sample, seed)
    return samples.groupBy("tree").applyInPandas(grow_tree, NODE_COLUMNS)


def forest_summary(forest: DataFrame) -> DataFrame:
    """One row: trees, least and most rows of a tree's sample, and whether every tree has one leaf more than cuts."""
    per_tree = forest.groupBy("tree").agg(
        F.max(F.when(F.col("node") == 0, F.col("rows"))).alias("rows"),
        F.count_if(F.col("feature") < 0).alias("leaves"),
        F.count_if(F.col("feature") >= 0).alias("cuts"),
        F.sum(F.when(F.col("feature") < 0, F.col("rows"))).alias("in_leaves"),
    )
    return per_tree.agg(
        F.count("*").alias("trees"),
        F.min("rows").cast("long").alias("least_rows"),
        F.max("rows").cast("long").alias("most_rows"),
        F.coalesce(F.every((F.col("leaves") == F.col("cuts") + 1) & (F.col("in_leaves") == F.col("rows"))), F.lit(True)).alias("whole_trees"),
    )


def score_forest(df: DataFrame, forest: DataFrame, features: list[str]) -> DataFrame:
    """Add ``isolation_score`` in (0, 1); higher is more isolated, NULL without features or trees."""
    nodes = forest.orderBy("tree", "node").toPandas()
    trees = [
        tuple(part[c].to_numpy() for c in ("feature", "cut", "left", "right", "path"))
        for _, part in nodes.groupby("tree")
    ]
    if not trees:
        return df.withColumn("isolation_score", F.lit(None).cast("double"))
    roots = nodes[nodes["node"] == 0]["rows"]
    scale = max(float(mean_path(roots.max())), 1.0)

    @F.pandas_udf("double")
    def isolation(*columns: pd.Series) -> pd.Series:
        values = np.column_stack([c.to_numpy(dtype=float) for c in columns])
        depth = np.zeros(len(values))
        for feature, cut, left, right, path in trees:
            at = np.zeros(len(values), dtype=int)
            moving = np.flatnonzero(feature[at] >= 0)
            while len(moving):
                here = at[moving]
                goes_left = values[moving, feature[here]] <= cut[here]
                at[moving] = np.where(goes_left, left[here], right[here])
                moving = moving[feature[at[moving]] >= 0]
            depth += path[at]
        score = np.power(2.0, -depth / (len(trees) * scale))
        return pd.Series(np.where(np.isnan(values).any(axis=1), np.nan, score))

    inputs = [F.col(f).cast("double") for f in features]
    return df.withColumn("isolation_score", F.nanvl(isolation(*inputs), F.lit(None).cast("double")))
