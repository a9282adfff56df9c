"""Exact top-k search by inner product: the k-th scores are located in distributed histograms.

Vectors become integers, floor(256 * x). A block of queries of bounded size goes to every task. Each
round scores all rows against the block, by a matrix product over slices of rows, and counts the
scores of every query in up to 256 equal bins of the interval in which its k-th score is
known to lie. The counts of all tasks are added up in Spark; from the top down they tell the bin that holds the k-th score, and this bin is
the interval of the next round. A task leaves out what lies below the k-th score of its own rows so far: it
is below the overall one too, so all counts that matter are complete, and a task sends at most a few
bins per query. Rounds end when every interval is one score wide or holds hardly more than
the rows still wanted. A last pass keeps the rows at or above the lower end; among rows that tie at the end of a
task's list the least ids stay, so that a score shared by millions of rows costs k rows
per task. The rest is ranked in two steps.

Nothing is dealt by a key. A task holds the block, one slice of rows and their scores.

Rows: vectors that are null, or hold null or non-finite components, take no part, neither do queries
without an id. Missing components of a shorter vector count as 0; an empty vector scores 0. Every row is a
candidate of its own, also where ids repeat; rows that share the query's id are the query's own
and no candidates. Rows of one query id make one query, with the least of their vectors. Null ids come last among equal
scores. Scores are exact; a table whose values could make scores of more than 60 bits is refused. Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.tables import stored
from eventloom.llm.text import lists

#: Components (queries x width) that a block of queries holds, 32 MB as numbers.
BLOCK_VALUES = 4_000_000
#: Scores computed at a time.
SLICE_SCORES = 4_000_000
#: Bits of a score that a round of histograms settles.
ROUND_BITS = 8


def vectors_of(df: DataFrame, id_column: str, vector: str) -> DataFrame:
    """(vec_id, v) with the vector as an array of floating-point numbers."""
    numbers = F.col(vector)
    if df.schema[vector].dataType.simpleString() not in ("array<float>", "array<double>"):
        numbers = numbers.cast("array<double>")
    return df.select(F.col(id_column).cast("long").alias("vec_id"), numbers.alias("v"))


def whole(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Ids, sizes and components, one after another, of the rows whose vector is usable."""
    column = batch.column(1)
    present = column.is_valid().to_numpy(zero_copy_only=False)
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    with np.errstate(invalid="ignore", over="ignore"):
        values = np.floor(pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(np.float64) * 256)
    row = np.repeat(np.arange(len(size)), size)
    usable = present & (np.bincount(row[~np.isfinite(values)], minlength=len(size)) == 0)
    return batch.column(0).filter(pa.array(usable)), size[usable], values[usable[row]]


def matrix(size: np.ndarray, values: np.ndarray, width: int, kind) -> np.ndarray:
    """Rows of the given sizes, shorter ones filled with zeros."""
    if (size == width).all():
        return values.reshape(len(size), width).astype(kind)
    out = np.zeros((len(size), width), kind)
    start = np.cumsum(size) - size
    out[np.repeat(np.arange(len(size)), size), np.arange(len(values)) - np.repeat(start, size)] = values
    return out


def extent(vectors: DataFrame) -> tuple[int, int]:
    """Largest number of components, and largest size of a component."""

    def measure(batches):
        width, most = 0, 0.0
        for batch in batches:
            _, size, values = whole(batch)
            width, most = max(width, int(size.max(initial=0))), max(most, float(np.abs(values).max(initial=0)))
        yield pa.RecordBatch.from_pydict({"width": pa.array([width], pa.int64()), "most": pa.array([most])})

    found = vectors.mapInArrow(measure, "width long, most double").agg(F.max("width"), F.max("most")).first()
    return found[0] or 0, int(found[1] or 0)


def usable_queries(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): one integer vector per id, the least of those that the id has."""

    def keep(batches):
        for batch in batches:
            ids, size, values = whole(batch)
            yield pa.RecordBatch.from_arrays([ids, lists(values, size, pa.float64())], ["vec_id", "v"])

    named = vectors.where(F.col("vec_id").isNotNull())
    return named.mapInArrow(keep, "vec_id long, v array<double>").groupBy("vec_id").agg(F.min("v").alias("v"))


class Block:
    """Queries of one block, and how to score rows against them."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, kind):
        self.ids, self.vectors, self.kind = ids, np.ascontiguousarray(vectors.T), kind

    def scores(self, batches):
        """(ids, null ids, scores, own) per slice of rows; ``own`` marks rows that are no candidates."""
        queries = len(self.ids)
        rows = max(1, SLICE_SCORES // max(queries, 1))
        by_id = np.argsort(self.ids, kind="stable")
        in_order = self.ids[by_id]
        for batch in batches:
            for begin in range(0, batch.num_rows, rows):
                ids, size, values = whole(batch.slice(begin, rows))
                null = ids.is_null().to_numpy(zero_copy_only=False)
                ids = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)
                product = matrix(size, values, len(self.vectors), self.kind) @ self.vectors
                own = np.zeros(product.shape, bool)
                at = np.clip(np.searchsorted(in_order, ids), 0, queries - 1)
                same = np.flatnonzero((in_order[at] == ids) & ~null)
                own[same, by_id[at[same]]] = True
                yield ids, null, product.astype(np.int64), own


LOWEST = np.iinfo(np.int64).min


def with_best(best: np.ndarray, scores: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The best scores per query (columns), as many as before, with the new ones taken in."""
    both = np.vstack([best, np.where(own, LOWEST, scores)])
    return np.partition(both, len(both) - len(best), axis=0)[len(both) - len(best) :]


def histogram(vectors: DataFrame, block: Block, low: list[int], shift: int, k: int) -> DataFrame:
    """(query, bin, n): candidates per bin of ``2**shift`` scores from ``low`` up; the last bin takes all beyond."""
    bins = 1 << ROUND_BITS
    start = np.array(low, np.int64)

    def count(batches):
        best = np.full((k, len(start)), LOWEST, np.int64)
        held: dict[int, int] = {}
        for _, _, scores, own in block.scores(batches):
            best = with_best(best, scores, own)
            row, query = np.nonzero((scores >= np.maximum(start, best.min(axis=0))) & ~own)
            at = np.minimum((scores[row, query] - start[query]) >> shift, bins)
            keys, times = np.unique(query * (bins + 1) + at, return_counts=True)
            for key, n in zip(keys.tolist(), times.tolist(), strict=True):
                held[key] = held.get(key, 0) + n
        # Drop what later slices have shown to be below the k-th score.
        floor = best.min(axis=0)
        keys = np.array(list(held), np.int64)
        times = np.array(list(held.values()), np.int64)
        if len(keys):
            query, at = keys // (bins + 1), keys % (bins + 1)
            matters = (at == bins) | (start[query] + ((at + 1) << shift) > floor[query])
            arrays = [pa.array(query[matters], pa.int32()), pa.array(at[matters], pa.int32()), pa.array(times[matters], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["query", "bin", "n"])

    counted = vectors.mapInArrow(count, "query int, bin int, n long")
    return counted.groupBy("query", "bin").agg(F.sum("n").alias("n"))


def at_or_above(vectors: DataFrame, block: Block, low: list[int], k: int) -> DataFrame:
    """(query, vec_id, score, task) of candidates that score ``low`` or more, at most ``k`` per query and task."""
    start = np.array(low, np.int64)

    def keep(batches):
        task = TaskContext.get().partitionId()
        kept = [np.zeros(0, t) for t in (np.int64, np.int64, bool, np.int64)]
        for ids, null, scores, own in block.scores(batches):
            row, query = np.nonzero((scores >= start) & ~own)
            kept = [np.concatenate(c) for c in zip(kept, (query, ids[row], null[row], scores[row, query]), strict=True)]
            order = np.lexsort((kept[1], kept[2], -kept[3], kept[0]))
            sorted_query = kept[0][order]
            place = np.arange(len(order)) - np.searchsorted(sorted_query, sorted_query)
            kept = [c[order[place < k]] for c in kept]
        query, ids, null, scores = kept
        if len(query):
            arrays = [
                pa.array(query, pa.int32()),
                pa.array(ids, pa.int64(), mask=null),
                pa.array(scores, pa.int64()),
                pa.array(np.full(len(query), task), pa.int32()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["query", "vec_id", "score", "task"])

    return vectors.mapInArrow(keep, "query int, vec_id long, score long, task int")


def lower_ends(vectors: DataFrame, block: Block, reach: list[int], k: int) -> list[int]:
    """Per query a score that at least ``k`` candidates reach, and not many more unless they tie.

    ``reach`` bounds the size of each query's scores. A query with fewer candidates gets its lowest score.
    """
    low = [-r for r in reach]
    above = [0] * len(low)
    open_ = set(range(len(low)))
    shift = max(((2 * r + 1).bit_length() for r in reach), default=0)
    while shift > 0 and open_:
        shift = max(0, shift - ROUND_BITS)
        counts: dict[int, list[tuple[int, int]]] = {}
        for query, at, n in histogram(vectors, block, low, shift, k).toPandas().itertuples(index=False):
            counts.setdefault(query, []).append((at, n))
        for query in list(open_):
            seen = 0
            for at, n in sorted(counts.get(query, []), reverse=True):
                seen += n
                if seen >= k:
                    break
            else:
                open_.discard(query)
                continue
            low[query] += at << shift
            if seen <= 4 * k:
                open_.discard(query)
    return low


def top_k(
    df: DataFrame, queries: DataFrame, k: int = 5, id_column: str = "vec_id", vector: str = "embedding", block_values: int = BLOCK_VALUES
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of ``df`` with the largest inner product for every query row."""
    spark = df.sparkSession
    vectors = vectors_of(df, id_column, vector)
    asked = stored(usable_queries(vectors_of(queries, id_column, vector)), "search-queries")
    width, most = extent(vectors)
    own_width, own_most = extent(asked.select("vec_id", F.transform("v", lambda x: x / 256).alias("v")))
    width = max(width, own_width)
    bound = most * own_most * width
    if bound >= 1 << 60:
        raise ValueError(f"inner products up to {bound} exceed 60 bits")
    # Sums of products below 2**53 are exact as doubles, whatever the order of the additions.
    kind = np.float64 if bound < 1 << 53 else np.int64
    blocks = max(1, math.ceil(asked.count() * max(width, 1) / block_values))
    parts = []
    for number in range(blocks):
        rows = asked if blocks == 1 else asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == number)
        table = rows.toArrow()
        if table.num_rows == 0:
            continue
        v = table.column("v").combine_chunks()
        size = pc.list_value_length(v).to_numpy(zero_copy_only=False).astype(np.int64)
        asking = matrix(size, pc.list_flatten(v).to_numpy(zero_copy_only=False), width, kind)
        block = Block(table.column("vec_id").to_numpy(), asking, kind)
        reach = [int(r) * most for r in np.abs(asking).sum(axis=1)]
        low = lower_ends(vectors, block, reach, k)
        found = at_or_above(vectors, block, low, k)
        order = (F.col("score").desc(), F.col("vec_id").asc_nulls_last())
        some = Window.partitionBy("query", F.col("task") % 256).orderBy(*order)
        short = found.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= k)
        last = short.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("rank") <= k)
        names = pa.table({"query": pa.array(range(table.num_rows), pa.int32()), "query_id": table.column("vec_id")})
        named = spark.createDataFrame(names)
        parts.append(last.join(F.broadcast(named), "query").select("query_id", "rank", "vec_id", "score"))
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    result = parts[0]
    for part in parts[1:]:
        result = result.unionAll(part)
    return result
