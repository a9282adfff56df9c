"""Ranked lexical search with the Best Position Algorithm on impact lists.

A term is a run of ASCII letters and digits and of characters beyond ASCII; A-Z count as a-z.
The documents are read twice at most. The first pass writes a forward index that holds, for every
document, its length and the terms that some item asks for. From it come the counts of the whole
corpus, and with them the impact of each term in each document, an integer.

The second pass deals with the index in shards: the documents of one task, a bounded number of
postings at a time. A shard lists the documents of each term by falling impact. For an item it
reads its lists from the top, in steps of doubling depth. Each document met is looked up directly
in all of the item's lists (its row of the forward index says with what impact and at what place),
so its score is final and its places count as seen. The best position of a list is the end of
its unbroken run of seen places, which direct accesses often push far beyond the place read last.
No document outside can reach the sum of the impacts that follow the best positions; reading
ends once that sum is strictly below the item's k-th score, so ties with it are still met. The k-th score is
carried on from shard to shard within a task. What the tasks found, at most k rows per item and task, is
ranked in two steps.

Nothing is dealt by a key, so no term, document or source is a hot spot, and the memory of a task
follows from ``SHARD_POSTINGS``, the items of one block and the longest document.

Rows: each row of the documents is a document of its own, also where ids repeat. A null text has no
term. Null ids come last among equal scores. Rows of one item id make one item (null ids as well),
asking for the terms of all its rows; items without a term, or without a document that scores, have
no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.tables import stored
from eventloom.llm.text import Words, by_slices, lists

#: Postings (document, term) that a shard holds at a time.
SHARD_POSTINGS = 1_000_000
#: Different (item, term) rows of the items that one pass over the documents serves.
BLOCK_TERMS = 500_000

GAPS = np.ones(256, dtype=bool)
GAPS[0x30:0x3A] = GAPS[0x41:0x5B] = GAPS[0x61:0x7B] = GAPS[0x80:] = False

INDEX = "doc_id long, n long, terms array<int>, counts array<int>"
FOUND = "item int, doc_id long, score long, task int"


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """The different (item_id, term) of the items."""
    id_type = items.schema[item_id].dataType.simpleString()

    def split(part: pa.RecordBatch) -> pa.RecordBatch:
        words = Words(part.column(1), lower=True, gaps=GAPS)
        ids = part.column(0).take(pa.array(words.doc))
        return pa.RecordBatch.from_arrays([ids, words.array().cast(pa.string())], ["item_id", "term"])

    rows = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))
    return by_slices(rows, split, f"item_id {id_type}, term string").distinct()


def forward_index(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(doc_id, n, terms, counts): number of terms of each document, and which of the sorted
    ``vocabulary`` it holds how often."""
    size = len(vocabulary)

    def index(part: pa.RecordBatch) -> pa.RecordBatch:
        words = Words(part.column(1), lower=True, gaps=GAPS)
        place = pc.index_in(words.array(), value_set=pa.array(vocabulary, pa.large_string()))
        known = place.is_valid().to_numpy(zero_copy_only=False)
        terms = place.drop_null().to_numpy(zero_copy_only=False).astype(np.int64)
        key, times = np.unique(words.doc[known] * size + terms, return_counts=True)
        per_doc = np.bincount(key // max(size, 1), minlength=part.num_rows)
        arrays = [
            part.column(0),
            pa.array(words.counts, pa.int64()),
            lists((key % max(size, 1)).astype(np.int32), per_doc, pa.int32()),
            lists(times.astype(np.int32), per_doc, pa.int32()),
        ]
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", "n", "terms", "counts"])

    return by_slices(docs.select(F.col("doc_id").cast("long"), "text"), index, INDEX)


class Shard:
    """Forward rows and impact lists of some documents.

    ``term``, ``doc`` and ``impact`` are the postings by document, the rows ``first[d]:first[d + 1]``
    being those of document d, and ``place`` is where each stands in the list of its term.
    ``list_doc`` and ``list_impact`` are all lists one after another; that of term t
    is ``begin[t]:begin[t + 1]``.
    """

    def __init__(self, ids: pa.Array, n, term, count, first, weight: np.ndarray, n_docs: int, n_terms: int):
        self.null_id = ids.is_null().to_numpy(zero_copy_only=False)
        self.ids = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)
        self.first = first
        self.doc = np.repeat(np.arange(len(n)), np.diff(first))
        self.term = term
        length = 100 - 90 + (90 * n * n_docs) // max(n_terms, 1)
        times = count.astype(np.int64)
        self.impact = weight[term] * ((1_000_000_000 * times) // (1000 * times + 8 * length[self.doc]))
        order = np.lexsort((-self.impact, term))
        self.begin = np.searchsorted(term[order], np.arange(len(weight) + 1))
        self.list_doc, self.list_impact = self.doc[order], self.impact[order]
        self.place = np.empty(len(term), np.int64)
        self.place[order] = np.arange(len(term)) - self.begin[term[order]]

    def rows_of(self, docs: np.ndarray) -> np.ndarray:
        """Places of the postings of the documents."""
        length = self.first[docs + 1] - self.first[docs]
        start = np.cumsum(length) - length
        return np.arange(int(length.sum())) + np.repeat(self.first[docs] - start, length)

    def best(self, terms: np.ndarray, k: int, least: int, lookup: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) with all that can be among the ``k`` best or score ``least`` or more.

        ``lookup`` maps terms to places in ``terms``; it comes in as -1 everywhere and leaves so.
        """
        begin, size = self.begin[terms], self.begin[terms + 1] - self.begin[terms]
        terms, begin, size = terms[size > 0], begin[size > 0], size[size > 0]
        none = np.zeros(0, np.int64)
        if len(terms) == 0 or int(self.list_impact[begin].sum()) < least:
            return none, none
        lookup[terms] = np.arange(len(terms))
        flag_begin = np.cumsum(size) - size
        seen_place = np.zeros(int(size.sum()), bool)
        best_position = np.zeros(len(terms), np.int64)
        met = np.zeros(len(self.ids), bool)
        docs, scores = [none], [none]
        kth, read, depth = least, 0, max(k, 1)
        while True:
            # Sorted access: all lists down to ``depth``.
            take = np.clip(size - read, 0, depth - read)
            start = np.cumsum(take) - take
            at = np.arange(int(take.sum())) + np.repeat(begin + read - start, take)
            new = np.unique(self.list_doc[at])
            new = new[~met[new]]
            met[new] = True
            # Direct access: impact and place of the new documents in every list of the item.
            rows = self.rows_of(new)
            which = lookup[self.term[rows]]
            rows, which = rows[which >= 0], which[which >= 0]
            seen_place[flag_begin[which] + self.place[rows]] = True
            sums = np.zeros(len(new), np.int64)
            np.add.at(sums, np.searchsorted(new, self.doc[rows]), self.impact[rows])
            docs.append(new)
            scores.append(sums)
            total = np.concatenate(scores)
            if len(total) >= k:
                kth = max(kth, int(np.partition(total, len(total) - k)[len(total) - k]))
            beyond = 0
            for i in range(len(terms)):
                rest = seen_place[flag_begin[i] + best_position[i] : flag_begin[i] + size[i]]
                run = len(rest) if len(rest) == 0 or rest.all() else int(np.argmin(rest))
                best_position[i] += run
                if best_position[i] < size[i]:
                    beyond += int(self.list_impact[begin[i] + best_position[i]])
            if beyond < kth or depth >= size.max():
                break
            read, depth = depth, 2 * depth
        lookup[terms] = -1
        docs, good = np.concatenate(docs), total >= max(kth, 1)
        return docs[good], total[good]


def shards(batches, most: int) -> Iterator[tuple]:
    """Rows of the index, gathered to about ``most`` postings."""
    waiting, held = [], 0
    for batch in batches:
        size = pc.list_value_length(batch.column("terms")).to_numpy(zero_copy_only=False).astype(np.int64)
        part = (held + np.cumsum(size) - size) // most
        edges = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [batch.num_rows]]).astype(int)
        for begin, end in zip(edges[:-1], edges[1:], strict=True):
            if begin == end:
                continue
            if held >= most:
                yield pa.Table.from_batches(waiting).combine_chunks()
                waiting, held = [], 0
            waiting.append(batch.slice(begin, end - begin))
            held += int(size[begin:end].sum())
    if waiting:
        yield pa.Table.from_batches(waiting).combine_chunks()


def ranked_in_tasks(
    index: DataFrame, asked: list[np.ndarray], weight: np.ndarray, n_docs: int, n_terms: int, k: int, most: int
) -> DataFrame:
    """(item, doc_id, score, task): the ``k`` best of every task for every item."""

    def rank(batches):
        task = TaskContext.get().partitionId()
        lookup = np.full(len(weight), -1, np.int64)
        none = np.zeros(0, np.int64)
        best = [(none, none.astype(bool), none)] * len(asked)
        for table in shards(batches, most):
            terms, counts = table.column("terms").combine_chunks(), table.column("counts").combine_chunks()
            size = pc.list_value_length(terms).to_numpy(zero_copy_only=False).astype(np.int64)
            first = np.concatenate([[0], np.cumsum(size)])
            values = [pc.list_flatten(c).to_numpy(zero_copy_only=False) for c in (terms, counts)]
            ids, n = table.column("doc_id").combine_chunks(), table.column("n").to_numpy()
            shard = Shard(ids, n, *values, first, weight, n_docs, n_terms)
            for i, wanted in enumerate(asked):
                held_id, held_null, held = best[i]
                least = int(held[-1]) if len(held) >= k else 1
                docs, scores = shard.best(wanted, k, least, lookup)
                if len(docs) == 0:
                    continue
                ids_now = np.concatenate([held_id, shard.ids[docs]])
                null_now = np.concatenate([held_null, shard.null_id[docs]])
                scores = np.concatenate([held, scores])
                order = np.lexsort((ids_now, null_now, -scores))[:k]
                best[i] = ids_now[order], null_now[order], scores[order]
        size = np.array([len(s) for _, _, s in best])
        if size.sum():
            ids, null, scores = (np.concatenate([b[j] for b in best]) for j in range(3))
            arrays = [
                pa.array(np.repeat(np.arange(len(best)), size), pa.int32()),
                pa.array(ids, pa.int64(), mask=null),
                pa.array(scores, pa.int64()),
                pa.array(np.full(len(scores), task), pa.int32()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["item", "doc_id", "score", "task"])

    return index.mapInArrow(rank, FOUND)


def weights(frequency: np.ndarray, n_docs: int) -> np.ndarray:
    """Weight of each term from the number of documents that hold it."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(f) + 1))) for f in frequency], np.int64)


def ranked(
    docs: DataFrame, items: DataFrame, k: int = 10, most: int = SHARD_POSTINGS, block_terms: int = BLOCK_TERMS
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents (doc_id, text) of every item (item_id, text).

    The items are served in blocks of about ``block_terms`` different (item, term) rows, each
    with a pass of its own over the documents; an item is never divided.
    """
    spark = docs.sparkSession
    asked = stored(item_terms(items), "search-terms")
    blocks = max(1, math.ceil(asked.count() / block_terms))
    parts = []
    for block in range(blocks):
        rows = asked if blocks == 1 else asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        by_item = rows.groupBy("item_id").agg(F.sort_array(F.collect_set("term")).alias("terms")).toArrow()
        terms = by_item.column("terms").combine_chunks() if by_item.num_rows else pa.array([], pa.list_(pa.string()))
        vocabulary = sorted(pc.unique(pc.list_flatten(terms)).to_pylist())
        index = stored(forward_index(docs, vocabulary), "search-index")
        sizes = index.agg(F.count_if(F.col("n") > 0).alias("n_docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_terms")).first()
        held = index.select(F.explode("terms").alias("term")).groupBy("term").count().toPandas()
        frequency = np.zeros(len(vocabulary), np.int64)
        frequency[held["term"].to_numpy()] = held["count"].to_numpy()
        weight = weights(frequency, sizes.n_docs)
        at = {term: i for i, term in enumerate(vocabulary)}
        wanted = [np.array([at[t] for t in row if weight[at[t]] > 0], np.int64) for row in terms.to_pylist()]
        found = ranked_in_tasks(index, wanted, weight, sizes.n_docs, sizes.n_terms, k, most)
        id_type = asked.schema["item_id"].dataType.simpleString()
        names = pa.table({"item": pa.array(range(by_item.num_rows), pa.int32()), "item_id": by_item.column("item_id")})
        named = spark.createDataFrame(names).select("item", F.col("item_id").cast(id_type).alias("item_id"))
        order = (F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        some = Window.partitionBy("item", F.col("task") % 256).orderBy(*order)
        short = found.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= k)
        whole = short.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)
        parts.append(whole.join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score"))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionAll(part)
    return result
