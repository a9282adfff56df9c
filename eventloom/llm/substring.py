"""Substring de-duplication: passages of ``k`` words that an earlier document holds are cut.

Every window of ``k`` consecutive words gets a Rabin-Karp hash. A word is removed if a window
over it also starts in a document with a smaller id. Windows are judged on the input.

1. *Requests.* A scan hashes all windows. A slice of texts asks once for each of its hashes, in
   the name of its smallest id with that hash; windows of larger ids are known to be repeated.
   Requests are packed into one row per slice and hash range. A row of its own tells which
   windows wait for which request; in order of the text, these numbers are nearly free.
2. *Answers.* Each hash range lies in one task: the number of ranges follows from the bytes of
   the corpus, and a hash adds one entry per slice, however many documents or places hold it.
   The task returns the requests whose hash belongs to a smaller id.
3. *Removal.* The answers of a slice become maximal intervals of word positions per document,
   which join the texts.

The hash is as wide as the corpus needs: among ``n`` windows a false match is expected less
than ``2**-8`` times.

Null, empty and short texts have no window and stay as they are. Copies of a row (same id) are
each other's equals, not earlier documents. Rows with a null id come after all others and are
equals of each other. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.text import Words, by_slices, lists, mixed, packed, rolling, tuned

#: Windows of one hash range; bounds the memory of a task that answers.
RANGE_WINDOWS = 2_000_000
#: Sorts after every document id.
LAST = np.iinfo(np.int64).max
#: Base of the second hash, which widens the first one where a corpus needs it.
SECOND = np.uint64(0xD6E8FEB86659FD93)

#: Requests of a slice to a hash range, or (range < 0) the windows of a slice with the request each waits for.
REQUESTS = (
    "range int, slice long, width int, entries int, hashes binary, ids binary, numbers binary, docs binary, keys binary, positions binary"
)
ANSWERS = "slice long, entries int, numbers binary, docs binary, keys binary, positions binary"
FOUND = "doc_id long, text_key long, starts array<int>, stops array<int>"


def hash_width(n: float) -> int:
    """Bytes of hash for fewer than ``2**-8`` expected false matches among ``n`` windows."""
    return min(16, max(8, math.ceil((2 * math.log2(max(n, 2)) + 7) / 8)))


def wide(hashes: np.ndarray, k: int, width: int) -> np.ndarray:
    """Two columns of window hashes, the second one cut to ``width - 8`` bytes."""
    low = mixed(rolling(hashes, k))
    if width <= 8:
        return np.stack([low, np.zeros_like(low)])
    return np.stack([low, mixed(rolling(mixed(hashes ^ SECOND), k, SECOND)) >> np.uint64(128 - 8 * width)])


def ids_of(batch: pa.RecordBatch, id_column: str) -> np.ndarray:
    return pc.fill_null(batch.column(id_column).cast(pa.int64()), LAST).to_numpy(zero_copy_only=False)


def runs(doc: np.ndarray, start: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows, sorted by document and start, merged into maximal (doc, start, stop) intervals."""
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + k)
    at = np.flatnonzero(fresh)
    last = np.append(at[1:], len(doc)) - 1 if len(doc) else at
    return doc[at], start[at], start[last] + k


def packed_bytes(array: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(array).tobytes())


def unpacked(value: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(value), kind)


def packed_steps(values: np.ndarray) -> bytes:
    """32-bit integers as steps, the four bytes of each in planes, which compress well."""
    steps = np.diff(values.astype(np.int32), prepend=np.int32(0))
    return packed_bytes(steps.view(np.uint8).reshape(-1, 4).T)


def steps_of(value: bytes) -> np.ndarray:
    planes = unpacked(value, np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.int32).ravel(), dtype=np.int32)


def packed_runs(ids: np.ndarray) -> bytes:
    """The values of runs of equal ids and the lengths of the runs."""
    at = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
    return packed_bytes(np.concatenate([ids[at], np.diff(np.append(at, len(ids)))]))


def runs_of(value: bytes) -> np.ndarray:
    ids, counts = unpacked(value, np.int64).reshape(2, -1)
    return np.repeat(ids, counts)


def packed_docs(row: np.ndarray, ids: np.ndarray, keys: np.ndarray) -> tuple[bytes, bytes]:
    """Ids, lengths and keys of the runs of equal ``row``."""
    at = np.flatnonzero(np.diff(row, prepend=-1))
    counts = np.diff(np.append(at, len(row)))
    return packed_bytes(np.concatenate([ids[row[at]], counts])), packed_bytes(keys[row[at]])


def docs_of(docs: bytes, keys: bytes) -> tuple[np.ndarray, np.ndarray]:
    ids, counts = unpacked(docs, np.int64).reshape(2, -1)
    return np.repeat(ids, counts), np.repeat(unpacked(keys, np.int64), counts)


def split_slice(batch: pa.RecordBatch, k: int, ranges: int, width: int) -> pa.RecordBatch | None:
    """A row with all windows of a slice, and its requests, numbered from 1 in order of the text.
    Windows known to be repeated wait for number 0."""
    words = Words(batch.column("text"))
    ids = pc.fill_null(batch.column("doc_id"), LAST).to_numpy(zero_copy_only=False)
    keys = batch.column("text_key").to_numpy()
    at = words.window_starts(k)
    if len(at) == 0:
        return None
    code, extra = wide(words.hashes(), k, width)[:, at]
    doc = words.doc[at]
    order = np.lexsort((at, ids[doc], extra, code) if width > 8 else (at, ids[doc], code))
    code, extra, owner = code[order], extra[order], ids[doc][order]
    new = np.ones(len(at), bool)
    new[1:] = (code[1:] != code[:-1]) | (extra[1:] != extra[:-1])
    group = np.cumsum(new) - 1
    code, extra, leader = code[new], extra[new], order[new]
    waits = owner == owner[new][group]
    owner = owner[new]
    rank = np.empty(len(leader), np.int32)
    rank[np.argsort(leader)] = np.arange(1, len(leader) + 1)
    number = np.zeros(len(at), np.int32)
    number[order[waits]] = rank[group[waits]]
    name = int.from_bytes(hashlib.blake2b(ids.tobytes() + keys.tobytes(), digest_size=8).digest(), "little", signed=True)
    docs, doc_keys = packed_docs(doc, ids, keys)
    rows = [(-1 - abs(name) % ranges, name, width, len(at), None, None, packed_steps(number), docs, doc_keys, packed_steps(at - words.first[doc]))]
    bucket = ((code >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int32)
    order = np.lexsort((rank, bucket))
    code, extra, owner, rank, bucket = code[order], extra[order], owner[order], rank[order], bucket[order]
    edges = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]])
    shifts = np.arange(width - 8, dtype=np.uint64) * np.uint64(8)
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        hashes = code[a:b].tobytes() + (extra[a:b, None] >> shifts).astype(np.uint8).tobytes()
        rows.append((int(bucket[a]), name, width, int(b - a), hashes, packed_runs(owner[a:b]), packed_steps(rank[a:b]), None, None, None))
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 6]
    names = [c.split()[0] for c in REQUESTS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def answer(table: pa.Table) -> pa.Table:
    """Numbers of the requests to a hash range whose hash a smaller id asked for as well, a row per slice."""
    names = [c.split()[0] for c in ANSWERS.split(", ")]
    if table.num_rows and table.column("range")[0].as_py() < 0:
        return table.select(names)
    rows = table.select(["slice", "width", "entries", "hashes", "ids", "numbers"]).to_pylist()
    parts = [[] for _ in range(4)]
    for place, row in enumerate(rows):
        n, width = row["entries"], row["width"]
        code = np.frombuffer(row["hashes"], np.uint64, n)
        tail = np.frombuffer(row["hashes"], np.uint8, offset=8 * n).reshape(n, width - 8).astype(np.uint64)
        extra = (tail << (np.arange(width - 8, dtype=np.uint64) * np.uint64(8))).sum(axis=1, dtype=np.uint64)
        row["hashes"] = None
        for part, value in zip(parts, (code, extra, runs_of(row["ids"]), np.full(n, place, np.int32)), strict=True):
            part.append(value)
    code, extra, ids, place = (np.concatenate(p) for p in parts)
    first = np.searchsorted(place, np.arange(len(rows)))
    order = np.lexsort((extra, code)) if extra.any() else np.argsort(code)
    code, extra = code[order], extra[order]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (extra[1:] != extra[:-1])
    least = np.minimum.reduceat(ids[order], np.flatnonzero(new)) if len(code) else ids
    hit = np.sort(order[ids[order] > least[np.cumsum(new) - 1]])
    made = []
    for part in np.split(hit, np.flatnonzero(np.diff(place[hit])) + 1) if len(hit) else []:
        row = rows[place[part[0]]]
        numbers = steps_of(row["numbers"])[part - first[place[part[0]]]]
        made.append((row["slice"], len(part), packed_steps(numbers), None, None, None))
    kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 4]
    columns = list(zip(*made, strict=True)) or [[]] * 6
    return pa.Table.from_arrays([pa.array(v, t) for v, t in zip(columns, kinds, strict=True)], names)


def merged(table: pa.Table, k: int) -> pa.Table:
    """Windows of one slice that wait for an answered request, as maximal intervals, a row per document.
    Equal slices have one name and are each other's equals: their windows are told once for all."""
    rows = table.to_pylist()
    windows = next(r for r in rows if r["docs"] is not None)
    number = steps_of(windows["numbers"])
    found = np.zeros(int(number.max()) + 1, bool)
    found[0] = True
    for row in rows:
        if row["docs"] is None:
            found[steps_of(row["numbers"])] = True
    at = found[number]
    ids, keys = (column[at] for column in docs_of(windows["docs"], windows["keys"]))
    where = steps_of(windows["positions"])[at]
    order = np.lexsort((where, keys, ids))
    ids, keys, where = ids[order], keys[order], where[order]
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1])
    row, start, stop = runs(np.cumsum(new) - 1, where, k)
    counts = np.bincount(row, minlength=int(new.sum()))
    columns = [pa.array(ids[new]), pa.array(keys[new]), lists(start, counts, pa.int32()), lists(stop, counts, pa.int32())]
    return pa.Table.from_arrays(columns, ["doc_id", "text_key", "starts", "stops"])


def keyed(docs: DataFrame) -> DataFrame:
    """Ids and texts with a key that separates different texts under one id."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_key"))


def repeated_intervals(docs: DataFrame, k: int = 50, hash_bytes: int | None = None) -> DataFrame:
    """Maximal intervals [start, stop) of word positions to remove: (doc_id, text_key, starts,
    stops), a row per text that has any; several equal rows of a document share theirs."""
    tuned(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # No text has more words than half its bytes; ordinary ones have a sixth.
    ranges, width = max(1, math.ceil(size / 6 / RANGE_WINDOWS)), hash_bytes or hash_width((size + 1) / 2)
    asked = by_slices(keyed(docs), lambda part: split_slice(part, k, ranges, width), REQUESTS)
    answers = asked.groupBy("range").applyInArrow(answer, ANSWERS)
    found = answers.groupBy("slice").applyInArrow(lambda table: merged(table, k), FOUND)
    # Equal rows of several slices have equal intervals, found once in each.
    return found.dropDuplicates(["doc_id", "text_key"])


def kept_slice(batch: pa.RecordBatch) -> pa.RecordBatch:
    words = Words(batch.column("text"))
    starts, stops = batch.column("starts"), batch.column("stops")
    change = np.zeros(len(words) + 1, np.int64)
    for array, by in ((starts, 1), (stops, -1)):
        flat = array.flatten().to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(batch.num_rows), pc.fill_null(pc.list_value_length(array), 0).to_numpy(zero_copy_only=False))
        np.add.at(change, flat + words.first[row], by)
    keep = np.cumsum(change[:-1]) == 0
    doc = words.doc[keep]
    counts = np.bincount(doc, minlength=batch.num_rows)
    kept = packed(words.data, words.start[keep], words.stop[keep]).cast(pa.string())
    texts = pc.binary_join(lists(kept, counts, pa.string()), " ")
    columns = [batch.column("doc_id"), pa.array(words.counts), pa.array(words.counts - counts), texts]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "kept_text"])


def without_repeats(docs: DataFrame, k: int = 50, hash_bytes: int | None = None) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_text (kept words, one space between)."""
    found = repeated_intervals(docs, k, hash_bytes)
    on = (F.coalesce(F.col("d.doc_id"), F.lit(LAST)) == F.col("f.doc_id")) & (F.col("d.text_key") == F.col("f.text_key"))
    joined = keyed(docs).alias("d").join(found.alias("f"), on, "left").select("d.doc_id", "d.text", "f.starts", "f.stops")
    return by_slices(joined, kept_slice, "doc_id long, n_words long, n_removed long, kept_text string")
