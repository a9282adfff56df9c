"""Words, hashes and bounded slices of Arrow text columns, computed on whole byte buffers.

A word is a run of ``[^\\x20\\x09-\\x0D]``. No byte of a multi-byte UTF-8 character lies in
that range, so words are found on bytes. A null text counts as empty everywhere.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from eventloom.session import prepare

#: Text bytes of a slice; a single longer text makes a slice of its own.
SLICE_BYTES = 4_000_000

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_RANDOM = np.random.default_rng(20240229)
_BYTE_AT = _RANDOM.integers(0, 2**64, (64, 256), dtype=np.uint64)
_BLOCK = _RANDOM.integers(0, 2**64, 4096, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def tuned(spark: SparkSession) -> SparkSession:
    """Library settings, and Arrow batches of bounded bytes, which long texts need."""
    prepare(spark)
    for key, value in {
        "spark.sql.execution.arrow.maxBytesPerBatch": str(SLICE_BYTES),
        "spark.sql.execution.arrow.maxRecordsPerBatch": "20000",
    }.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finalizer: every input bit reaches every output bit; a bijection."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offsets of each; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if len(column) == 0 or column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


class Words:
    """Words of the texts of one slice: ``start`` and ``stop`` byte offsets, and per text
    the index ``first[d]`` of its first word (``first[-1]`` is the number of words).
    ``gaps`` tells which bytes lie between words."""

    def __init__(self, column, lower: bool = False, gaps: np.ndarray = SPACE):
        self.data, self.offsets = text_buffer(column)
        if lower:
            self.data = LOWER[self.data]
        inside = ~gaps[self.data]
        before = np.ones(len(inside), bool)
        before[1:] = ~inside[:-1]
        after = np.ones(len(inside), bool)
        after[:-1] = ~inside[1:]
        full = self.offsets[:-1] < self.offsets[1:]
        before[self.offsets[:-1][full]] = True
        after[self.offsets[1:][full] - 1] = True
        self.start = np.flatnonzero(inside & before)
        self.stop = np.flatnonzero(inside & after) + 1
        self.first = np.searchsorted(self.start, self.offsets)

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def doc(self) -> np.ndarray:
        """Index of the text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def array(self) -> pa.LargeStringArray:
        """The words as Arrow strings."""
        return packed(self.data, self.start, self.stop)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word: a sum of random values by byte and position."""
        if len(self) == 0:
            return np.zeros(0, np.uint64)
        length = self.stop - self.start
        begin = np.cumsum(length) - length
        place = np.arange(int(length.sum())) - np.repeat(begin, length)
        at = place + np.repeat(self.start, length)
        value = _BYTE_AT[place & 63, self.data[at]]
        if length.max() > 64:
            value *= _BLOCK[(place >> 6) & 4095]
        return mixed(np.add.reduceat(value, begin) + length.astype(np.uint64) * _BASE)

    def window_starts(self, k: int) -> np.ndarray:
        """Indices of words that start a window of ``k`` words within one text."""
        last = np.repeat(self.first[1:], self.counts)
        return np.flatnonzero(np.arange(len(self)) + k <= last)


def packed(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> pa.LargeStringArray:
    """Strings ``data[start:stop]``, laid one after another without spaces between."""
    length = stop - start
    offsets = np.zeros(len(start) + 1, np.int64)
    np.cumsum(length, out=offsets[1:])
    at = np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], length)
    return pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(data[at]))


def rolling(hashes: np.ndarray, k: int, base: np.uint64 = _BASE) -> np.ndarray:
    """Rabin-Karp value of ``k`` consecutive hashes modulo 2**64, by doubling.

    Entry i covers hashes i..i+k-1; entries that run over the end are absent.
    """
    if len(hashes) < k:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        whole, width, power = None, 0, hashes.astype(np.uint64)
        size, weight = 1, np.uint64(base)
        while True:
            if k & size:
                n = len(hashes) - width - size + 1
                whole = power[:n] if whole is None else whole[:n] * weight + power[width : width + n]
                width += size
            size *= 2
            if size > k:
                return whole
            power = power[: len(power) - size // 2] * weight + power[size // 2 :]
            weight = weight * weight


def cut(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``most`` text bytes, rows in order."""
    if batch.num_rows == 0:
        return
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = (np.cumsum(size, dtype=np.int64) - size) // most
    edges = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [batch.num_rows]])
    for begin, end in zip(edges[:-1], edges[1:], strict=True):
        yield batch.slice(begin, end - begin)


def by_slices(rows: DataFrame, function: Callable, schema: str, column: str = "text", most: int = SLICE_BYTES) -> DataFrame:
    """``function(slice) -> RecordBatch | None`` over all rows; nothing is shuffled."""

    def loop(batches):
        for batch in batches:
            for part in cut(batch, column, most):
                made = function(part)
                if made is not None and made.num_rows:
                    yield made

    return rows.mapInArrow(loop, schema)


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A list per row from flat values and the length of each list."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
