"""Token counts of whole texts with a public tokenizer; only lengths leave the tasks.

Texts come in slices of about equal bytes. Each is cut at safe boundaries, where no token can
span: an ASCII space after a letter or another visible ASCII character. A byte-level
pre-tokenizer takes a space only together with what follows it, and no special string has a
space inside, so the pieces have the tokens of the whole. A piece that recurs in a task is
encoded once as long as a bounded memory of pieces holds it. A text without such a space is
one piece.

Null and empty texts have no tokens. A row in gives a row out; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.text import SPACE, by_slices, text_buffer, tuned

#: Distinct pieces handed to the tokenizer at once, and lengths a task remembers.
PIECES, REMEMBERED = 20_000, 1_000_000


def pieces(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte offsets where pieces start: texts and safe boundaries."""
    cut = np.zeros(len(data), bool)
    plain = (data < 0x80) & ~SPACE[data]
    # U+00C0 to U+00FF are letters but for two signs, and their first byte is 0xC3.
    accented = (data[1:] >= 0x80) & (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    plain[1:] |= accented
    cut[1:] = (data[1:] == 0x20) & plain[:-1]
    cut[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    return np.flatnonzero(cut)


def lengths(encoder, known: dict[str, int], texts: list[str]) -> np.ndarray:
    """Tokens of each piece; ``known`` keeps the lengths of short ones."""
    fresh = [t for t in texts if t not in known]
    made = {}
    for i in range(0, len(fresh), PIECES):
        part = fresh[i : i + PIECES]
        made.update(zip(part, map(len, encoder.encode_batch_fast(part, add_special_tokens=False)), strict=True))
    counts = np.array([made[t] if t in made else known[t] for t in texts], np.int64)
    if len(known) + len(made) > REMEMBERED:
        known.clear()
    known.update((t, n) for t, n in made.items() if len(t) <= 40)
    return counts


def count_slice(batch: pa.RecordBatch, encoder, known: dict[str, int]) -> pa.RecordBatch:
    data, offsets = text_buffer(batch.column("text"))
    start = pieces(data, offsets)
    edges = np.append(start, len(data))
    made = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(edges), pa.py_buffer(data)).dictionary_encode()
    each = lengths(encoder, known, made.dictionary.to_pylist())[made.indices.to_numpy()]
    total = np.concatenate([[0], np.cumsum(each)])[np.searchsorted(start, offsets)]
    columns = [batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(np.diff(total))]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens"])


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for a byte-level ``tokenizers`` file.

    ``vocabulary`` is the content of the file, which travels with the tasks.
    """
    tuned(docs.sparkSession)
    held: dict = {}

    def count(batch):
        if "encoder" not in held:
            import os

            from tokenizers import Tokenizer

            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            held["encoder"] = Tokenizer.from_str(vocabulary)
            held["encoder"].no_truncation()
            held["encoder"].no_padding()
        return count_slice(batch, held["encoder"], held.setdefault("known", {}))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counted = by_slices(rows, count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
