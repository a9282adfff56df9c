"""Toxic spans and document scores from a linear-chain conditional random field.

Labels are per document, so labelled tokens are derived first: on a bounded sample of labelled
documents, a word is toxic if one of its n-grams occurs almost only in toxic documents,
more often than the number of n-grams tried lets happen by chance. A two-state field is trained
on these tokens with their neighbourhoods and on clean text. Forward-backward marginals
over whole texts give the spans; a logistic fit on the sample turns the largest marginal and
the expected number of toxic tokens into a probability.

Null and empty texts have no token and get the score of a text without a toxic one. Without toxic or clean
training documents, or without any telling n-gram, the score of all documents is the share of toxic
training documents, or 0 without any. Every input row gives a row; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm import crf
from eventloom.llm.labels import fold, training_ids, training_texts
from eventloom.llm.text import Words, by_slices, cut, tuned

#: Bounds of the training sample: documents per class, bytes of each, and sequences of the field.
PER_CLASS, LONGEST, SEQUENCES = 2500, 40_000, 6000
#: Tokens around a toxic one, or of a clean stretch, in a training sequence.
REACH = 8
SPAN = 0.5


@dataclass
class Model:
    weights: np.ndarray  # log odds of the toxic state per feature
    moves: np.ndarray
    calibration: np.ndarray  # bias, largest marginal, expected tokens


def word_table(words: Words) -> tuple[pa.LargeStringArray, np.ndarray]:
    """Distinct words of a slice and the number of each word in it."""
    coded = words.array().dictionary_encode()
    return coded.dictionary.cast(pa.large_string()), coded.indices.to_numpy(zero_copy_only=False)


def telling(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Features that occur in toxic documents far more often than chance allows."""
    both = toxic + clean
    share = n_toxic / (n_toxic + n_clean)
    with np.errstate(divide="ignore", invalid="ignore"):
        up = np.where(toxic > 0, toxic * np.log(toxic / (both * share)), 0)
        down = np.where(clean > 0, clean * np.log(clean / (both * (1 - share))), 0)
    tried = np.cumsum(np.bincount(both)[::-1])[::-1][both]
    precise = toxic / n_toxic >= 20 * (clean + 0.25) / n_clean
    return precise & (toxic > both * share) & (up + down > np.log(np.maximum(tried, 1) / 0.5))


def fit(sample: pa.Table) -> Model | float:
    """The model, or a constant score if the sample cannot teach one."""
    label = sample.column("label").to_numpy().astype(bool)
    n_toxic, n_clean = int(label.sum()), int((~label).sum())
    if not n_toxic or not n_clean:
        return float(n_toxic > 0)
    counts = np.zeros((2, crf.DIMS), np.int64)
    slices = [part for batch in sample.combine_chunks().to_batches() for part in cut(batch, "text")]
    for part in slices:
        words = Words(part.column("text"), lower=True)
        table, index = word_table(words)
        ids, number = crf.word_features(table)
        begin = np.cumsum(number) - number
        for d, toxic in enumerate(part.column("label").to_pylist()):
            own = np.unique(index[words.first[d] : words.first[d + 1]])
            if len(own):
                at = np.repeat(begin[own] - (np.cumsum(number[own]) - number[own]), number[own]) + np.arange(number[own].sum())
                counts[int(toxic), np.unique(ids[at])] += 1
    tells = telling(counts[1], counts[0], n_toxic, n_clean)
    if not tells.any():
        return n_toxic / (n_toxic + n_clean)
    gathered, texts, labels, lengths = [], [], [], []
    rng = np.random.default_rng(11)
    share = SEQUENCES / len(label)
    for part in slices:
        words = Words(part.column("text"), lower=True)
        table, index = word_table(words)
        ids, number = crf.word_features(table)
        bad = np.maximum.reduceat(tells[ids], np.cumsum(number) - number)[index] if len(table) else np.zeros(0, bool)
        for d, toxic in enumerate(part.column("label").to_pylist()):
            first, last = words.first[d], words.first[d + 1]
            if last == first:
                continue
            found = np.flatnonzero(bad[first:last]) + first if toxic else np.zeros(0, np.int64)
            draw = rng.integers(first, last, int(share) + (rng.random() < share % 1))
            some = rng.permutation(found)[: max(2, 2 * len(draw))]
            for at in np.concatenate([some, draw]):
                a, b = max(first, at - REACH), min(last, at + REACH + 1)
                texts.append(index[a:b])
                labels.append(bad[a:b].astype(np.int64) if toxic else np.zeros(b - a, np.int64))
                lengths.append(b - a)
        if texts:  # features of the sequences of this slice
            flat = np.concatenate(texts)
            begin = np.cumsum(number) - number
            at = np.repeat(begin[flat] - (np.cumsum(number[flat]) - number[flat]), number[flat]) + np.arange(number[flat].sum())
            made = (ids[at], number[flat], np.array(lengths), np.concatenate(labels))
            gathered.append(made)
            texts, labels, lengths = [], [], []
    ids, number, lengths, labels = (np.concatenate(x) for x in zip(*gathered, strict=True))
    weights, moves = crf.fit(ids, number, lengths, labels, 2, crf.DIMS)
    model = Model((weights[:, 1] - weights[:, 0]).astype(np.float32), moves, np.zeros(3))
    inputs = np.concatenate([evidence(model, Words(part.column("text"), lower=True))[0] for part in slices])
    model.calibration = logistic(inputs, label)
    return model


def logistic(inputs: np.ndarray, label: np.ndarray, penalty: float = 1e-2) -> np.ndarray:
    """Bias and slopes of a logistic fit, slopes not below 0; Newton steps."""
    x = np.column_stack([np.ones(len(inputs)), inputs])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - label) + penalty * w
        w -= np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + penalty * np.eye(len(w)), slope) * 0.7
        w[1:] = np.maximum(w[1:], 0)
    return w


def evidence(model: Model, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Per document the log odds of its largest marginal and the log of one plus the expected
    number of likely toxic tokens; and the marginal of every token."""
    table, index = word_table(words)
    ids, number = crf.word_features(table)
    odds = crf.summed(model.weights[ids], number)[index].astype(float) if len(table) else np.zeros(0)
    first = np.zeros(len(words), bool)
    filled = words.counts > 0
    first[words.first[:-1][filled]] = True
    chance = crf.chances(odds, first, model.moves)
    most, total = np.zeros(len(words.counts)), np.zeros(len(words.counts))
    if filled.any():
        most[filled] = np.maximum.reduceat(chance, words.first[:-1][filled])
        total[filled] = np.add.reduceat(np.where(chance >= SPAN, chance, 0), words.first[:-1][filled])
    most = np.clip(most, 1e-4, 1 - 1e-4)
    return np.column_stack([np.log(most / (1 - most)), np.log1p(total)]), chance


def score_slice(batch: pa.RecordBatch, model: Model | float) -> pa.RecordBatch:
    spans = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("chance", pa.float64())]))
    names = ["doc_id", "score", "spans"]
    if not isinstance(model, Model):
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.full(batch.num_rows, model)), pa.array([[]] * batch.num_rows, spans)], names)
    words = Words(batch.column("text"), lower=True)
    inputs, chance = evidence(model, words)
    score = 1 / (1 + np.exp(-np.clip(model.calibration[0] + inputs @ model.calibration[1:], -30, 30)))
    hit = np.flatnonzero(chance >= SPAN)
    # Neighbouring toxic words of a text make one span.
    doc = np.searchsorted(words.first, hit, "right") - 1
    new = np.ones(len(hit), bool)
    new[1:] = (np.diff(hit) > 1) | (np.diff(doc) > 0)
    at = np.flatnonzero(new)
    stop = hit[np.append(at[1:], len(hit)) - 1] if len(hit) else hit
    points = np.concatenate([[0], np.cumsum((words.data & 0xC0) != 0x80)])
    base = points[words.offsets[doc[at]]] if len(hit) else at
    columns = [points[words.start[hit[at]]] - base, points[words.stop[stop]] - base, np.maximum.reduceat(chance[hit], at) if len(hit) else np.zeros(0)]
    made = pa.StructArray.from_arrays([pa.array(c) for c in columns], fields=list(spans.value_type))
    offsets = np.concatenate([[0], np.cumsum(np.bincount(doc[at], minlength=batch.num_rows))]).astype(np.int32)
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score), pa.ListArray.from_arrays(pa.array(offsets), made)], names)


def train(docs: DataFrame, labels: DataFrame, modulus: int = 4, held_out: int = 2) -> Model | float:
    """Model from at most ``2 * PER_CLASS`` labelled documents outside the held-out fold."""
    tuned(docs.sparkSession)
    ids = training_ids(labels, "toxic", modulus, held_out, PER_CLASS)
    return fit(training_texts(docs, ids, LONGEST))


def scored(docs: DataFrame, model: Model | float, modulus: int = 4, held_out: int = 2, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted, and spans with code point offsets and marginals."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    shape = "doc_id long, score double, spans array<struct<start: long, stop: long, chance: double>>"
    made = by_slices(rows, lambda part: score_slice(part, model), shape)
    return made.select("doc_id", (fold(modulus) == held_out).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "spans")


def kept(docs: DataFrame, model: Model | float, threshold: float = 0.3) -> DataFrame:
    """The documents, all columns, whose score stays below the threshold."""
    tuned(docs.sparkSession)

    def below(batch):
        score = score_slice(batch.select(["text"]).append_column("doc_id", pa.nulls(batch.num_rows, pa.int64())), model).column("score")
        return batch.filter(pc.less(score, threshold))

    return by_slices(docs, below, docs.schema)
