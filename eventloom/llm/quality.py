"""Quality scores: random-indexing word vectors, pooled per document, under a small network.

Every word has a sparse random index vector, a function of its hash. The vector of a word is
the sum of the index vectors of its neighbours over the whole corpus; words share a fixed number of
buckets by hash, so the table of vectors has the same size for any corpus. Slices add up their own
sums and Spark adds the slices block by block. Documents pool their word vectors (mean,
spread, and rare words weigh more). A network of two layers, fitted in numpy on a bounded sample
of labelled documents, gives the log odds, and a temperature fitted on a part of the sample that
training did not see makes them probabilities.

Null and empty texts pool to zeros and get the network's score for that. Without training
documents of both classes every score is the share of good training documents, or 0.5
without any. Every input row gives a row; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.labels import fold, training_ids
from eventloom.llm.text import Words, by_slices, cut, mixed, tuned

#: Buckets of words, length of a vector, non-zero entries of an index vector, neighbours a side.
BUCKETS, LENGTH, ENTRIES, REACH = 1 << 14, 32, 4, 2
#: Vectors that travel as one row.
BLOCK = 512
#: Bounds of the training sample and the network.
PER_CLASS, HIDDEN, EPOCHS = 8000, 32, 60
FEATURES = 3 * LENGTH + 2

_INDEX = np.zeros((4096, LENGTH), np.float32)
_RANDOM = np.random.default_rng(3)
for _row in _INDEX:
    _row[_RANDOM.choice(LENGTH, ENTRIES, replace=False)] = _RANDOM.choice([-1.0, 1.0], ENTRIES)


def buckets(words: Words) -> np.ndarray:
    return (words.hashes() % np.uint64(BUCKETS)).astype(np.int64)


def context_slice(batch: pa.RecordBatch) -> pa.RecordBatch | None:
    """Sums of neighbours' index vectors and counts per word bucket, in blocks of rows."""
    words = Words(batch.column("text"))
    if len(words) == 0:
        return None
    hashes, doc = words.hashes(), words.doc
    bucket = (hashes % np.uint64(BUCKETS)).astype(np.int64)
    index = (mixed(hashes + np.uint64(77)) % np.uint64(len(_INDEX))).astype(np.int64)
    # Pairs (bucket, index vector) are counted before any vector is added up.
    pairs = []
    for step in range(1, REACH + 1):
        same = doc[step:] == doc[:-step]
        left, right = np.flatnonzero(same), np.flatnonzero(same) + step
        pairs += [bucket[left] * len(_INDEX) + index[right], bucket[right] * len(_INDEX) + index[left]]
    pair, count = np.unique(np.concatenate(pairs), return_counts=True)
    sums = np.zeros((BUCKETS, LENGTH), np.float32)
    if len(pair):
        row = pair // len(_INDEX)
        begin = np.flatnonzero(np.diff(row, prepend=-1))
        sums[row[begin]] = np.add.reduceat(_INDEX[pair % len(_INDEX)] * count[:, None].astype(np.float32), begin, axis=0)
    table = np.concatenate([sums, np.bincount(bucket, minlength=BUCKETS)[:, None]], axis=1).astype(np.int32)
    blocks = [table[i : i + BLOCK].tobytes() for i in range(0, BUCKETS, BLOCK)]
    return pa.RecordBatch.from_arrays([pa.array(range(len(blocks)), pa.int32()), pa.array(blocks, pa.binary())], ["block", "sums"])


def add_blocks(rows):
    """Running sums of a partition's blocks: one row per block leaves it."""
    sums: dict[int, np.ndarray] = {}
    for batch in rows:
        for block, blob in zip(batch.column("block").to_pylist(), batch.column("sums"), strict=True):
            value = np.frombuffer(blob.as_buffer(), np.int32 if len(blob.as_buffer()) == 4 * BLOCK * (LENGTH + 1) else np.int64)
            if block in sums:
                sums[block] += value
            else:
                sums[block] = value.astype(np.int64)
    if sums:
        columns = [pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["block", "sums"])


def word_vectors(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors (BUCKETS, LENGTH) without the common direction, and a weight per bucket
    that falls with the frequency of its words; from all documents."""
    tuned(docs.sparkSession)

    def partition(batches):
        def slices():
            for batch in batches:
                for part in cut(batch, "text"):
                    made = context_slice(part)
                    if made is not None:
                        yield made

        yield from add_blocks(slices())

    shape = "block int, sums binary"
    partial = docs.select("text").mapInArrow(partition, shape)
    whole = partial.repartition("block").mapInArrow(add_blocks, shape).toArrow()
    table = np.zeros((BUCKETS, LENGTH + 1))
    for block, blob in zip(whole.column("block").to_pylist(), whole.column("sums").to_pylist(), strict=True):
        table[block * BLOCK : (block + 1) * BLOCK] = np.frombuffer(blob, np.int64).reshape(BLOCK, LENGTH + 1)
    vectors, counts = table[:, :LENGTH], table[:, LENGTH]
    total = max(counts.sum(), 1.0)
    vectors = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    seen = counts > 0
    vectors[seen] -= (vectors * counts[:, None]).sum(axis=0) / total
    return vectors.astype(np.float32), (1e-3 / (1e-3 + counts / total)).astype(np.float32)


def pooled(words: Words, vectors: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Per document: mean vector, weighted mean, spread, mean weight, and whether it has words."""
    out = np.zeros((len(words.counts), FEATURES), np.float32)
    full = np.flatnonzero(words.counts)
    if len(full) == 0:
        return out
    bucket, begin = buckets(words), words.first[:-1][full]
    counts = words.counts[full][:, None].astype(np.float32)
    each, weight = vectors[bucket], weights[bucket][:, None]
    mean = np.add.reduceat(each, begin, axis=0) / counts
    total = np.add.reduceat(weight, begin, axis=0)
    heavy = np.add.reduceat(each * weight, begin, axis=0) / np.maximum(total, 1e-6)
    spread = np.sqrt(np.maximum(np.add.reduceat(each * each, begin, axis=0) / counts - mean * mean, 0))
    out[full] = np.concatenate([mean, heavy, spread, total / counts, np.ones_like(total)], axis=1)
    return out


@dataclass
class Model:
    vectors: np.ndarray
    weights: np.ndarray
    shift: np.ndarray
    scale: np.ndarray
    layers: tuple[np.ndarray, ...]
    temperature: float

    def odds(self, inputs: np.ndarray) -> np.ndarray:
        x = (inputs - self.shift) / self.scale
        w1, b1, w2, b2 = self.layers
        return np.maximum(x @ w1 + b1, 0) @ w2 + b2

    def scores(self, inputs: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.odds(inputs).astype(float) / self.temperature, -30, 30)))


def fit_network(x: np.ndarray, y: np.ndarray, seed: int = 1) -> tuple[np.ndarray, ...]:
    """Two layers by Adam on the logistic loss; both classes have the same weight in the
    hidden layer's sense of scale through mini-batches drawn from all rows."""
    rng = np.random.default_rng(seed)
    layers = [rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, np.sqrt(1 / HIDDEN), HIDDEN), np.zeros(())]
    first, second, step = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers], 0
    size = min(256, len(x))
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for at in range(0, len(x) - size + 1, size):
            rows = order[at : at + size]
            hidden = np.maximum(x[rows] @ layers[0] + layers[1], 0)
            p = 1 / (1 + np.exp(-np.clip(hidden @ layers[2] + layers[3], -30, 30)))
            slope = (p - y[rows]) / size
            back = np.outer(slope, layers[2]) * (hidden > 0)
            slopes = [x[rows].T @ back + 1e-4 * layers[0], back.sum(axis=0), hidden.T @ slope + 1e-4 * layers[2], slope.sum()]
            step += 1
            for i, g in enumerate(slopes):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                layers[i] = layers[i] - 3e-3 * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return tuple(layers)


def fit_temperature(odds: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least logistic loss, searched on a fine grid."""
    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 141))
    scaled = odds[:, None] / grid
    loss = (np.logaddexp(0, scaled) - y[:, None] * scaled).mean(axis=0)
    return float(grid[loss.argmin()])


def train(docs: DataFrame, labels: DataFrame, modulus: int = 3, held_out: int = 1) -> Model | float:
    """Word vectors from all documents, the network from at most ``2 * PER_CLASS`` labelled
    documents outside the held-out fold."""
    tuned(docs.sparkSession)
    ids = training_ids(labels, "quality", modulus, held_out, PER_CLASS)
    vectors, weights = word_vectors(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(ids), "doc_id")

    def features(batch):
        made = pooled(Words(batch.column("text")), vectors, weights)
        columns = [batch.column("doc_id"), batch.column("label"), pa.array([r.tobytes() for r in made], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "label", "inputs"])

    made = by_slices(rows, features, "doc_id long, label int, inputs binary").dropDuplicates(["doc_id", "inputs"])
    sample = made.groupBy("doc_id").agg(F.min("inputs").alias("inputs"), F.min("label").alias("label")).orderBy("doc_id").toArrow()
    y = sample.column("label").to_numpy().astype(float)
    if len(np.unique(y)) < 2:
        return float(y.mean()) if len(y) else 0.5
    x = np.frombuffer(b"".join(sample.column("inputs").to_pylist()), np.float32).reshape(len(y), FEATURES)
    shift, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    apart = np.random.default_rng(2).random(len(y)) < 0.2
    if len(np.unique(y[apart])) < 2 or len(np.unique(y[~apart])) < 2:
        apart = np.zeros(len(y), bool)
    scaled = (x - shift) / scale
    layers = fit_network(scaled[~apart], y[~apart])
    model = Model(vectors, weights, shift, scale, layers, 1.0)
    judged = apart if apart.any() else ~apart
    model.temperature = fit_temperature(model.odds(x[judged]), y[judged])
    return model


def scored(docs: DataFrame, model: Model | float, modulus: int = 3, held_out: int = 1, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def score(batch):
        fixed = not isinstance(model, Model)
        values = np.full(batch.num_rows, model) if fixed else model.scores(pooled(Words(batch.column("text")), model.vectors, model.weights))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values)], ["doc_id", "score"])

    made = by_slices(rows, score, "doc_id long, score double")
    return made.select("doc_id", (fold(modulus) == held_out).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
