"""Quality scores from random-indexing word vectors and a small calibrated network.

Every word (hashed to a bucket) has a fixed sparse index vector of a few plus and minus ones. A word's
vector is the sum of the index vectors of its neighbours in the training texts, turned by their
distance, at unit length. A document is the mean and the spread of its words' vectors and how much
neighbours agree. Two dense layers in numpy give a logit; a temperature fitted on held-back training
documents turns it into a probability.

The vectors are counted over all texts given, as they need no label; the network is fitted on at most
`sample` labelled rows. Every document is scored over its whole text.

Defined results: a null text counts as empty; a text without words has a vector of zeros and is scored
like any other. Rows repeat, and null doc_ids stay, outside all folds. Without labels of both classes
the score is the smoothed share of label 1. An empty table gives no rows.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.llm.common import Kept, extend, held, labelled, map_batches, materialise, sigmoid, texts

#: Labelled rows that the network is fitted on at most.
SAMPLE = 12_000
BUCKETS = 16_384
DIMENSIONS = 64
#: Plus and minus ones of an index vector.
ONES = 6
#: Neighbours on each side.
WINDOW = 2
HIDDEN = 32
EPOCHS = 60
#: Share of the training documents that stop the training and fit the temperature.
HELD_BACK = 0.2
#: Tokens that are pooled together.
BLOCK = 65_536
#: Tokens whose contexts are counted together.
CONTEXTS = 131_072

_TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")


def _chunk(chunk: str) -> tuple[int, ...]:
    """Buckets of the words, numbers and runs of signs of text without white space."""
    lowered = chunk.lower()
    if lowered.isalpha():
        return (zlib.crc32(lowered.encode()) % BUCKETS,)
    return tuple([zlib.crc32(t.encode()) % BUCKETS for t in _TOKEN.findall(lowered)])


def tokens(text: str | None) -> np.ndarray:
    chunks = held("quality", "chunks", lambda: Kept(_chunk))
    return np.fromiter(chain.from_iterable(map(chunks.__getitem__, (text or "").split())), dtype=np.int32)


@functools.cache
def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """A sparse ternary vector for each bucket, the same everywhere: its places and their signs.

    The last row, of no word, is all zeros.
    """
    rng = np.random.default_rng(20_240)
    places, signs = np.zeros((BUCKETS + 1, ONES), dtype=np.int64), np.zeros((BUCKETS + 1, ONES))
    for k in range(BUCKETS):
        signs[k] = rng.choice([-1.0, 1.0], ONES)
        places[k] = rng.choice(DIMENSIONS, ONES, replace=False)
    return places, signs


def add_contexts(ids: np.ndarray, sums: np.ndarray) -> None:
    """Add to each word's row the index vectors around it, rolled by their distance.

    BUCKETS stands for no word; texts that follow each other have WINDOW of it between them.
    """
    places, signs = index_vectors()
    padded = np.concatenate([np.full(WINDOW, BUCKETS), ids, np.full(WINDOW, BUCKETS)])
    for start in range(0, len(ids), CONTEXTS):
        part = ids[start : start + CONTEXTS]
        row = DIMENSIONS * part.astype(np.int64)[:, None]
        added = np.zeros((BUCKETS + 1) * DIMENSIONS)
        for distance in range(-WINDOW, WINDOW + 1):
            if distance:
                around = padded[start + WINDOW + distance :][: len(part)]
                at = row + (places.take(around, axis=0) + distance) % DIMENSIONS
                added += np.bincount(at.ravel(), signs.take(around, axis=0).ravel(), len(added))
        sums += added.reshape(-1, DIMENSIONS)[:BUCKETS]


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Unit vectors by bucket, summed over all texts of docs."""
    rows_each = 1_024

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((BUCKETS, DIMENSIONS), dtype=np.float32)
        between = np.full(WINDOW, BUCKETS, dtype=np.int32)
        waiting, size = [], 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                waiting += [tokens(text), between]
                size += len(waiting[-2])
                if size >= CONTEXTS:
                    add_contexts(np.concatenate(waiting), sums)
                    waiting, size = [], 0
        if waiting:
            add_contexts(np.concatenate(waiting), sums)
        for k in range(0, BUCKETS, rows_each):
            yield pa.RecordBatch.from_arrays(
                [pa.array([k]), pa.array([sums[k : k + rows_each].tobytes()], pa.binary())], names=["part", "sums"]
            )

    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        added = sum(np.frombuffer(b, dtype=np.float32).astype(np.float64) for b in pdf["sums"])
        return pd.DataFrame({"part": [pdf["part"].iloc[0]], "sums": [added.astype(np.float32).tobytes()]})

    schema = "part long, sums binary"
    parts = map_batches(docs.select("text"), work, schema).groupBy("part").applyInPandas(total, schema).collect()
    vectors = np.zeros((BUCKETS, DIMENSIONS), dtype=np.float32)  # a fixed size, whatever the data
    for row in parts:
        vectors[row["part"] : row["part"] + rows_each] = np.frombuffer(row["sums"], dtype=np.float32).reshape(-1, DIMENSIONS)
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)


def pooled(text: str | None, vectors: np.ndarray) -> np.ndarray:
    """Mean and spread of the words' vectors, agreement of neighbours, share of equal neighbours, length."""
    ids = tokens(text)
    n = len(ids)
    if not n:
        return np.zeros(2 * DIMENSIONS + 4)
    total, squares, agreement, equal = np.zeros(DIMENSIONS), np.zeros(DIMENSIONS), 0.0, 0
    for start in range(0, n, BLOCK):
        part = vectors.take(ids[start : start + BLOCK + 1], axis=0)  # one more, for the last pair
        own = part[: min(BLOCK, n - start)]
        total += own.sum(axis=0, dtype=np.float64)
        squares += np.einsum("ij,ij->j", own, own, dtype=np.float64)
        agreement += float(np.einsum("ij,ij->", part[:-1], part[1:], dtype=np.float64))
        equal += int((ids[start : start + len(part) - 1] == ids[start + 1 : start + len(part)]).sum())
    mean = total / n
    spread = np.sqrt(np.maximum(squares / n - mean**2, 0.0))
    pairs = max(1, n - 1)
    return np.concatenate([mean, spread, [agreement / pairs, equal / pairs, float(mean @ mean), np.log1p(n)]])


@dataclass
class Network:
    """Two dense layers over standardised inputs, with a temperature."""

    centre: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.maximum((x - self.centre) / self.scale @ w1 + b1, 0.0) @ w2 + b2[0]

    def probability(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.logits(x) / self.temperature)


def _loss(logits: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0.0, logits) - y * logits))


def fit_network(x: np.ndarray, y: np.ndarray, seed: int = 1) -> Network:
    """Adam on minibatches; the weights of the epoch that does best on the held-back part stay."""
    rng = np.random.default_rng(seed)
    width = x.shape[1]
    if len(y) < 10 or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1.0)
        flat = [np.zeros((width, 1)), np.zeros(1), np.zeros(1), np.array([np.log(share / (1 - share))])]
        return Network(np.zeros(width), np.ones(width), flat, 1.0)
    order = rng.permutation(len(y))
    back, front = order[: max(2, int(HELD_BACK * len(y)))], order[max(2, int(HELD_BACK * len(y))) :]
    centre, scale = x[front].mean(axis=0), x[front].std(axis=0) + 1e-6
    z = (x - centre) / scale
    layers = [rng.normal(0, np.sqrt(2 / width), (width, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.1, HIDDEN), np.zeros(1)]
    first, second = [np.zeros_like(v) for v in layers], [np.zeros_like(v) for v in layers]
    best, best_loss, step = [v.copy() for v in layers], np.inf, 0
    for _ in range(EPOCHS):
        shuffled = rng.permutation(front)
        for start in range(0, len(shuffled), 128):
            rows = shuffled[start : start + 128]
            w1, b1, w2, b2 = layers
            hidden = np.maximum(z[rows] @ w1 + b1, 0.0)
            error = (sigmoid(hidden @ w2 + b2[0]) - y[rows]) / len(rows)
            behind = np.outer(error, w2) * (hidden > 0)
            gradients = [z[rows].T @ behind + 1e-4 * w1, behind.sum(axis=0), hidden.T @ error + 1e-4 * w2, np.array([error.sum()])]
            step += 1
            for k, g in enumerate(gradients):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                layers[k] = layers[k] - 2e-3 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
        loss = _loss(Network(centre, scale, layers, 1.0).logits(x[back]), y[back])
        if loss < best_loss:
            best, best_loss = [v.copy() for v in layers], loss
    network = Network(centre, scale, best, 1.0)
    held = network.logits(x[back])
    network.temperature = min(np.geomspace(0.25, 8.0, 141), key=lambda t: _loss(held / t, y[back]))
    return network


@dataclass
class Model:
    vectors: np.ndarray
    network: Network


def fit(docs: DataFrame, labels: DataFrame, label: str, training, sample: int = SAMPLE) -> Model:
    """A model from the labelled documents for which training (a condition on doc_id) holds."""
    chosen = materialise(labelled(docs, labels, label, training, sample), "quality-sample")
    vectors = word_vectors(texts(docs))
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [pooled(t, shared.value).tolist() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(x, pa.list_(pa.float64()))], names=["doc_id", "y", "x"]
            )

    # at most `sample` rows of fixed width, in an order that does not depend on the run
    rows = sorted(map_batches(chosen.select("doc_id", "text", "y"), work, "doc_id long, y int, x array<double>").collect())
    x = np.array([r["x"] for r in rows]).reshape(len(rows), 2 * DIMENSIONS + 4)
    return Model(vectors, fit_network(x, np.array([min(1, max(0, r["y"])) for r in rows], dtype=np.float64)))


def score(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """docs with the probability of label 1 in one more column."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed size

    def make() -> Callable[[list], pa.Array]:
        model = shared.value

        def scores(batch: list) -> pa.Array:
            if not batch:
                return pa.array([], pa.float64())
            return pa.array(model.network.probability(np.stack([pooled(t, model.vectors) for t in batch])), pa.float64())

        return scores

    return extend(docs, column, T.DoubleType(), make)
