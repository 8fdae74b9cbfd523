"""Quality classifier: random-indexing word vectors pooled per document, a
two-layer network in numpy, and temperature-calibrated probabilities.

1. Context sums over all texts (no label is looked at): each task adds up its
   part, a fixed BUCKETS x DIM table cut into blocks; blocks are added up in two
   steps, so no group grows with the number of tasks alone.
2. Word vectors (a fixed size) go to the tasks; every whole text is pooled to
   a short vector, kept as a narrow stored table.
3. The network is fitted on the driver to at most ``TRAIN_DOCS`` labelled
   documents outside the held-out fold, those with the least hash; a fifth of
   them sets the temperature.
4. All pooled vectors are scored.

Defined cases: null text is empty; an empty text is pooled to zeros and scored
like any other; a null id counts as '' in the fold and has no label; of
several labels for one id the least counts, null labels are left out; repeated
rows are scored each; without labels of both kinds every score is the share of
label 1 (0.5 without any); other columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import find_package, map_arrow, scratch_table, text_slices
from .language_id import fold
from .random_index import BUCKETS, DIM, ContextSums, TokenCoder, pool, word_vectors

TRAIN_DOCS = 8000
THRESHOLD = 0.7
BLOCKS = 64
FAN_IN = 256
BATCH_BYTES = 1_000_000

def _coded(coder: TokenCoder, texts: pa.Array):
    """Bucket numbers of consecutive texts, about BATCH_BYTES at a time."""
    for _, some in text_slices(texts, BATCH_BYTES):
        yield [coder(t) for t in some]


def learn_vectors(texts: DataFrame) -> np.ndarray:
    """(text as binary) → word vectors over all rows, on the driver."""
    def collect(batches):
        from pyspark import TaskContext

        coder, sums, rows = TokenCoder(), ContextSums(), 0
        for batch in batches:
            for some in _coded(coder, batch.column(0)):
                sums.add(some)
                rows += len(some)
        if rows:
            parts = np.split(sums.sums.astype(np.float32), BLOCKS)
            part = TaskContext.get().partitionId() % FAN_IN
            yield pa.RecordBatch.from_arrays([pa.array(range(BLOCKS), pa.int32()), pa.array([part] * BLOCKS, pa.int32()),
                                              pa.array([p.tobytes() for p in parts], pa.binary())],
                                             names=["block", "part", "sums"])

    def add_up(table: pa.Table) -> pa.Table:
        total = np.zeros(BUCKETS * DIM // BLOCKS, np.float32)
        for x in table["sums"]:
            total += np.frombuffer(x.as_py(), np.float32)
        return pa.table({"block": table["block"].slice(0, 1), "part": table["part"].slice(0, 1),
                         "sums": pa.array([total.tobytes()], pa.binary())})

    find_package(texts.sparkSession)
    schema = "block int, part int, sums binary"
    parts = map_arrow(texts, collect, schema).groupBy("block", "part").applyInArrow(add_up, schema)
    found = parts.groupBy("block").applyInArrow(add_up, schema).collect()  # BLOCKS rows, of a fixed size
    sums = np.zeros((BLOCKS, BUCKETS * DIM // BLOCKS))
    for r in found:
        sums[r.block] = np.frombuffer(r.sums, np.float32)
    return word_vectors(sums.ravel())


def pool_texts(docs: DataFrame, vectors: np.ndarray) -> DataFrame:
    """(doc_id, text as binary) → (doc_id, pooled)."""
    sent = docs.sparkSession.sparkContext.broadcast(np.concatenate([vectors, vectors ** 2], axis=1))

    def run(batches):
        coder = TokenCoder()
        for batch in batches:
            at = 0
            for some in _coded(coder, batch.column(1)):
                x = pool(sent.value, some)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(some)), pa.array(list(x), pa.list_(pa.float32()))],
                                                 names=["doc_id", "pooled"])
                at += len(some)

    return map_arrow(docs, run, "doc_id long, pooled array<float>")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


@dataclass
class Network:
    mean: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]  # weights and biases; empty: always the prior
    factor: float
    prior: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.maximum((x - self.mean) / self.scale @ w1 + b1, 0) @ w2 + b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(x) * self.factor) if self.layers else np.full(len(x), self.prior)


def fit_network(x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 60, batch: int = 64, rate: float = 3e-3,
                decay: float = 1e-4, seed: int = 5) -> Network:
    """Two layers by Adam on the cross-entropy; every fifth row is kept for
    the temperature."""
    prior = float(y.mean()) if len(y) else 0.5
    if len(np.unique(y)) < 2:
        return Network(np.zeros(0), np.zeros(0), [], 1.0, prior)
    rng = np.random.default_rng(seed)
    held = np.arange(len(y)) % 5 == 4
    if len(np.unique(y[~held])) < 2:
        held[:] = False
    mean, scale = x[~held].mean(axis=0), x[~held].std(axis=0) + 1e-4
    a, t = (x[~held] - mean) / scale, y[~held]
    layers = [rng.normal(0, (2 / x.shape[1]) ** 0.5, (x.shape[1], hidden)), np.zeros(hidden),
              rng.normal(0, (1 / hidden) ** 0.5, hidden), np.zeros(1)]
    first, second, step = [np.zeros_like(w) for w in layers], [np.zeros_like(w) for w in layers], 0
    for epoch in range(epochs):
        order = rng.permutation(len(t))
        for at in range(0, len(order), batch):
            pick = order[at:at + batch]
            z = a[pick] @ layers[0] + layers[1]
            h = np.maximum(z, 0)
            error = (_sigmoid(h @ layers[2] + layers[3]) - t[pick]) / len(pick)
            back = np.outer(error, layers[2]) * (z > 0)
            grads = [a[pick].T @ back + decay * layers[0], back.sum(axis=0), h.T @ error + decay * layers[2],
                     np.array([error.sum()])]
            step += 1
            lr = rate * (1 - epoch / epochs)
            for i, g in enumerate(grads):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g ** 2
                layers[i] -= lr * (first[i] / (1 - 0.9 ** step)) / (np.sqrt(second[i] / (1 - 0.999 ** step)) + 1e-8)
    net = Network(mean, scale, layers, 1.0, prior)
    if held.any():
        z, t = net.logits(x[held]), y[held]
        grid = np.exp(np.linspace(np.log(0.1), np.log(5), 41))
        loss = [-np.mean(np.log(np.where(t == 1, _sigmoid(z * g), _sigmoid(-z * g)) + 1e-12)) for g in grid]
        net.factor = float(grid[int(np.argmin(loss))])
    return net


def training_rows(pooled: DataFrame, labels: DataFrame, folds: int, held_out: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Pooled vectors and labels of at most ``most`` documents."""
    known = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = known.where(fold(F.col("doc_id"), folds) != held_out)
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = (pooled.join(F.broadcast(sample), "doc_id").groupBy("doc_id")
            .agg(F.any_value("pooled").alias("pooled"), F.any_value("quality").alias("quality")).collect())
    rows.sort(key=lambda r: r.doc_id)
    return np.array([r.pooled for r in rows], float).reshape(-1, 2 * DIM + 1), np.array([float(r.quality) for r in rows])


def classify(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2, threshold: float = THRESHOLD,
             train_docs: int = TRAIN_DOCS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    pooled = scratch_table(pool_texts(own, learn_vectors(own.select("text"))), "pooled")
    labels = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    sent = docs.sparkSession.sparkContext.broadcast(fit_network(*training_rows(pooled, labels, folds, held_out, train_docs)))

    def run(batches):
        for batch in batches:
            x = batch.column(1).values.to_numpy().reshape(batch.num_rows, -1) if batch.num_rows else np.zeros((0, 2 * DIM + 1))
            score = np.clip(sent.value.score(x.astype(float)), 0.0, 1.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                                             names=["doc_id", "score", "predicted"])

    out = map_arrow(pooled, run, "doc_id long, score double, predicted int")
    return out.select("doc_id", (fold(F.col("doc_id"), folds) == held_out).alias("held_out"), "score", "predicted")
