"""Document quality from random-indexing word vectors and a small neural network.

Random indexing: every word has a fixed sparse random vector, and a word's context vector
is the sum of the random vectors of its neighbours over the whole corpus. Words are hashed
to a fixed number of rows, so the vectors have a bounded size whatever the vocabulary. A
document is the pooled vectors of its words: their mean, spread and step from one word to
the next. A two-layer network in numpy learns the labels, and a temperature fitted on
labelled documents that the network hasn't seen makes its outputs probabilities.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import Remembered, is_held_out, labelled_sample, mapped

ROWS = 1 << 15
DIMENSIONS = 32
NONZERO = 2
CONTEXT = 2
# Labelled documents that the network is fitted on, at most (about).
TRAINING_DOCS = 20_000
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 40, 256, 3e-3, 1e-4
SEED = 11

# A word, or a run of other signs; the case of words is kept.
TOKEN = re.compile(r"\w+|[^\w\s]+")


def row_of(token: str) -> int:
    return zlib.crc32(token.encode()) % ROWS


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero numbers of every row's random vector."""
    rng = np.random.default_rng(SEED)
    places = np.argsort(rng.random((ROWS, DIMENSIONS)), axis=1)[:, :NONZERO]
    return places, rng.choice([-1, 1], size=(ROWS, NONZERO))


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the neighbours' random vectors per row, in whole numbers, over a task."""
    places, signs = index_vectors()
    known = Remembered(row_of)
    total = np.zeros(ROWS * DIMENSIONS, np.int64)
    for batch in batches:
        rows, edges = [], []
        for text in batch.column(0).to_pylist():
            tokens = TOKEN.findall(text) if text else []
            rows.append(np.fromiter(map(known.__getitem__, tokens), np.int64, len(tokens)))
            edges.append(len(tokens))
        row = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        doc = np.repeat(np.arange(len(edges)), edges)
        at, weight = [], []
        for distance in range(1, CONTEXT + 1):
            near = doc[distance:] == doc[:-distance]
            left, right = row[:-distance][near], row[distance:][near]
            for word, neighbour in ((left, right), (right, left)):
                for k in range(NONZERO):
                    at.append(word * DIMENSIONS + places[neighbour, k])
                    weight.append(signs[neighbour, k])
        if at:
            total += np.bincount(
                np.concatenate(at), np.concatenate(weight), minlength=len(total)
            ).astype(np.int64)
    sums = total.reshape(ROWS, DIMENSIONS)
    used = np.flatnonzero(sums.any(axis=1))
    yield pa.RecordBatch.from_arrays(
        [pa.array(used)] + [pa.array(sums[used, k]) for k in range(DIMENSIONS)],
        ["row"] + [f"v{k}" for k in range(DIMENSIONS)],
    )


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Context vectors of all rows over all documents, of length 1 (0 for unseen rows). A
    task sends at most ``ROWS`` rows on, which Spark adds up; the driver gets ``ROWS``."""
    columns = [f"v{k}" for k in range(DIMENSIONS)]
    schema = "row long, " + ", ".join(f"{c} long" for c in columns)
    sums = mapped(docs.select("text"), _added, schema).groupBy("row").agg(
        *[F.sum(c).alias(c) for c in columns]
    )
    table = sums.toArrow()
    out = np.zeros((ROWS, DIMENSIONS), np.float64)
    out[table["row"].to_numpy()] = np.stack([table[c].to_numpy() for c in columns], axis=1)
    norm = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return (out / np.maximum(norm, 1e-12)).astype(np.float32)


def pooled(rows: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Mean, spread and mean step of a document's word vectors, and its length."""
    if not len(rows):
        return np.zeros(3 * DIMENSIONS + 1, np.float32)
    v = vectors[rows]
    step = np.abs(v[1:] - v[:-1]).mean(axis=0) if len(rows) > 1 else np.zeros_like(v[0])
    return np.concatenate([v.mean(axis=0), v.std(axis=0), step, [np.log1p(len(rows))]])


def _pooling(vectors: np.ndarray):
    """Pooled numbers of each text of a batch."""
    known = Remembered(row_of)

    def of(texts: list[str | None]) -> np.ndarray:
        out = []
        for text in texts:
            tokens = TOKEN.findall(text) if text else []
            rows = np.fromiter(map(known.__getitem__, tokens), np.int64, len(tokens))
            out.append(pooled(rows, vectors))
        return np.array(out, np.float32).reshape(len(texts), 3 * DIMENSIONS + 1)

    return of


@dataclass
class Model:
    """Word vectors, the network's layers and the temperature of its outputs."""

    vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    temperature: float
    constant: float | None = None

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return (np.tanh((x - self.mean) / self.scale @ w1 + b1) @ w2 + b2)[:, 0]

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -500, 500)))


def train(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", most_docs: int = TRAINING_DOCS
) -> Model:
    """Word vectors from all of ``docs``; network from a sample of about ``most_docs`` labelled
    documents that aren't held out, chosen by a hash; temperature from a tenth of it.
    Without two classes the score is the one class (1 without any label: nothing speaks
    against a document). Runs jobs."""
    vectors = word_vectors(docs)
    sample = labelled_sample(docs, labels, label_col, most_docs)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = _pooling(vectors)
        for batch in batches:
            x = of(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(list(x), pa.list_(pa.float32()))],
                ["doc_id", "label", "x"],
            )

    rows = mapped(sample, work, "doc_id long, label int, x array<float>").toArrow()
    y = rows["label"].to_numpy().astype(float)
    if not len(y) or y.min() == y.max():
        return Model(vectors, np.zeros(1), np.ones(1), [], 1.0, float(y[0]) if len(y) else 1.0)
    x = rows["x"].combine_chunks().flatten().to_numpy().reshape(len(y), -1).astype(float)
    ids = rows["doc_id"].to_numpy()
    order = np.lexsort((x[:, 0], ids))
    return _fit(x[order], y[order], ids[order], vectors)


def _fit(x: np.ndarray, y: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> Model:
    """Adam on the log-likelihood in small batches, then one temperature by search."""
    rng = np.random.default_rng(SEED)
    apart = np.array([zlib.crc32(f"calibrate {i}".encode()) % 10 == 0 for i in ids.tolist()])
    if not apart.any() or len(np.unique(y[~apart])) < 2:
        apart[:] = False
    mean, scale = x[~apart].mean(axis=0), x[~apart].std(axis=0) + 1e-6
    z, target = (x[~apart] - mean) / scale, y[~apart]
    n = z.shape[1]
    layers = [
        rng.standard_normal((n, HIDDEN)) / np.sqrt(n), np.zeros(HIDDEN),
        rng.standard_normal((HIDDEN, 1)) / np.sqrt(HIDDEN), np.zeros(1),
    ]
    moments = [[np.zeros_like(w), np.zeros_like(w)] for w in layers]
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(z))
        for begin in range(0, len(z), BATCH):
            rows = order[begin : begin + BATCH]
            w1, b1, w2, b2 = layers
            hidden = np.tanh(z[rows] @ w1 + b1)
            out = 1 / (1 + np.exp(-np.clip((hidden @ w2 + b2)[:, 0], -500, 500)))
            error = ((out - target[rows]) / len(rows))[:, None]
            back = (error @ w2.T) * (1 - hidden**2)
            slopes = [z[rows].T @ back, back.sum(axis=0), hidden.T @ error, error.sum(axis=0)]
            step += 1
            for k, slope in enumerate(slopes):
                first, second = moments[k]
                first += 0.1 * (slope - first)
                second += 0.001 * (slope**2 - second)
                move = first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
                layers[k] = layers[k] - RATE * (move + DECAY * layers[k])
    model = Model(vectors, mean, scale, layers, 1.0)
    if apart.any():
        logits, choices = model.logits(x[apart]), np.geomspace(0.25, 8, 61)
        wrong = np.where(y[apart] > 0, -logits, logits)
        loss = [np.logaddexp(0, wrong / t).mean() for t in choices]
        model.temperature = float(choices[int(np.argmin(loss))])
    return model


def score(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Null and empty texts are documents without words, with all pooled numbers 0. Long texts
    are read whole. Equal texts have equal scores, repeated rows are repeated, an empty table
    gives no rows. Labels, language, source and the id don't reach the score; other columns are
    ignored.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = _pooling(model.vectors)
        for batch in batches:
            scores = model.scores(of(batch.column(1).to_pylist()).astype(float))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"]
            )

    scored = mapped(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")),
        work,
        "doc_id long, score double",
    )
    return scored.select(
        "doc_id",
        is_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
