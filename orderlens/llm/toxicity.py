"""Toxic documents and sentences by multiple-instance learning.

Only documents have labels. A sentence s has the probability p_s = sigmoid(b + c * log(number
of sentences) + sum of the weights of its features), a document is toxic unless all of its
sentences are harmless: P = 1 - product(1 - p_s) (noisy-or). Weights are fitted to the
documents' labels by gradient descent through that product, and then say which sentences are
to blame. With c below 0, a word that harmless texts hold now and then weighs less in a long
one.

Features are words and beginnings of words, so that other endings of a known word count.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import Remembered, is_held_out, labelled_sample, mapped

# Labelled documents that the model is fitted on, at most (about).
TRAINING_DOCS = 20_000
# A feature that more toxic documents hold than chance would have it: twice the gain in the log
# likelihood of the labels by knowing the feature (as 4 standard deviations).
LEAST_GAIN = 16.0
PREFIXES = (3, 4, 5, 6, 7)
STEPS, RATE, PENALTY, SIZE_PENALTY = 400, 0.1, 5e-5, 1e-3
# Features that one task counts before it hands them on.
COUNTED_AT_ONCE = 400_000

WORD = re.compile(r"\w+")
SENTENCE = re.compile(r"[^.!?\n]+")


def features(word: str) -> list[str]:
    """The word and its beginnings, marked as such."""
    return [word] + [f"{word[:n]}*" for n in PREFIXES if len(word) >= n]


@dataclass
class Model:
    """Weights of features, the bias of a sentence, and what the logarithm of the number of
    sentences adds to it. Without features, ``constant`` is the score of every document."""

    weights: dict[str, float]
    bias: float
    size: float = 0.0
    constant: float | None = None

    def word_weight(self, word: str) -> float:
        return sum(self.weights.get(f, 0.0) for f in features(word))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each label that hold a feature, added up by task."""
    of_word = Remembered(features)
    counts: tuple[Counter, Counter] = (Counter(), Counter())

    def out() -> pa.RecordBatch:
        names = list(counts[0].keys() | counts[1].keys())
        batch = pa.RecordBatch.from_arrays(
            [
                pa.array(names, pa.string()),
                pa.array([counts[1][x] for x in names], pa.int64()),
                pa.array([counts[0][x] for x in names], pa.int64()),
            ],
            ["feature", "toxic", "harmless"],
        )
        counts[0].clear()
        counts[1].clear()
        return batch

    for batch in batches:
        for text, label in zip(
            batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True
        ):
            words = set(WORD.findall(text.lower())) if text else ()
            counts[label].update({f for w in words for f in of_word[w]})
        if len(counts[0]) + len(counts[1]) > COUNTED_AT_ONCE:
            yield out()
    yield out()


def _featured(numbers: dict[str, int]):
    """Per document: label, number of sentences, and the features in use by sentence."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_word = Remembered(lambda w: [numbers[f] for f in features(w) if f in numbers])
        for batch in batches:
            sentences, place, feature = [], [], []
            for text in batch.column(1).to_pylist():
                parts = SENTENCE.findall(text.lower()) if text else []
                at, which = [], []
                for k, part in enumerate(parts):
                    for word in WORD.findall(part):
                        if used := of_word[word]:
                            at += [k] * len(used)
                            which += used
                sentences.append(len(parts))
                place.append(at)
                feature.append(which)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(sentences, pa.int64()),
                    pa.array(place, pa.list_(pa.int32())),
                    pa.array(feature, pa.list_(pa.int32())),
                ],
                ["doc_id", "label", "sentences", "place", "feature"],
            )

    return work


def train(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "toxic",
    most_docs: int = TRAINING_DOCS,
) -> Model:
    """Learn from a sample of about ``most_docs`` labelled documents that aren't held out,
    chosen by a hash: which features go with toxic ones, and their weights. The driver holds
    short lists of a bounded number of documents. Without two classes the model is the one
    class (0 without any label), without such features the share of toxic documents. Runs
    jobs.
    """
    labelled = labelled_sample(docs, labels, label_col, most_docs)
    totals = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    toxic, harmless = totals.get(1, 0), totals.get(0, 0)
    if not toxic or not harmless:
        return Model({}, 0.0, constant=float(toxic > 0))
    counts = mapped(
        labelled.select("text", "label"), _counted, "feature string, toxic long, harmless long"
    )
    share = toxic / (toxic + harmless)
    both = F.col("toxic") + F.col("harmless")

    def part(n: str, expected: float) -> Column:
        return F.when(F.col(n) > 0, F.col(n) * F.log(F.col(n) / (both * expected))).otherwise(0.0)

    gain = 2 * (part("toxic", share) + part("harmless", 1 - share))
    chosen = (
        counts.groupBy("feature")
        .agg(F.sum("toxic").alias("toxic"), F.sum("harmless").alias("harmless"))
        .filter((F.col("toxic") / both > 2 * share * F.col("harmless") / both / (1 - share))
                & (gain >= LEAST_GAIN))
    )
    names = sorted(r["feature"] for r in chosen.collect())
    if not names:
        return Model({}, 0.0, constant=share)
    rows = mapped(
        labelled,
        _featured({name: k for k, name in enumerate(names)}),
        "doc_id long, label int, sentences long, place array<int>, feature array<int>",
    ).toArrow().sort_by([("doc_id", "ascending"), ("sentences", "ascending")])
    weights, (size, middle), bias = _fit(rows, len(names))
    used = {n: float(w) for n, w in zip(names, weights, strict=True) if abs(w) > 1e-3}
    return Model(used, float(bias - size * middle), float(size))


def _fit(rows: pa.Table, n_features: int) -> tuple[np.ndarray, tuple[float, float], float]:
    """Adam on the mean log-likelihood of the noisy-or, in numpy.

    With A = sum over sentences of softplus(z_s), the probability is 1 - exp(-A). Returns
    the weights, that of a document's log number of sentences with the number's mean, and the
    bias at that mean.
    """
    label = rows["label"].to_numpy().astype(float)
    total = rows["sentences"].to_numpy().astype(float)
    place = rows["place"].combine_chunks()
    lengths = np.diff(place.offsets.to_numpy())
    doc = np.repeat(np.arange(len(label)), lengths)
    at = place.flatten().to_numpy()
    feature = rows["feature"].combine_chunks().flatten().to_numpy()
    # Sentences that hold a feature; all others of a document count alike.
    keys, sentence = np.unique(doc * (at.max(initial=0) + 1) + at, return_inverse=True)
    owner = keys // (at.max(initial=0) + 1)
    plain = total - np.bincount(owner, minlength=len(label))
    size = np.log(np.maximum(total, 1))
    middle = size.mean()
    size -= middle

    theta = np.zeros(n_features + 2)
    theta[-1] = -6.0
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        w, base = theta[:-2], theta[-1] + theta[-2] * size
        z = base[owner] + np.bincount(sentence, w[feature], minlength=len(keys))
        harm = np.bincount(owner, np.logaddexp(0, z), minlength=len(label))
        harm += plain * np.logaddexp(0, base)
        slope = label / np.expm1(np.clip(harm, 1e-9, 500)) - (1 - label)
        by_sentence = slope[owner] / (1 + np.exp(-z))
        by_doc = np.bincount(owner, by_sentence, minlength=len(label))
        by_doc += slope * plain / (1 + np.exp(-base))
        by_feature = np.bincount(feature, by_sentence[sentence], minlength=n_features)
        gradient = np.concatenate([by_feature, [by_doc @ size, by_doc.sum()]]) / len(label)
        gradient[:-2] -= PENALTY * w
        gradient[-2] -= SIZE_PENALTY * theta[-2]
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        theta = theta + RATE * (first / (1 - 0.9**step)) / (
            np.sqrt(second / (1 - 0.999**step)) + 1e-9
        )
    return theta[:-2], (theta[-2], middle), theta[-1]


def _scorer(model: Model):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = Remembered(model.word_weight)
        for batch in batches:
            scores, starts, lengths, blame = [], [], [], []
            for text in batch.column(1).to_pylist():
                hits = []
                sentences = 0
                for m in SENTENCE.finditer(text) if text and model.constant is None else ():
                    sentences += 1
                    if z := sum(map(weight.__getitem__, WORD.findall(m[0].lower()))):
                        hits.append((m.start(), m.end() - m.start(), z))
                base = model.bias + model.size * np.log(max(sentences, 1))
                losses = [float(np.logaddexp(0, base + z)) for _, _, z in hits]
                harm = sum(losses) + (sentences - len(hits)) * float(np.logaddexp(0, base))
                found = [(s, n, -np.expm1(-x)) for (s, n, _), x in zip(hits, losses, strict=True)]
                score = model.constant if model.constant is not None else -np.expm1(-harm)
                found = [x for x in found if x[2] >= 0.5] or sorted(found, key=lambda x: -x[2])[:1]
                scores.append(float(score))
                starts.append([x[0] for x in found])
                lengths.append([x[1] for x in found])
                blame.append([float(x[2]) for x in found])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(scores, pa.float64()),
                    pa.array(starts, pa.list_(pa.int64())),
                    pa.array(lengths, pa.list_(pa.int64())),
                    pa.array(blame, pa.list_(pa.float64())),
                ],
                ["doc_id", "text_key", "score", "starts", "lengths", "blame"],
            )

    return work


def score(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted, and the offending
    sentences as arrays of start, length (in characters) and probability: those of 0.5
    and more, or else the likeliest one that holds a feature; and text_key (xxhash64 of the
    text).

    Null and empty texts have no sentences and score 0; long texts are read whole; equal texts
    have equal scores, and repeated rows are repeated; an empty table gives no rows. Labels,
    language, source and the id don't reach the score; other columns are ignored.
    """
    scored = mapped(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), "text",
            F.xxhash64("text").alias("text_key"),
        ),
        _scorer(model),
        "doc_id long, text_key long, score double, starts array<long>, lengths array<long>, blame array<double>",
    )
    return scored.select(
        "doc_id",
        is_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "starts",
        "lengths",
        "blame",
        "text_key",
    )


def offending_sentences(docs: DataFrame, scored: DataFrame) -> DataFrame:
    """(doc_id, start, sentence, probability) of the sentences that ``score`` blames, for
    documents it rejects."""
    blamed = (
        scored.filter("predicted = 1")
        .select("doc_id", F.explode(F.arrays_zip("starts", "lengths", "blame")).alias("s"))
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("_text"))
    return blamed.join(texts, "doc_id").select(
        "doc_id",
        F.col("s.starts").alias("start"),
        F.substring("_text", F.col("s.starts") + 1, F.col("s.lengths")).alias("sentence"),
        F.col("s.blame").alias("probability"),
    )
