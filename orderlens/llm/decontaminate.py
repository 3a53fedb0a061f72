"""Passages of training documents that repeat benchmark items.

The items are indexed for BM25. Documents are cut into overlapping passages, each passage
is a query, and its score for an item is the share of the item's BM25 weight that the
passage's distinct words cover: 1 if it holds all of them. All items at or above a
threshold are retrieved, by block-max pruning: items lie in blocks, every word has the
largest weight it has in a block, and a block is opened only if these bounds reach the
threshold. Retrieved items are verified by the word n-grams of their question and of
their answer.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import mapped
from orderlens.sources.scratch import written

K1, B = 1.2, 0.75
THRESHOLD = 0.6
OVERLAP = 0.7
NGRAM = 3
# An index holds about so many items, of like lengths; so many indexes are searched in one
# pass over the documents. A larger benchmark takes several passes.
ITEMS_PER_INDEX = 2000
INDEXES_PER_PASS = 8
BLOCKS = 64
SHORTEST_STEP = 32
# An answer of fewer words may be missing if the item as a whole is there.
SHORTEST_ANSWER = 5

WORD = re.compile(r"\w+")
# The answer is what follows the last sentence end or line end inside an item.
LAST_PART = re.compile(r"[.!?\n]\s*(?=[^.!?\n]*\w[^.!?\n]*[.!?\s]*$)")


def words(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def question_and_answer(text: str | None) -> tuple[list[str], list[str]]:
    """Words of all but the last sentence, and of the last one; a single sentence is the
    question."""
    text = text or ""
    cuts = [m.end() for m in LAST_PART.finditer(text)]
    if not cuts:
        return words(text), []
    return words(text[: cuts[-1]]), words(text[cuts[-1] :])


def ngrams(parts: list[str], n: int = NGRAM) -> set[tuple[str, ...]]:
    """Word n-grams; the whole sequence if it is shorter."""
    if not parts:
        return set()
    return {tuple(parts[k : k + n]) for k in range(max(1, len(parts) - n + 1))}


@dataclass
class Index:
    """Inverted index with block maxima. Weights are shares of an item's own score."""

    ids: list[int]
    terms: dict[str, int]
    block_max: np.ndarray  # term x block
    block_of: np.ndarray  # first item of each block, and the number of items
    postings: list[dict[int, list[tuple[int, float]]]]  # block -> term -> (item, weight)
    questions: list[set]
    answers: list[set]
    wholes: list[set]  # n-grams of items whose answer is short, else empty
    step: int  # words by which passages advance; a passage is two steps long


@dataclass
class Statistics:
    """What BM25 knows of all items, whichever index an item is in: their number, their mean
    length, and how many hold a term (as far as an index needs it)."""

    items: int
    mean: float
    frequency: dict[str, int]


def build_index(
    items: list[tuple[int, str | None]], known: Statistics | None = None
) -> Index | None:
    """Index items; those without words match nothing. None if there is nothing to find.
    Without statistics, these are all items."""
    parsed = [(i, words(t), *question_and_answer(t)) for i, t in sorted(items, key=repr)]
    parsed = [p for p in parsed if p[1]]
    if not parsed:
        return None
    lengths = [len(p[1]) for p in parsed]
    counts = [Counter(p[1]) for p in parsed]
    if known is None:
        frequency = Counter(t for c in counts for t in c)
        known = Statistics(len(parsed), sum(lengths) / len(lengths), frequency)
    n, mean, frequency = known.items, known.mean, known.frequency
    terms = {t: k for k, t in enumerate(sorted({t for c in counts for t in c}))}
    blocks = min(BLOCKS, len(parsed))
    block_of = np.linspace(0, len(parsed), blocks + 1).astype(int)
    block_max = np.zeros((len(terms), blocks), np.float32)
    postings: list[dict] = []
    for g in range(blocks):
        lists: dict[int, list] = {}
        for item in range(block_of[g], block_of[g + 1]):
            norm = K1 * (1 - B + B * lengths[item] / mean)
            weight = {
                t: np.log1p((n - frequency[t] + 0.5) / (frequency[t] + 0.5))
                * tf * (K1 + 1) / (tf + norm)
                for t, tf in counts[item].items()
            }
            total = sum(weight.values())
            for t, w in weight.items():
                share = float(w / total)
                lists.setdefault(terms[t], []).append((item, share))
                k = terms[t]
                block_max[k, g] = max(block_max[k, g], np.nextafter(np.float32(share), 1))
        postings.append(lists)
    return Index(
        [p[0] for p in parsed], terms, block_max, block_of, postings,
        [ngrams(p[2]) for p in parsed], [ngrams(p[3]) for p in parsed],
        [ngrams(p[1]) if len(p[3]) < SHORTEST_ANSWER else set() for p in parsed],
        max(SHORTEST_STEP, *lengths),
    )


def retrieve(
    index: Index, texts: list[list[str]], threshold: float
) -> Iterator[tuple[int, int, int, float]]:
    """(text, first word, item, score) of all passages and items at the threshold or over
    it. Passages of two steps overlap by one, so a step's words are bounded once."""
    step, get = index.step, index.terms.get
    sizes = np.array([len(t) for t in texts])
    steps = -(-sizes // step)
    first_step = np.concatenate([[0], np.cumsum(steps)])
    term = np.fromiter(
        (get(w, -1) for t in texts for w in t), np.int64, int(sizes.sum())
    )
    place = np.repeat(first_step[:-1], sizes) + (
        np.arange(len(term)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    ) // step
    known = term >= 0
    n_terms = len(index.terms)
    pairs = np.unique(place[known] * n_terms + term[known])
    place, term = np.divmod(pairs, n_terms)
    bounds = np.zeros((int(first_step[-1]) + 1, index.block_max.shape[1]), np.float32)
    if len(place):
        starts = np.flatnonzero(np.diff(place, prepend=-1))
        bounds[place[starts]] = np.add.reduceat(index.block_max[term], starts, axis=0)
    begin = np.searchsorted(place, np.arange(first_step[-1] + 1))
    end = np.searchsorted(place, np.arange(first_step[-1] + 1), side="right")
    text_of = np.repeat(np.arange(len(texts)), steps)
    # The next step belongs to the passage if it is of the same text.
    same = np.append(text_of[1:] == text_of[:-1], False) if len(text_of) else np.zeros(0, bool)
    window = bounds[:-1] + np.where(same[:, None], bounds[1:], 0)
    for at, g in np.argwhere(window >= threshold - 1e-4):
        inside = set(term[begin[at] : end[at]].tolist())
        if same[at]:
            inside.update(term[begin[at + 1] : end[at + 1]].tolist())
        scores: dict[int, float] = {}
        for t in sorted(inside & index.postings[g].keys()):
            for item, share in index.postings[g][t]:
                scores[item] = scores.get(item, 0.0) + share
        text = int(text_of[at])
        for item, score in scores.items():
            if score >= threshold:
                yield text, int(at - first_step[text]) * step, item, score


def verify(
    index: Index, passage: list[str], item: int, overlap: float
) -> tuple[float, float | None] | None:
    """Shares of the question's and the answer's n-grams in the passage (None without an
    answer), if both reach ``overlap``, or all the item's if its answer is short; else None.
    A part of fewer words than an n-gram must occur as a whole."""

    def share(grams: set) -> float | None:
        return len(grams & ngrams(passage, len(next(iter(grams))))) / len(grams) if grams else None

    question, answer = share(index.questions[item]) or 0.0, share(index.answers[item])
    both = question >= overlap and (answer is None or answer >= overlap)
    if both or (share(index.wholes[item]) or 0.0) >= overlap:
        return question, answer
    return None


LEAKS = (
    "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, "
    "passages int, first_word long, text_key long"
)


def _searcher(indexes: list[Index], threshold: float, overlap: float):
    def search(index: Index, texts: list[list[str]]) -> dict[tuple[int, int], list]:
        found: dict[tuple[int, int], list] = {}
        for text, start, item, score in retrieve(index, texts, threshold):
            passage = texts[text][start : start + 2 * index.step]
            overlaps = verify(index, passage, item, overlap)
            if overlaps is None:
                continue
            question, answer = overlaps
            best = found.setdefault((text, item), [0.0, 0.0, answer, 0, start])
            best[0] = max(best[0], score)
            best[1] = max(best[1], question)
            best[2] = None if answer is None else max(best[2], answer)
            best[3] += 1
            best[4] = min(best[4], start)
        return found

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [words(t) for t in batch.column(1).to_pylist()]
            docs, keys = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            rows = [
                (docs[t], index.ids[i], *v, keys[t])
                for index in indexes
                for (t, i), v in search(index, texts).items()
            ]
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(),
                     pa.int32(), pa.int64(), pa.int64()]
            names = [part.split()[0] for part in LEAKS.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names
            )

    return work


def _sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Items with their number of words and their distinct terms."""
    for batch in batches:
        parsed = [words(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns[:2],
                pa.array([len(p) for p in parsed], pa.int64()),
                pa.array([sorted(set(p)) for p in parsed], pa.list_(pa.string())),
            ],
            ["item_id", "text", "size", "terms"],
        )


def leaks(
    docs: DataFrame,
    items: DataFrame,
    threshold: float = THRESHOLD,
    overlap: float = OVERLAP,
    items_per_index: int = ITEMS_PER_INDEX,
) -> DataFrame:
    """One row per document and item that it repeats: doc_id, item_id, score,
    question_overlap, answer_overlap (null without an answer), passages (how many hold the
    item), first_word (where the first such passage starts), text_key (xxhash64 of the text).

    ``items`` are (item_id, text), with all but the last sentence as the question. They are
    indexed in groups of items whose lengths differ at most by a factor of two, so one long item
    doesn't widen the passages for others, and of about ``items_per_index``, so that what goes to
    the executors is bounded. Term frequencies and the mean length are those of all items, so
    the groups don't change a score. Several groups are searched in one pass over the documents.

    Items and documents without words match nothing; long texts are searched whole; rows without
    an id are searched like any other and carry null; repeated rows give repeated results; other
    columns are not read. Runs jobs.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_key")
    )
    distinct = items.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    shape = F.floor(F.log2(F.greatest("size", F.lit(SHORTEST_STEP)))).cast("int")
    sized = mapped(distinct, _sized, "item_id long, text string, size long, terms array<string>")
    sized = written(sized.filter("size > 0").withColumn("shape", shape), "items")
    frequency = written(
        sized.select(F.explode("terms").alias("term")).groupBy("term").count(), "frequency"
    )
    n, total = sized.agg(F.count("*"), F.sum("size")).first()
    indexes, result = [], None

    def searched(result: DataFrame | None) -> DataFrame:
        found = mapped(texts, _searcher(list(indexes), threshold, overlap), LEAKS)
        indexes.clear()
        return found if result is None else result.unionByName(found)

    # One row per length class.
    for r in sized.groupBy("shape").count().orderBy("shape").collect():
        groups = -(-r["count"] // items_per_index)
        group = F.pmod(F.xxhash64("item_id", "text"), F.lit(groups))
        for g in range(groups):
            part = sized.filter((F.col("shape") == r["shape"]) & (group == g))
            own = part.select(F.explode("terms").alias("term"))
            counts = frequency.join(own, "term", "left_semi").collect()
            known = Statistics(n, total / n, {c["term"]: c["count"] for c in counts})
            rows = [(i["item_id"], i["text"]) for i in part.select("item_id", "text").collect()]
            if rows:
                indexes.append(build_index(rows, known))
            if len(indexes) == INDEXES_PER_PASS:
                result = searched(result)
    if indexes:
        result = searched(result)
    return spark.createDataFrame([], LEAKS) if result is None else result
