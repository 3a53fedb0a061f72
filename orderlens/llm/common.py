"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.sources.scratch import shared_folder, written

# Rows of a text table that are in a Python worker at one time.
TEXTS_PER_BATCH = "256"

U64 = np.uint64
GOLDEN = U64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def mapped(
    df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` over batches of few rows, so that long texts don't add up."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", TEXTS_PER_BATCH)
    return df.mapInArrow(work, schema)


def gathered(
    batches: Iterator[pa.RecordBatch], rows: int, most_bytes: int = 1 << 22
) -> Iterator[pa.RecordBatch]:
    """The same rows in larger batches, until one holds so many rows or bytes."""
    some, have, size = [], 0, 0
    for batch in batches:
        some.append(batch)
        have, size = have + batch.num_rows, size + batch.nbytes
        if have >= rows or size >= most_bytes:
            yield pa.concat_batches(some)
            some, have, size = [], 0, 0
    if some:
        yield pa.concat_batches(some)


def checkpointed(df: DataFrame) -> DataFrame:
    """The same rows from a reliable checkpoint, worked out once."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def is_held_out(doc_id: Column) -> Column:
    """Rows whose labels no model sees: crc32 of the id as text is a multiple of 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def utf8(column: pa.Array) -> list[bytes | None]:
    """Texts as UTF-8 bytes, without decoding them."""
    return column.cast(pa.binary()).to_pylist()


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers (the finalizer of splitmix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def bounded_sample(df: DataFrame, key: str, most: int) -> DataFrame:
    """About ``most`` rows at most, chosen by a hash of ``key``, whatever the order."""
    n = df.count()
    if n <= most:
        return df
    part = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit("sample")), F.lit(1 << 30))
    return df.filter(part < int((1 << 30) * most / n))


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, most: int) -> DataFrame:
    """(doc_id, text, label) of about ``most`` labelled documents, chosen by a hash, without
    held-out ones. A document has one label, its largest if it is repeated; null labels
    don't count. The chosen labels are few enough to go to every task, so texts needn't be
    shuffled to find theirs."""
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(column).isin(0, 1))
        .filter(~is_held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("_id"))
        .agg(F.max(column).cast("int").alias("label"))
    )
    # At most ``most`` rows of 12 bytes, give or take the hash's spread.
    chosen = F.broadcast(written(bounded_sample(known, "_id", most), "labels"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    found = texts.join(chosen, F.col("doc_id") == F.col("_id")).select("doc_id", "text", "label")
    return written(found, "labelled")


class Remembered(dict):
    """Values of a function for a bounded number of arguments."""

    def __init__(self, function: Callable, most: int = 300_000):
        super().__init__()
        self.function, self.most = function, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.function(key)
        return value
