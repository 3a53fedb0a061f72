"""How far the words of a source stray from its language's and from the other sources'.

Whole documents are folded, inside the tasks that read them, into stripes: a term of a
language with the number of its documents and a map from source to occurrences. A task that
holds many stripes hands them on and starts anew. Stripes of one term are merged where they
meet, and the merged stripes of a term give its part of every divergence at once: no row per
occurrence and no row per pair of documents is ever made.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import gathered, mapped, written

LEAST_DOCS = 30
SMOOTHING = 5
TOP_TERMS = 50
SCALE = 1_000_000_000

# Entries (term and source) that a task holds before it hands its stripes on.
SPILL_ENTRIES = 500_000
# Bytes of a text that are cut into words at one time.
SLICE_BYTES = 1 << 20
# Numbers (terms by sources) of a bucket of merged stripes, and fewest buckets a language.
CELLS = 1 << 16
LEAST_BUCKETS = 32
ROWS_PER_BATCH = 10_000

STRIPE = "lang string, term string, docs long, sources array<string>, counts array<long>"
PART = "lang string, source string, part string, item string, value long"

# A byte of a term as it counts: A-Z in lower case, a-z and all of other signs as they are,
# anything else a space.
TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, some at a time."""
    start = 0
    while start < len(text):
        end = start + SLICE_BYTES
        piece = text[start:end].translate(TERM_BYTES)
        if end < len(text) and not piece.endswith(b" "):
            # A slice ends at a sign that is no part of a term.
            last = piece.rfind(b" ")
            while last <= 0 and end < len(text):
                end += end - start
                piece = text[start:end].translate(TERM_BYTES)
                last = piece.rfind(b" ")
            if end < len(text):
                piece, end = piece[:last], start + last
        yield piece.split()
        start = end


class Stripes:
    """Stripes of whole documents, in bounded memory but for one document's terms."""

    def __init__(self):
        self.entries = 0
        self.docs: dict[str, Counter] = {}
        self.counts: dict[tuple[str, str], Counter] = {}

    def add(self, lang: str, source: str, text: bytes) -> None:
        docs = self.docs.setdefault(lang, Counter())
        counts = self.counts.setdefault((lang, source), Counter())
        before = len(counts)
        seen: set[bytes] = set()
        for words in words_of(text):
            counts.update(words)
            seen.update(words)
        docs.update(seen)
        self.entries += len(counts) - before

    def spill(self) -> Iterator[pa.RecordBatch]:
        for lang, docs in self.docs.items():
            if not docs:
                continue
            place = dict(zip(docs, range(len(docs)), strict=True))
            of_lang = [(s, c) for (own, s), c in self.counts.items() if own == lang]
            rows = [np.fromiter(map(place.__getitem__, c), np.int64, len(c)) for _, c in of_lang]
            numbers = [np.fromiter(c.values(), np.int64, len(c)) for _, c in of_lang]
            source = np.repeat(np.arange(len(of_lang)), [len(r) for r in rows])
            yield from _batches(
                pa.array([lang], pa.string()).take(np.zeros(len(docs), np.int32)),
                pa.array(list(docs), pa.binary()).cast(pa.string()),
                np.fromiter(docs.values(), np.int64, len(docs)),
                np.concatenate(rows), source, np.concatenate(numbers),
                pa.array([s for s, _ in of_lang], pa.string()),
            )
        self.__init__()


def _batches(
    langs: pa.Array, terms: pa.Array, docs: np.ndarray,
    rows: np.ndarray, sources: np.ndarray, numbers: np.ndarray, names: pa.Array,
) -> Iterator[pa.RecordBatch]:
    """Stripes as record batches of a bounded number of rows, from one entry for each row
    (by place) and source (by place among ``names``); an entry may come in several parts."""
    key = rows * len(names) + sources
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    numbers = np.add.reduceat(numbers[order], first) if len(first) else numbers
    row, source = np.divmod(key[first], len(names))
    ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(terms)))])
    offsets = pa.array(ends, pa.int32())
    batch = pa.RecordBatch.from_arrays(
        [
            langs, terms, pa.array(docs),
            pa.ListArray.from_arrays(offsets, names.take(pa.array(source))),
            pa.ListArray.from_arrays(offsets, pa.array(numbers)),
        ],
        ["lang", "term", "docs", "sources", "counts"],
    )
    for start in range(0, batch.num_rows, ROWS_PER_BATCH):
        yield batch.slice(start, ROWS_PER_BATCH)


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    stripes = Stripes()
    for batch in batches:
        langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
        texts = batch.column("text").cast(pa.binary())
        for lang, source, text in zip(langs, sources, texts, strict=True):
            stripes.add(lang, source, text.as_py())
            if stripes.entries > SPILL_ENTRIES:
                yield from stripes.spill()
    yield from stripes.spill()


def _merged(batch: pa.RecordBatch, start: np.ndarray, docs: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One stripe for each run of rows."""
    sources, counts = batch.column("sources"), batch.column("counts")
    per_row = np.diff(sources.offsets.to_numpy())
    run = np.repeat(np.arange(len(start)), np.diff(start, append=batch.num_rows))
    codes = sources.flatten().dictionary_encode()
    yield from _batches(
        batch.column("lang").take(pa.array(start)), batch.column("term").take(pa.array(start)),
        docs, np.repeat(run, per_row), codes.indices.to_numpy().astype(np.int64),
        counts.flatten().to_numpy(), codes.dictionary,
    )


def _merge(least_docs: int):
    """Merge the stripes of each term, which come sorted, and keep the common terms. Of the
    last term, which may go on, one stripe is kept back."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        back = None
        for batch in gathered(batches, ROWS_PER_BATCH):
            if back is not None:
                batch = pa.concat_batches([back, batch])
            differs = np.zeros(batch.num_rows, bool)
            differs[0] = True
            for name in ("lang", "term"):
                column = batch.column(name)
                differs[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
            start = np.flatnonzero(differs)
            docs = np.add.reduceat(batch.column("docs").to_numpy(), start)
            back = pa.concat_batches(_merged(batch.slice(start[-1]), np.array([0]), docs[-1:]))
            size = np.diff(start)
            common = docs[:-1] >= least_docs
            if common.any():
                kept = batch.slice(0, start[-1]).filter(pa.array(np.repeat(common, size)))
                first = np.concatenate([[0], np.cumsum(size[common])[:-1]])
                yield from _merged(kept, first, docs[:-1][common])
        if back is not None and back.column("docs")[0].as_py() >= least_docs:
            yield back

    return work


def share(counts: np.ndarray, total: int, smoothing: int, terms: int) -> np.ndarray:
    """1 + floor(SCALE * (count + smoothing) / (total + smoothing * terms)), exactly, by long
    division in base 1000: right up to a total of 9e15."""
    divisor = total + smoothing * terms
    rest = counts + smoothing
    result = rest // divisor
    rest = rest % divisor
    for _ in range(3):
        rest = rest * 1000
        result = result * 1000 + rest // divisor
        rest = rest % divisor
    return result + 1


def _diverge(smoothing: int, top: int):
    """Partial pair sums (each pair once) and the leading terms of each bucket. A bucket's
    rows come together: first its groups with their totals, then its stripes by term."""

    def part(lang, part, source, items, values):
        n = len(items)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * n, pa.string()), pa.array([source] * n, pa.string()),
                pa.array([part] * n, pa.string()), pa.array(items, pa.string()),
                pa.array(values, pa.int64()),
            ],
            ["lang", "source", "part", "item", "value"],
        )

    def emit(lang, sources, totals, vocabulary, terms, stripes):
        place = {s: i for i, s in enumerate(sources)}
        counts = np.zeros((len(sources), len(terms)), np.int64)
        for column, (names, numbers) in enumerate(stripes):
            for name, number in zip(names, numbers, strict=True):
                counts[place[name], column] = number
        if terms:
            shares = np.stack(
                [share(c, n, smoothing, vocabulary) for c, n in zip(counts, totals, strict=True)]
            )
            common = share(counts.sum(axis=0), sum(totals), smoothing, vocabulary)
        else:
            shares, common = counts, counts.sum(axis=0)
        for i, source in enumerate(sources):
            if i + 1 < len(sources):
                values = np.abs(shares[i + 1 :] - shares[i]).sum(axis=1)
                yield part(lang, "pair", source, sources[i + 1 :], values)
            over = np.flatnonzero((counts[i] > 0) & (shares[i] > common))
            if len(over):
                ahead = (shares[i] - common)[over]
                best = np.argsort(-ahead, kind="stable")[:top]
                yield part(lang, "term", source, [terms[k] for k in over[best]], ahead[best])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, group, terms, stripes = None, None, [], []
        for batch in batches:
            columns = (batch.column(n).to_pylist() for n in batch.schema.names)
            for lang, bucket, term, vocabulary, sources, numbers in zip(*columns, strict=True):
                if (lang, bucket) != key:
                    if group:
                        yield from emit(*group, terms, stripes)
                    key, terms, stripes = (lang, bucket), [], []
                if term is None:
                    group = (lang, sources, numbers, vocabulary)
                else:
                    terms.append(term)
                    stripes.append((sources, numbers))
        if group:
            yield from emit(*group, terms, stripes)

    return work


def kept_stripes(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(lang, term, docs, sources, counts) of the terms that at least ``least_docs`` documents
    of the language hold."""
    stripes = mapped(docs.select("lang", "source", "text"), _fold, STRIPE)
    met = stripes.repartition("lang", "term").sortWithinPartitions("lang", "term")
    return met.mapInArrow(_merge(least_docs), STRIPE)


def divergences(
    docs: DataFrame,
    least_docs: int = LEAST_DOCS,
    smoothing: int = SMOOTHING,
    top_terms: int = TOP_TERMS,
) -> DataFrame:
    """(lang, source, part, item, value, rank): for every source of every language its distance
    to each other source of the language (part ``pair``), and the terms that it uses more than
    the language does (part ``term``, the ``top_terms`` first ones). Larger values come first,
    equal ones by the item's bytes.

    Terms are runs of ASCII letters and all signs beyond ASCII, A-Z in lower case. A null text,
    lang or source counts as ''. Empty texts have no terms but their group counts; repeated
    rows count again, ids are not read; a language without common terms has pairs of value 0; an
    empty table gives no rows; other columns are not read. A long text is cut into words slice
    by slice. All sums are exact in 64 bits up to 9e15 occurrences a language.

    A row per language holds its sources' totals; the report has a row per pair of sources, so
    there are far fewer of them than it returns. Runs jobs.
    """
    plain = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")))
    kept = written(kept_stripes(plain, least_docs), "stripes")
    counted = (
        kept.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("e"))
        .groupBy("lang", F.col("e.sources").alias("source"))
        .agg(F.sum("e.counts").alias("total"))
    )
    totals = (
        plain.select("lang", "source").distinct()
        .join(counted, ["lang", "source"], "left")
        .groupBy("lang")
        .agg(F.sort_array(F.collect_list(F.struct("source", F.coalesce("total", F.lit(0)))))
             .alias("groups"))
    )
    sizes = kept.groupBy("lang").agg(F.count("*").alias("terms"))
    groups = written(
        totals.join(sizes, "lang", "left").select(
            "lang",
            F.coalesce("terms", F.lit(0)).alias("terms"),
            F.col("groups.source").alias("sources"),
            F.col("groups.col2").alias("numbers"),
        ),
        "groups",
    )
    cells = groups.agg(F.max(F.col("terms") * F.size("sources"))).first()[0]
    if cells is None:
        return groups.sparkSession.createDataFrame([], PART + ", rank int")
    buckets = max(LEAST_BUCKETS, -(-cells // CELLS))
    headers = groups.select(
        "lang",
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1))).alias("bucket"),
        F.lit(None).cast("string").alias("term"),
        "terms", "sources", "numbers",
    )
    stripes = kept.select(
        "lang",
        F.pmod(F.xxhash64("term"), F.lit(buckets)).alias("bucket"),
        "term",
        F.lit(0).cast("long").alias("terms"),
        "sources", F.col("counts").alias("numbers"),
    )
    parts = (
        headers.unionByName(stripes)
        .repartition("lang", "bucket")
        .sortWithinPartitions("lang", "bucket", F.col("term").asc_nulls_first())
        .mapInArrow(_diverge(smoothing, top_terms), PART)
    )
    # Summing pairs needs all buckets, listing terms doesn't: one pass gives both.
    summed = parts.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    directed = summed.select(
        "lang", "part", "value",
        F.explode(
            F.when(
                F.col("part") == "pair",
                F.array(F.struct("source", "item"),
                        F.struct(F.col("item").alias("source"), F.col("source").alias("item"))),
            ).otherwise(F.array(F.struct("source", "item")))
        ).alias("e"),
    )
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return (
        directed.select("lang", "e.source", "part", "e.item", "value")
        .withColumn("rank", F.row_number().over(order))
        .filter((F.col("part") == "pair") | (F.col("rank") <= top_terms))
    )


def oracle(
    least_docs: int = LEAST_DOCS, smoothing: int = SMOOTHING, top_terms: int = TOP_TERMS
) -> str:
    """The same rows in SQL."""
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS n, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         coalesce(text, '') AS text
  FROM documents
), w AS (
  SELECT n, lang, source, translate(
    unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM d
), k AS (
  SELECT lang, term FROM w GROUP BY ALL HAVING count(DISTINCT n) >= {least_docs}
), v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
c AS (
  SELECT lang, source, term, count(*) AS c FROM w JOIN k USING (lang, term) GROUP BY ALL
), g AS (
  SELECT lang, source, coalesce(any_value(s.n), 0)::HUGEINT AS n
  FROM (SELECT DISTINCT lang, source FROM d)
  LEFT JOIN (SELECT lang, source, sum(c) AS n FROM c GROUP BY ALL) s USING (lang, source)
  GROUP BY ALL
), p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
    1 + ({SCALE}::HUGEINT * (coalesce(c.c, 0) + {smoothing})) // (g.n + {smoothing} * v.v) AS p
  FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term)
), q AS (
  SELECT lang, term,
    1 + ({SCALE}::HUGEINT * (sum(c) + {smoothing}))
      // (sum(sum(c)) OVER (PARTITION BY lang) + {smoothing} * any_value(v.v)) AS q
  FROM p JOIN v USING (lang) GROUP BY lang, term
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
    coalesce(f.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
    FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term GROUP BY ALL
  ) f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, p - q AS value
  FROM p JOIN q USING (lang, term) WHERE c > 0 AND p > q
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM (
  SELECT *, row_number() OVER (
    PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
WHERE part = 'pair' OR rank <= {top_terms}
"""
