"""Near-duplicate documents by fast similarity sketches.

A document is the set of its distinct word 5-grams. Its sketch has T coordinates that are
filled in rounds: in round i every shingle is thrown into one hashed bin with the value
(i, hash), and a bin keeps its smallest value. Rounds stop when all bins are filled; from
round T on the bin is the round's own number, so 2T rounds always fill every coordinate.
Two sketches agree in a coordinate with the probability of the sets' Jaccard similarity,
with sharper concentration than independent minima.

Sketches are cut into bands. Documents that agree in a band are candidates and are
confirmed on their full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import GOLDEN, U64, checkpointed, mapped, mix, utf8
from orderlens.llm.components import components
from orderlens.sources.scratch import written

WORDS = 5
COORDINATES = 192
BANDS = 32
# 32 bands of 6 rows miss a pair of similarity 0.85 with probability (1 - 0.85^6)^32 = 3e-7.

# Words whose hashes a worker remembers.
CACHED_WORDS = 300_000
# Texts whose sets a worker remembers while it confirms pairs.
TEXTS_REMEMBERED = 64
# Texts of one side of a block, on average, and shared shingles that are compared at one time.
BLOCK = 256
COLUMNS = 8192
# Hashes that are made at one time when a small set needs many rounds.
HASHES_AT_ONCE = 1536

FACTORS = mix(np.arange(1, 65, dtype=U64) * GOLDEN) | U64(1)


class WordHashes(dict):
    """64-bit hash of a word, remembered for a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        self[word] = value
        return value


def shingles(text: bytes | None, hashes: WordHashes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the ``words``-grams of a text: A-Z in lower case, cut at
    ASCII white space. A shorter text is one shingle; none without words."""
    parts = text.lower().split() if text else []
    if not parts:
        return np.empty(0, U64)
    h = np.fromiter(map(hashes.__getitem__, parts), U64, len(parts))
    if len(parts) < words:
        h = np.append(h, U64(len(parts)))
        return mix((h * FACTORS[: len(h)]).sum(dtype=U64, keepdims=True))
    n = len(parts) - words + 1
    total = h[:n] * FACTORS[0]
    for k in range(1, words):
        total += h[k : n + k] * FACTORS[k]
    return np.unique(mix(total))


def sketch(elements: np.ndarray, size: int = COORDINATES) -> np.ndarray:
    """Fast similarity sketch of a non-empty set of 64-bit hashes."""
    bins = np.full(size, np.iinfo(U64).max, U64)
    first, n = 0, len(elements)
    while first < 2 * size:
        rounds = min(max(1, HASHES_AT_ONCE // n), 2 * size - first)
        numbers = np.arange(first, first + rounds, dtype=U64)[:, None]
        x = mix(elements[None, :] ^ mix((numbers + U64(1)) * GOLDEN))
        place = ((x >> U64(32)) * U64(size)) >> U64(32)
        fixed = numbers >= U64(size)
        if fixed.any():
            place = np.where(fixed, numbers - U64(size), place)
        value = (numbers << U64(32)) | (x & U64(0xFFFFFFFF))
        np.minimum.at(bins, place.ravel().astype(np.intp), value.ravel())
        first += rounds
        if bins.max() != np.iinfo(U64).max:
            break
    return bins


def band_keys(bins: np.ndarray, bands: int = BANDS) -> np.ndarray:
    rows = bins.reshape(bands, -1)
    sums = (mix(rows) * FACTORS[: rows.shape[1]]).sum(axis=1, dtype=U64)
    return mix(sums + np.arange(bands, dtype=U64) * GOLDEN).view(np.int64)


def bit_planes(bins: np.ndarray) -> np.ndarray:
    """Two hashed bits of every coordinate, as 64-bit words: first all first bits, then
    all second bits."""
    x = mix(bins)
    bits = np.stack([x >> U64(63), (x >> U64(62)) & U64(1)]).astype(np.uint8)
    return np.packbits(bits, axis=1).view(np.int64).ravel()


SKETCHED = "doc_id long, n_shingles long, digest binary, keys array<long>, planes array<long>"


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        sizes, digests, keys, planes = [], [], [], []
        for text in utf8(batch.column(1)):
            s = shingles(text, hashes)
            bins = sketch(s) if len(s) else None
            sizes.append(len(s))
            digests.append(
                hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None
            )
            keys.append(band_keys(bins) if len(s) else None)
            planes.append(bit_planes(bins) if len(s) else None)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(sizes, pa.int64()),
                pa.array(digests, pa.binary()),
                pa.array(keys, pa.list_(pa.int64())),
                pa.array(planes, pa.list_(pa.int64())),
            ],
            ["doc_id", "n_shingles", "digest", "keys", "planes"],
        )


def _confirmer(numerator: int, denominator: int):
    """Keeps the pairs whose full sets are similar enough."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        sets: dict[bytes, np.ndarray] = {}

        def of(text: bytes) -> np.ndarray:
            if text not in sets:
                if len(sets) >= TEXTS_REMEMBERED:
                    sets.clear()
                sets[text] = shingles(text, hashes)
            return sets[text]

        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            linked = []
            for left, right in zip(utf8(batch.column(2)), utf8(batch.column(3)), strict=True):
                x, y = of(left), of(right)
                both = len(np.intersect1d(x, y, assume_unique=True))
                either = len(x) + len(y) - both
                linked.append(either > 0 and denominator * both >= numerator * either)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([v for v, ok in zip(a, linked, strict=True) if ok], pa.int64()),
                    pa.array([v for v, ok in zip(b, linked, strict=True) if ok], pa.int64()),
                ],
                ["a", "b"],
            )

    return confirm


def _agreeing(x: Column, y: Column) -> Column:
    """Coordinates in which two sketches agree, by their bit planes."""
    words = COORDINATES // 64
    differ = [
        F.bit_count(x[i].bitwiseXOR(y[i]).bitwiseOR(x[i + words].bitwiseXOR(y[i + words])))
        for i in range(words)
    ]
    return F.lit(COORDINATES) - sum(differ[1:], differ[0])


def _fewest(numerator: int, denominator: int) -> int:
    """Agreeing coordinates that a linked pair falls short of by six standard deviations
    only. Of coordinates that differ, a quarter agrees in two bits."""
    j = numerator / denominator
    least = j - 6 * (j * (1 - j) / COORDINATES) ** 0.5
    return int(COORDINATES * (least + (1 - least) / 4))


def near_duplicates(
    docs: DataFrame, numerator: int = 85, denominator: int = 100, id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept, class_id.

    Documents are linked when denominator * intersection >= numerator * union of their
    shingle sets (a similarity of at least 0.8, for which the sketches are laid out).
    component_id is the smallest id that links reach, and kept says that it is the
    row's own. class_id is the smallest id with an equal set.

    Null, empty and blank texts have no shingles and link with nothing. A null id is kept,
    without a component. Rows that share an id share a component. Long texts are read whole, in
    the task that holds them. An empty table gives no rows. Other columns are ignored. Runs
    jobs.

    How it stays linear and whole: equal sets are one class, so copies cost one row. Every
    class is first confirmed against two members of each of its buckets, which joins nearly
    all of a large group. After that only classes of *different* components that share a
    bucket are left. Those whose sketches agree well enough with another's (six standard
    deviations below the threshold) are compared in pairs of blocks, on their full sets;
    a block yields the edges that connect its links, so no list of pairs is ever made.
    """
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    rows = written(mapped(texts, _sketched, SKETCHED), "sketches")
    usable = rows.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = usable.groupBy("digest").agg(F.min("doc_id").alias("class_id"))
    classes = written(classes, "classes")

    # One sketch per class: that of its smallest id.
    first = usable.join(
        classes.select(F.col("digest").alias("_d"), "class_id"),
        (F.col("digest") == F.col("_d")) & (F.col("doc_id") == F.col("class_id")),
    ).dropDuplicates(["digest"])
    sketched = written(
        first.select("class_id", F.col("n_shingles").alias("n"), "keys", "planes"), "classes"
    )
    banded = sketched.select("class_id", "n", F.explode("keys").alias("key"))
    # Two members of each bucket by a hash: different buckets of a group have different ones.
    member, drawn = F.struct("class_id", "n"), F.xxhash64("class_id", "key")
    hubs = (
        banded.groupBy("key")
        .agg(F.min_by(member, drawn).alias("hub"), F.max_by(member, drawn).alias("second"))
        .filter("hub.class_id <> second.class_id")
    )
    shared = written(banded.join(hubs, "key"), "buckets")
    material = written(
        texts.join(shared.select(F.col("class_id").alias("doc_id")).distinct(), "doc_id", "semi")
        .filter("text IS NOT NULL"),
        "texts",
    )

    def confirmed(pairs: DataFrame) -> DataFrame:
        left = material.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
        right = material.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
        joined = pairs.select("a", "b").join(left, "a").join(right, "b")
        return mapped(
            joined.select("a", "b", "text_a", "text_b"),
            _confirmer(numerator, denominator), "a long, b long",
        )

    # Every class of a bucket with the bucket's two hubs.
    hub = F.explode(F.array("hub", "second")).alias("hub")
    stars = (
        shared.select("class_id", "n", hub)
        .filter("class_id <> hub.class_id")
        .filter(_similar_sizes(F.col("n"), F.col("hub.n"), numerator, denominator))
        .select(
            F.least("class_id", "hub.class_id").alias("a"),
            F.greatest("class_id", "hub.class_id").alias("b"),
        )
        .distinct()
    )

    def promising(pairs: DataFrame) -> DataFrame:
        """Pairs whose sketches agree often enough."""
        x = sketched.select(F.col("class_id").alias("a"), F.col("planes").alias("x"))
        y = sketched.select(F.col("class_id").alias("b"), F.col("planes").alias("y"))
        agree = _agreeing(F.col("x"), F.col("y"))
        return (
            pairs.join(x, "a").join(y, "b")
            .filter(agree >= _fewest(numerator, denominator)).select("a", "b").distinct()
        )

    # Rows that share an id are one vertex.
    same_id = (
        usable.join(classes, "digest").groupBy("doc_id")
        .agg(F.min("class_id").alias("a"), F.max("class_id").alias("b"))
        .filter("a < b").select("a", "b")
    )
    links = written(confirmed(promising(stars)).unionByName(same_id), "links")
    joined = checkpointed(components(links))

    # What is left across components is compared in blocks, which yield links, not pairs.
    blocks = _blocks_across(shared, sketched, joined, numerator, denominator)
    texts_of = material.withColumnRenamed("doc_id", "class_id")
    compared = (
        blocks.join(texts_of, "class_id")
        .repartition("group", "x", "y")
        .sortWithinPartitions("group", "x", "y")
        .select("group", "x", "y", "class_id", "is_x", "text")
    )
    found = written(
        mapped(compared, _block_confirmer(numerator, denominator), "a long, b long"), "links"
    )
    if not found.isEmpty():
        joined = checkpointed(components(links.unionByName(found)))

    members = rows.join(classes, "digest", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("class_id"),
    )
    component = F.coalesce("component", "class_id")
    return (
        members.join(joined.withColumnRenamed("id", "class_id"), "class_id", "left")
        .select(
            "doc_id",
            "n_shingles",
            component.alias("component_id"),
            F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
            "class_id",
        )
    )


def _similar_sizes(n: Column, m: Column, numerator: int, denominator: int) -> Column:
    return F.lit(denominator) * F.least(n, m) >= F.lit(numerator) * F.greatest(n, m)


def _blocks_across(
    shared: DataFrame, sketched: DataFrame, joined: DataFrame, numerator: int, denominator: int
) -> DataFrame:
    """Classes of different components that share a bucket and may be similar, dealt to
    pairs of blocks: group, x, y, class_id, is_x.

    In a bucket, the members outside its largest component (x) meet all members (y). Buckets
    with the same largest component are one group, so a class is there once however many
    buckets it shares. Semi-joins find the classes that have a promising partner, and a
    hash deals them to blocks of about ``BLOCK``; every block of x meets every block of y.
    """
    of = joined.withColumnRenamed("id", "class_id")
    members = shared.select("class_id", "n", "key").join(of, "class_id", "left")
    members = members.withColumn("component", F.coalesce("component", "class_id"))
    counts = members.groupBy("key", "component").agg(F.count(F.lit(1)).alias("size"))
    largest = (
        counts.groupBy("key")
        .agg(
            F.max_by("component", F.struct("size", "component")).alias("group"),
            F.count(F.lit(1)).alias("parts"),
        )
        .filter("parts > 1")
        .select("key", "group")
    )
    split = members.join(largest, "key").join(sketched.select("class_id", "planes"), "class_id")
    split = written(split, "split")
    x, y = split.filter("component <> group").alias("x"), split.alias("y")
    promising = (
        (F.col("x.key") == F.col("y.key"))
        & (F.col("x.component") != F.col("y.component"))
        & _similar_sizes(F.col("x.n"), F.col("y.n"), numerator, denominator)
        & (
            _agreeing(F.col("x.planes"), F.col("y.planes"))
            >= _fewest(numerator, denominator)
        )
    )
    sides = []
    for one, other, is_x in ((x, y, True), (y, x, False)):
        chosen = one.join(other, promising, "left_semi").select("group", "class_id").distinct()
        sides.append(written(chosen.withColumn("is_x", F.lit(is_x)), "side"))
    both = sides[0].unionByName(sides[1])
    blocks = F.ceil(F.count_if("is_x") / BLOCK), F.ceil(F.count_if(~F.col("is_x")) / BLOCK)
    numbers = both.groupBy("group").agg(blocks[0].alias("xs"), blocks[1].alias("ys"))
    mine = F.pmod(F.xxhash64("class_id"), F.when(F.col("is_x"), F.col("xs")).otherwise(F.col("ys")))
    other = F.explode(
        F.sequence(
            F.lit(0).cast("long"),
            F.when(F.col("is_x"), F.col("ys")).otherwise(F.col("xs")).cast("long") - 1,
        )
    )
    dealt = both.join(numbers, "group").withColumn("mine", mine).withColumn("other", other)
    return dealt.select(
        "group",
        F.when(F.col("is_x"), F.col("mine")).otherwise(F.col("other")).alias("x"),
        F.when(F.col("is_x"), F.col("other")).otherwise(F.col("mine")).alias("y"),
        "class_id",
        "is_x",
    )


def _intersections(xs: list[np.ndarray], ys: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sets, by products of narrow matrices over
    the elements that both lists hold."""
    common = np.intersect1d(np.unique(np.concatenate(xs)), np.unique(np.concatenate(ys)))
    out = np.zeros((len(xs), len(ys)), np.float32)
    for begin in range(0, len(common), COLUMNS):
        part = common[begin : begin + COLUMNS]
        sides = []
        for sets in (xs, ys):
            holds = np.zeros((len(sets), len(part)), np.float32)
            for row, s in zip(holds, sets, strict=True):
                s = s[np.searchsorted(s, part[0]) : np.searchsorted(s, part[-1], "right")]
                at = np.searchsorted(part, s)
                row[at[part[np.minimum(at, len(part) - 1)] == s]] = 1
            sides.append(holds)
        out += sides[0] @ sides[1].T
    return out


def _block_confirmer(numerator: int, denominator: int):
    """Compares the x and y texts of each group of consecutive rows on their full sets, and
    yields edges that connect what is linked: one per text at most."""

    def edges(rows: list[tuple], hashes: WordHashes) -> list[tuple[int, int]]:
        sides = [], []
        for _, class_id, is_x, text in rows:
            s = shingles(text, hashes)
            if len(s):
                sides[0 if is_x else 1].append((class_id, s))
        if not sides[0] or not sides[1]:
            return []
        ids = [np.array([i for i, _ in side]) for side in sides]
        sizes = [np.array([len(s) for _, s in side], float) for side in sides]
        both = _intersections([s for _, s in sides[0]], [s for _, s in sides[1]]).astype(float)
        either = sizes[0][:, None] + sizes[1][None, :] - both
        linked = denominator * both >= numerator * either
        # Two texts of one side are connected through the other side's texts.
        out = []
        root = {}

        def find(v):
            while root.setdefault(v, v) != v:
                root[v] = v = root[root[v]]
            return v

        for i, j in np.argwhere(linked):
            a, b = find(int(ids[0][i])), find(int(ids[1][j]))
            if a != b:
                root[max(a, b)] = min(a, b)
                out.append((int(ids[0][i]), int(ids[1][j])))
        return out

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        key, rows = None, []

        def batch_of(found: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in found], pa.int64()),
                 pa.array([b for _, b in found], pa.int64())],
                ["a", "b"],
            )

        for batch in batches:
            keys = zip(*[batch.column(k).to_pylist() for k in range(3)], strict=True)
            rest = [batch.column(k).to_pylist() for k in (3, 4)]
            found = []
            for k, *row in zip(keys, *rest, utf8(batch.column(5)), strict=True):
                if k != key and rows:
                    found += edges(rows, hashes)
                    rows = []
                key = k
                rows.append((k, *row))
            if found:
                yield batch_of(found)
        if rows:
            yield batch_of(edges(rows, hashes))

    return work
