"""Near-duplicate vectors by sorted projection passes.

In each pass every vector gets a 64-bit key of random hyperplane signs, and all vectors are
sorted by it, so the order is lexicographic in concatenated one-bit hashes. Vectors at a
small angle share a long prefix and stand near each other. Every vector is compared with
the ``window`` vectors before it; pairs that are similar enough are links, and links are
united across passes.

The window bounds the work, not the result: where a vector links with the very last
vector of its window, its group may be larger than the window, and the group's members
are compared with each other in blocks. Where more vectors than a window share the
leading bits that the number of passes is laid out for (many vectors around one
direction), linked or not, these are compared with each other in blocks, too.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import checkpointed, mapped
from orderlens.llm.components import components
from orderlens.operators.ranking import Rank, with_ranks
from orderlens.sources.scratch import written

THRESHOLD = 0.95
WINDOW = 512
BLOCK = 1024
SEED = 20_240_229
# Share of the pairs right at the threshold that all passes may miss.
MISSED = 1e-4
BITS = 64


def leading_bits(vectors: int, window: int = WINDOW) -> int:
    """Bits that half a window of evenly spread vectors shares at most. Where more vectors
    than a window share them, all of these are compared (``_crowded``)."""
    return max(1, math.ceil(math.log2(max(vectors, 1) / window) + 1))


def passes_for(vectors: int, threshold: float = THRESHOLD, window: int = WINDOW) -> int:
    """Passes after which a pair at the threshold is missed with probability ``MISSED``.

    Two vectors are compared if they agree in ``leading_bits``; each bit agrees with
    probability 1 - angle / pi.
    """
    meets = (1 - math.acos(threshold) / math.pi) ** leading_bits(vectors, window)
    return max(2, math.ceil(math.log(MISSED) / math.log1p(-meets)))


def planes(dimension: int, number: int) -> np.ndarray:
    """The random directions of one pass."""
    return np.random.default_rng([SEED, dimension, number]).standard_normal((BITS, dimension))


def _rows(column: pa.Array) -> list[np.ndarray | None]:
    """Vectors as float64; None if null, empty, zero, or with null or non-finite parts."""
    out: list[np.ndarray | None] = []
    flat = column.flatten().cast(pa.float64())
    known = flat.is_valid().to_numpy(zero_copy_only=False)
    values = flat.fill_null(0.0).to_numpy(zero_copy_only=False)
    lengths = np.asarray([0 if n is None else n for n in column.value_lengths().to_pylist()])
    ends = np.cumsum(lengths)
    for end, n, valid in zip(ends, lengths, column.is_valid().to_pylist(), strict=True):
        v, k = values[end - n : end], known[end - n : end]
        usable = valid and n and k.all() and np.isfinite(v).all() and v.any()
        out.append(v if usable else None)
    return out


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = _rows(batch.column(1))
        data = [None if v is None else (v + 0.0).tobytes() for v in vectors]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(
                    [d and hashlib.blake2b(d, digest_size=16).digest() for d in data], pa.binary()
                ),
                pa.array(data, pa.binary()),
            ],
            ["vec_id", "digest", "vector"],
        )


def _keyed(passes: int):
    """(class_id, pass, dimension, key) for every pass; keys sort as their bits do."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        projections: dict[int, np.ndarray] = {}
        shifts = np.left_shift(np.uint64(1), np.arange(BITS - 1, -1, -1, dtype=np.uint64))
        for batch in batches:
            ids = np.asarray(batch.column(0).to_pylist())
            vectors = [np.frombuffer(v) for v in batch.column(1).to_pylist()]
            sizes = np.array([len(v) for v in vectors])
            for dimension in np.unique(sizes).tolist():
                chosen = np.flatnonzero(sizes == dimension)
                if dimension not in projections:
                    projections[dimension] = np.concatenate(
                        [planes(dimension, p) for p in range(passes)]
                    )
                sides = np.stack([vectors[i] for i in chosen]) @ projections[dimension].T > 0
                bits = sides.reshape(len(chosen), passes, BITS).astype(np.uint64)
                keys = (bits * shifts).sum(axis=2, dtype=np.uint64) ^ np.uint64(1 << 63)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(ids[chosen], passes), pa.int64()),
                        pa.array(np.tile(np.arange(passes), len(chosen)), pa.int32()),
                        pa.array(np.full(keys.size, dimension), pa.int32()),
                        pa.array(keys.view(np.int64).ravel()),
                    ],
                    ["class_id", "pass", "dimension", "key"],
                )

    return work


FOUND = "a long, b long, links long, dense boolean"


def _cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x @ y.T) / np.sqrt((x * x).sum(axis=1))[:, None] / np.sqrt((y * y).sum(axis=1))


def _roots(linked: np.ndarray) -> np.ndarray:
    """The smallest row that each row reaches over a symmetric adjacency matrix."""
    label = np.arange(len(linked))
    while True:
        least = np.where(linked, label[None, :], len(label)).min(axis=1, initial=len(label))
        new = np.minimum(label, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _compared(group: pa.Table, threshold: float, window: int, in_pass: bool) -> pa.Table:
    """Links among the rows of one block: how many each row has that no earlier pass has
    counted, and edges that connect what is linked.

    In a pass, rows are compared up to ``window`` places apart, if the later one belongs to
    the block; a pair counts in the first pass whose window holds it. Otherwise all rows
    of two blocks are compared, and pairs count that no pass's window holds. Blocks of
    crowded rows also leave out pairs that an earlier pass's prefix or a group that was
    compared as a whole (``done``) holds.
    """
    ids = group["class_id"].to_numpy()
    copies = group["copies"].to_numpy()
    own = group["own"].to_numpy(zero_copy_only=False)
    ranks = np.stack(group["ranks"].to_numpy())
    vectors = [np.frombuffer(v) for v in group["vector"].to_pylist()]
    sizes = np.array([len(v) for v in vectors])
    links = np.zeros(len(ids), np.int64)
    dense = np.zeros(len(ids), bool)
    root = np.arange(len(ids))
    if in_pass:
        number = group["pass"][0].as_py()
        place = ranks[:, number]
    for dimension in np.unique(sizes):
        chosen = np.flatnonzero(sizes == dimension)
        x = np.stack([vectors[i] for i in chosen])
        linked = _cosines(x, x) >= threshold
        np.fill_diagonal(linked, False)
        if not in_pass:
            # A pair of two blocks, or of one block with itself.
            linked &= (own[chosen][:, None] != own[chosen][None, :]) | own.all()
        else:
            distance = place[chosen][:, None] - place[chosen][None, :]
            later_own = np.where(distance > 0, own[chosen][:, None], own[chosen][None, :])
            linked &= (np.abs(distance) <= window) & later_own
            dense[chosen] = (linked & (np.abs(distance) == window)).any(axis=1)
        i, j = np.nonzero(linked)
        if len(i):
            earlier = ranks[chosen][:, :number] if in_pass else ranks[chosen]
            new = np.ones(len(i), bool)
            for column in earlier.T:
                new &= np.abs(column[i] - column[j]) > window
            if "prefixes" in group.column_names:
                number = max(group["pass"][0].as_py(), 0)
                for column in np.stack(group["prefixes"].to_numpy())[chosen][:, :number].T:
                    new &= column[i] != column[j]
                known = group["is_done"].to_numpy(zero_copy_only=False)[chosen]
                done = group["done"].to_numpy()[chosen]
                new &= ~(known[i] & known[j] & (done[i] == done[j]))
            links[chosen] += np.bincount(
                i[new], copies[chosen][j[new]], minlength=len(chosen)
            ).astype(np.int64)
            root[chosen] = chosen[_roots(linked)]
    keep = (links > 0) | dense | (root != np.arange(len(ids)))
    return pa.table(
        {"a": ids[keep], "b": ids[root][keep], "links": links[keep], "dense": dense[keep]}
    )


def near_duplicates(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    window: int = WINDOW,
    block: int = BLOCK,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept, class_id.

    Vectors are linked if their cosine in double precision is at least ``threshold``.
    n_links counts the other rows linked directly, component_id is the smallest id that
    links reach, kept says that it is the row's own.

    Vectors that are null, empty or zero or hold null or non-finite components, and rows
    without an id, link with nothing; a row without an id is kept. Vectors of different
    lengths aren't compared. Equal vectors are one class, compared once, and count with
    all their rows. Rows that share an id are one vertex. Other columns are ignored. Runs
    jobs.
    """
    assert block >= window
    rows = written(
        mapped(
            vectors.select(
                F.col(id_col).cast("long").alias("vec_id"),
                F.col(vector_col).cast("array<double>").alias("vector"),
            ),
            _digested,
            "vec_id long, digest binary, vector binary",
        ),
        "vectors",
    )
    usable = rows.filter("digest IS NOT NULL AND vec_id IS NOT NULL")
    classes = written(
        usable.groupBy("digest").agg(
            F.min("vec_id").alias("class_id"), F.count(F.lit(1)).alias("copies")
        ),
        "classes",
    )
    unique = written(
        usable.join(
            classes.withColumnRenamed("digest", "_d"),
            (F.col("digest") == F.col("_d")) & (F.col("vec_id") == F.col("class_id")),
        )
        .dropDuplicates(["class_id"])
        .select("class_id", "copies", "vector"),
        "unique",
    )
    n = unique.count()
    passes, bits = passes_for(n, threshold, window), leading_bits(n, window)
    keys = mapped(
        unique.select("class_id", "vector"), _keyed(passes),
        "class_id long, pass int, dimension int, key long",
    )
    ranked = with_ranks(
        keys, {"rank": Rank(["dimension", "key", "class_id"], partition_by=["pass"])}
    )
    ranked = ranked.withColumn("prefix", F.shiftright("key", max(0, BITS - bits)))
    prefixed = written(
        ranked.groupBy("class_id")
        .agg(
            F.first("dimension").alias("dimension"),
            F.sort_array(F.collect_list(F.struct("pass", "rank", "prefix"))).alias("r"),
        )
        .select(
            "class_id", "dimension", F.col("r.rank").alias("ranks"),
            F.col("r.prefix").alias("prefixes"),
        )
        .join(unique, "class_id"),
        "placed",
    )
    placed = prefixed.drop("dimension", "prefixes")

    # A block holds its own rows and the last ones of the block before it.
    rank = F.col("rank") - 1
    mine = F.floor(rank / block).cast("long")
    copies = placed.select("*", F.posexplode("ranks").alias("pass", "rank")).withColumn(
        "block",
        F.explode(
            F.when(rank % block >= block - window, F.array(mine, mine + 1)).otherwise(
                F.array(mine)
            )
        ),
    )
    copies = copies.withColumn("own", mine == F.col("block"))
    near = written(
        copies.groupBy("pass", "block").applyInArrow(
            lambda t: _compared(t, threshold, window, True), FOUND
        ),
        "found",
    )
    joined = checkpointed(components(near.select("a", "b")))

    found = near
    crowded = near.filter("dense").select(F.col("a").alias("id"))
    groups = joined.join(crowded, "id", "semi").select("component").distinct()
    members = written(joined.join(groups, "component"), "crowded")
    if not members.isEmpty():
        far = _in_blocks(members, ["component"], placed, threshold, window, block)
        found = near.unionByName(far)
    wide = _crowded(prefixed, window, block)
    if wide is not None:
        done = members.select(
            F.col("id").alias("class_id"), F.col("component").alias("done"),
            F.lit(True).alias("is_done"),
        )
        rows_of = (
            prefixed.drop("dimension").join(done, "class_id", "left")
            .fillna(0, ["done"]).fillna(False, ["is_done"])
        )
        groups = ["pass", "dimension", "prefix"]
        found = found.unionByName(_in_blocks(wide, groups, rows_of, threshold, window, block))
    if found is not near:
        joined = checkpointed(components(found.select("a", "b")))

    counts = found.groupBy("a").agg(F.sum("links").alias("links"))
    out = rows.select("vec_id", "digest").join(
        classes, F.when(F.col("vec_id").isNotNull(), rows["digest"]) == classes["digest"], "left"
    ).select("vec_id", F.coalesce("class_id", "vec_id").alias("class_id"), "copies")
    component = F.coalesce("component", "class_id")
    return (
        out.join(counts.withColumnRenamed("a", "class_id"), "class_id", "left")
        .join(joined.withColumnRenamed("id", "class_id"), "class_id", "left")
        .select(
            "vec_id",
            (F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1)
            .cast("long").alias("n_links"),
            component.alias("component_id"),
            F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
            "class_id",
        )
    )


def _crowded(prefixed: DataFrame, window: int, block: int) -> DataFrame | None:
    """(id, pass, dimension, prefix) of the rows to compare with all others of the same
    pass, dimension and prefix; None if every prefix fits in a window.

    A pair of which one row never shares its prefix with more rows than a window holds is
    compared in every pass in which it shares the prefix. The other rows are compared
    either by these prefixes or once all with each other (pass -1), whichever copies
    fewer vectors.
    """
    each = prefixed.select(
        F.col("class_id").alias("id"), "dimension",
        F.posexplode("prefixes").alias("pass", "prefix"),
    )
    groups = ["pass", "dimension", "prefix"]
    large = written(
        each.groupBy(*groups).agg(F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") > window + 1),
        "prefixes",
    )
    copies = F.sum(F.col("_rows") * F.ceil(F.col("_rows") / block))
    by_prefix = large.agg(copies).first()[0]
    if by_prefix is None:
        return None
    wide = written(each.join(large.select(*groups), groups).select("id", *groups), "wide")
    together = written(
        wide.select(
            "id", F.lit(-1).alias("pass"), "dimension", F.lit(0).cast("long").alias("prefix")
        ).distinct(),
        "wide",
    )
    at_once = together.groupBy("dimension").agg(F.count(F.lit(1)).alias("_rows"))
    return together if at_once.agg(copies).first()[0] <= by_prefix else wide


def _in_blocks(
    members: DataFrame, groups: list[str], placed: DataFrame, threshold: float, window: int,
    block: int,
) -> DataFrame:
    """All links inside groups that are larger than the window, from pairs of blocks: a task
    holds two blocks of vectors, and yields no pairs but counts and connecting edges."""
    ranked = with_ranks(members, {"_n": Rank(["id"], partition_by=groups)})
    sizes = members.groupBy(*groups).agg(F.count(F.lit(1)).alias("_size"))
    mine = F.floor((F.col("_n") - 1) / block).cast("long")
    last = F.floor((F.col("_size") - 1) / block).cast("long")
    blocks = (
        ranked.join(sizes, groups)
        .select(*groups, F.col("id").alias("class_id"), mine.alias("_mine"),
                F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("_other"))
        .join(placed, "class_id")
        .select(
            *groups,
            F.least("_mine", "_other").alias("x"),
            F.greatest("_mine", "_other").alias("y"),
            (F.col("_mine") <= F.col("_other")).alias("own"),
            *placed.columns,
        )
    )
    return written(
        blocks.groupBy(*groups, "x", "y").applyInArrow(
            lambda t: _compared(t, threshold, window, False), FOUND
        ),
        "far",
    )
