"""Row numbers and tiles over any number of rows, with or without groups.

A window without a partition key moves all rows to one task, and a window over a
group moves that group to one task. Here the rows are range-partitioned by (group,
order), so a large group spans many tasks; each task numbers its own sorted rows, and
the rows of the same group in earlier tasks are added from a small table of counts per
task. The way is the same for every number of rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderlens.sources.scratch import written

# Fixed value: monotonically_increasing_id() = task number * 2^33 + row in the task.
ROWS_PER_TASK_BITS = 33


@dataclass(frozen=True)
class Rank:
    """Place of a row in its group, 1-based, or its tile if ``tiles`` is set. The order
    must be complete within a group, so it should end with a key."""

    order_by: Sequence[str | Column]
    partition_by: Sequence[str] = ()
    tiles: int | None = None


def with_ranks(
    df: DataFrame, ranks: Mapping[str, Rank], key: Sequence[str] = ()
) -> DataFrame:
    """Add one column per entry of ``ranks``. Runs a job per rank.

    With ``key`` (columns that are unique and never NULL), the rows are written once, every
    rank sorts and writes only the key, and the places are joined back by it. Without,
    each rank sorts and writes whole rows, which suits a single rank.
    """
    if not key:
        for name, rank in ranks.items():
            df = _with_rank(df, name, rank, df.columns)
        return df
    rows = out = written(df, "ranked")
    for name, rank in ranks.items():
        kept = list(dict.fromkeys([*key, *rank.partition_by]))
        out = out.join(_with_rank(rows, name, rank, kept).select(*key, name), list(key))
    return out.select(*df.columns, *ranks)


def _with_rank(df: DataFrame, name: str, rank: Rank, kept: Sequence[str]) -> DataFrame:
    groups = [F.col(k) for k in rank.partition_by]
    order = [F.col(o) if isinstance(o, str) else o for o in rank.order_by]
    # The place of a row must be the same for both uses below, also if a task is run
    # again after an executor is lost: fix it in the shared folder.
    placed = written(
        df.repartitionByRange(*groups, *order)
        .sortWithinPartitions(*groups, *order)
        .withColumn("_id", F.monotonically_increasing_id())
        .select(*kept, "_id"),
        "places",
    ).withColumn("_task", F.shiftright("_id", ROWS_PER_TASK_BITS))
    counts = placed.groupBy(*rank.partition_by, "_task").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_id").alias("_first")
    )
    # At most one row per task and one per group; windows run over these counts only.
    group = W.partitionBy(*rank.partition_by)
    before = group.orderBy("_task").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(
        *[F.col(k).alias(f"_g{i}") for i, k in enumerate(rank.partition_by)],
        F.col("_task").alias("_t"),
        F.col("_first"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
        F.sum("_rows").over(group).alias("_total"),
    )
    if not groups:
        # One row per task: bounded by the number of shuffle partitions.
        offsets = F.broadcast(offsets)
    on = F.col("_task") == F.col("_t")
    for i, key in enumerate(groups):
        on = on & key.eqNullSafe(F.col(f"_g{i}"))
    place = F.col("_before") + F.col("_id") - F.col("_first")
    result = place + 1 if rank.tiles is None else _tile(place, F.col("_total"), rank.tiles)
    return placed.join(offsets, on).select(*[F.col(c) for c in kept], result.alias(name))


def _tile(place: Column, total: Column, tiles: int) -> Column:
    """The first (total mod tiles) tiles hold one row more than the others."""
    size, extra = F.floor(total / F.lit(tiles)), total % tiles
    in_large = place < extra * (size + 1)
    large = F.floor(place / (size + 1)) + 1
    small = F.floor((place - extra * (size + 1)) / F.greatest(size, F.lit(1))) + extra + 1
    return F.when(in_large, large).otherwise(small).cast("int")


def with_tiles(
    df: DataFrame, values: Mapping[str, Column], tiles: int, key: str
) -> DataFrame:
    """Add one column per entry of ``values`` with the tile (1 to ``tiles``) of the row by that
    value, smallest first, NULL last, equal values by ``key``, which is unique and never NULL.
    Tiles have the sizes that ntile gives them. Values must fit decimal(38,6).

    All values are sorted together, as narrow rows (value number, value, key), and of each only
    the first row of every tile is fetched; rows are then compared with these, without a
    join. Runs three jobs, however many values there are."""
    number = {f"_value{i}": v.cast("decimal(38,6)") for i, v in enumerate(values.values())}
    rows = written(df.withColumns(number), "tiled")
    pairs = [F.struct(F.lit(i).alias("_of"), F.col(v).alias("_value")) for i, v in enumerate(number)]
    long = rows.select(F.col(key).alias("_key"), F.inline(F.array(*pairs)))
    rank = Rank([F.col("_value").isNull(), "_value", "_key"], ["_of"])
    size, extra = divmod(rows.count(), tiles)
    starts = [t * size + min(t, extra) + 1 for t in range(1, tiles)]
    # At most tiles - 1 rows of each value.
    firsts = (
        _with_rank(long, "_place", rank, ["_of", "_value", "_key"])
        .filter(F.col("_place").isin(starts))
        .collect()
    )
    kind = rows.schema[key].dataType
    out = {}
    for i, (name, value) in enumerate(zip(values, number, strict=True)):
        reached = [
            _not_before(F.col(value), F.col(key), r["_value"], F.lit(r["_key"]).cast(kind))
            for r in firsts if r["_of"] == i
        ]
        # Tiles without rows of their own begin nowhere.
        out[name] = sum((F.when(x, 1).otherwise(0) for x in reached), F.lit(1))
    return rows.withColumns(out).select(*df.columns, *values)


def _not_before(value: Column, key: Column, first, first_key: Column) -> Column:
    """Whether a row has its place at or behind that of (``first``, ``first_key``)."""
    if first is None:
        return value.isNull() & (key >= first_key)
    first = F.lit(first).cast("decimal(38,6)")
    return value.isNull() | (value > first) | ((value == first) & (key >= first_key))


def row_number(
    df: DataFrame,
    order_by: Sequence[str | Column],
    partition_by: Sequence[str] = (),
    out: str = "row_number",
) -> DataFrame:
    return with_ranks(df, {out: Rank(order_by, partition_by)})


def ntile(
    df: DataFrame,
    tiles: int,
    order_by: Sequence[str | Column],
    partition_by: Sequence[str] = (),
    out: str = "tile",
) -> DataFrame:
    return with_ranks(df, {out: Rank(order_by, partition_by, tiles)})
