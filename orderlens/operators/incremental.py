"""Upserts of recent and late rows into a table that already exists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.sources.scratch import written
from orderlens.sources.tables import latest_folder, write_table, write_version


def changed_rows(
    target: DataFrame,
    source: DataFrame,
    key: str,
    ts_col: str,
    lookback_days: int = 3,
    changed_keys: DataFrame | None = None,
) -> DataFrame:
    """Source rows to process: dated no earlier than ``lookback_days`` before the
    newest target row, plus those named in ``changed_keys``. An empty target takes
    everything, like a first load."""
    newest = target.agg(F.max(ts_col)).scalar()
    due = newest.isNull() | (F.col(ts_col) >= F.date_sub(newest, lookback_days))
    if changed_keys is None:
        return source.filter(due)
    named = changed_keys.select(key).distinct().withColumn("_named", F.lit(True))
    return (
        source.join(named, key, "left")
        .filter(due | F.col("_named").isNotNull())
        .select(*source.columns)
    )


def upsert(target: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Target with the rows of ``changes`` inserted or replaced by key, in the columns
    of ``changes``."""
    kept = target.join(changes.select(key), key, "left_anti")
    return sync_columns(kept, changes).unionByName(changes)


def sync_columns(target: DataFrame, source: DataFrame) -> DataFrame:
    """Target rows in the source's columns: new columns are NULL, columns that the
    source no longer has are dropped, with their data."""
    have = set(target.columns)
    return target.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in source.schema.fields
        ]
    )


def incremental_merge(
    target: DataFrame | None,
    source: DataFrame,
    key: str,
    ts_col: str,
    lookback_days: int = 3,
    full_refresh: bool = False,
    changed_keys: DataFrame | None = None,
) -> DataFrame:
    """The table after an incremental run. Rows outside the lookback keep the state
    they have in the target. Without a target, or on a full refresh, it is the source.
    The changed rows are used twice, so they are worked out once and written."""
    if target is None or full_refresh:
        return source
    changes = changed_rows(target, source, key, ts_col, lookback_days, changed_keys)
    return upsert(target, written(changes, "changes"), key)


def newest_per_key(df: DataFrame, key: str, order_col: str) -> DataFrame:
    """The row with the largest ``order_col`` of each key. Reduced before the shuffle,
    so a key with many versions costs no more than its newest row per task."""
    newest = F.max_by(F.struct(*df.columns), F.struct(order_col, *df.columns))
    return df.groupBy(key).agg(newest.alias("_row")).select("_row.*")


# ---- tables on disk ----


def replace_table(df: DataFrame, path: str, key: str, partition_by: str) -> None:
    """Replace the whole table by ``df``, which may read it. Readers see the old rows until
    the new ones are complete."""
    write_version(df, path, [partition_by], [key])


def merge_into_table(
    path: str,
    changes: DataFrame,
    key: str,
    partition_by: str,
    order_col: str | None = None,
    may_move: bool = True,
) -> None:
    """Upsert into a table on disk by a dynamic overwrite of the partitions that gain, change
    or lose a row; the others aren't read or written. Runs jobs.

    With ``order_col`` the row with the largest value wins, among ``changes`` and against
    the stored row (of equal ones the new row); without, ``changes`` must hold a key once.
    ``may_move`` says that a key may come with another partition than it is stored in; then
    stored keys are looked up, in the files whose key range meets that of the changes.
    Without it only the partitions of ``changes`` are read.

    The whole table is written anew, next to the old one, if its columns change or a partition
    loses its last row. A merge that breaks off leaves the old rows, and one that is repeated
    gives the same table. Writers may work at the same time only on different partitions. The
    partition column is read back with Spark's inferred type: a date, a number or text.
    """
    spark = changes.sparkSession
    if order_col is not None:
        changes = newest_per_key(changes, key, order_col)
    folder = latest_folder(spark, path)
    if folder is None:
        replace_table(changes, path, key, partition_by)
        return
    changes = written(changes, "changes")
    stored = spark.read.parquet(folder)
    if stored.isEmpty():
        replace_table(changes, path, key, partition_by)
        return
    same_columns = set(stored.columns) == set(changes.columns)
    stored = sync_columns(stored, changes)
    # One row per partition of the layout (months, years).
    touched = changes.select(partition_by).distinct()
    if may_move:
        ends = changes.agg(F.min(key).alias("low"), F.max(key).alias("high")).first()
        near = stored.filter(F.col(key).between(F.lit(ends["low"]), F.lit(ends["high"])))
        homes = near.select(key, partition_by).join(changes.select(key), key, "left_semi")
        touched = touched.unionByName(homes.select(partition_by)).distinct()
    touched = written(touched, "touched")
    if same_columns:
        own = touched.withColumnRenamed(partition_by, "_touched")
        stored = stored.join(own, F.col(partition_by).eqNullSafe(F.col("_touched")), "left_semi")
    merged = written(_merged(stored, changes, key, order_col), "merged")
    left = merged.select(F.col(partition_by).alias("_left")).distinct()
    lost = touched.join(left, F.col(partition_by).eqNullSafe(F.col("_left")), "left_anti")
    if not same_columns:
        replace_table(merged, path, key, partition_by)
    elif lost.isEmpty():
        write_table(merged, folder, [partition_by], [key], dynamic=True)
    else:
        rest = sync_columns(spark.read.parquet(folder), changes).join(
            own, F.col(partition_by).eqNullSafe(F.col("_touched")), "left_anti"
        )
        replace_table(rest.unionByName(merged), path, key, partition_by)


def _merged(
    stored: DataFrame, changes: DataFrame, key: str, order_col: str | None
) -> DataFrame:
    if order_col is None:
        return stored.join(changes.select(key), key, "left_anti").unionByName(changes)
    both = stored.withColumn("_new", F.lit(0)).unionByName(changes.withColumn("_new", F.lit(1)))
    newest = F.max_by(F.struct(*changes.columns), F.struct(order_col, "_new"))
    return both.groupBy(key).agg(newest.alias("_row")).select("_row.*")
