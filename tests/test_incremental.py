import os
from concurrent.futures import ThreadPoolExecutor
from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F

from orderlens.operators.incremental import (
    incremental_merge,
    merge_into_table,
    newest_per_key,
    replace_table,
    sync_columns,
)
from orderlens.sources import latest_version, run_folder, write_table
from orderlens.sources.tables import latest_folder, versions

SCHEMA = "id int, day date, state string"


def d(number):
    return date(2023, 5, number)


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame(
        [(1, d(1), "old"), (2, d(7), "old"), (3, d(10), "old"), (4, d(9), "gone")], SCHEMA
    )


@pytest.fixture(scope="module")
def source(spark):
    return spark.createDataFrame(
        [(1, d(1), "new"), (2, d(7), "new"), (3, d(10), "new"), (5, d(11), "new"), (6, None, "new")],
        SCHEMA,
    )


def states(df):
    return {r["id"]: r["state"] for r in df.collect()}


def test_merge_takes_rows_inside_the_lookback(target, source):
    got = incremental_merge(target, source, "id", "day", 3)
    assert states(got) == {1: "old", 2: "new", 3: "new", 4: "gone", 5: "new"}


def test_wider_lookback(target, source):
    assert states(incremental_merge(target, source, "id", "day", 9))[1] == "new"


def test_merge_is_idempotent(target, source):
    once = incremental_merge(target, source, "id", "day", 3)
    assert rows(incremental_merge(once, source, "id", "day", 3)) == rows(once)


def test_first_load_empty_target_and_full_refresh(target, source):
    everything = rows(source)
    assert rows(incremental_merge(None, source, "id", "day")) == everything
    assert rows(incremental_merge(target.limit(0), source, "id", "day")) == everything
    assert rows(incremental_merge(target, source, "id", "day", full_refresh=True)) == everything


def test_changed_keys_reach_behind_the_lookback(spark, target, source):
    keys = spark.createDataFrame([(1,), (1,), (77,)], "id int")
    got = incremental_merge(target, source, "id", "day", 3, changed_keys=keys)
    assert states(got)[1] == "new"
    assert got.count() == 5


def test_equals_full_refresh_when_all_changes_are_recent(target):
    source = target.withColumn("state", F.when(F.col("day") >= d(7), "x").otherwise(F.col("state")))
    assert rows(incremental_merge(target, source, "id", "day", 3)) == rows(source)


def test_sync_columns(target):
    source = target.drop("state").withColumn("extra", F.lit(1.5))
    got = sync_columns(target, source)
    assert got.columns == source.columns
    assert got.filter("extra IS NOT NULL").count() == 0
    merged = incremental_merge(target, source, "id", "day", 3)
    assert merged.columns == ["id", "day", "extra"]
    assert {r["id"]: r["extra"] for r in merged.collect()} == {1: None, 2: 1.5, 3: 1.5, 4: 1.5}


def test_newest_per_key(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, "b"), (1, 2, None), (2, 1, None)], "k int, v int, s string")
    assert rows(newest_per_key(df, "k", "v")) == [(1, 3, "b"), (2, 1, None)]


def with_month(df):
    return df.withColumn("month", F.trunc("day", "month"))


def table(spark, rows_, schema=SCHEMA):
    return with_month(spark.createDataFrame(rows_, schema))


def files_of(spark, path):
    """Data files of the newest version, by partition folder."""
    folder = latest_folder(spark, path).removeprefix("file:")
    return {
        part: {f for f in os.listdir(f"{folder}/{part}") if f.endswith(".parquet")}
        for part in os.listdir(folder) if "=" in part
    }


def test_table_merge_rewrites_only_touched_partitions(spark):
    path = run_folder(spark, "table")
    first = [
        (1, date(2023, 1, 5), "a"), (2, date(2023, 2, 5), "a"), (6, date(2023, 2, 7), "a"),
        (3, date(2023, 3, 5), "a"), (7, date(2023, 3, 6), "a"), (8, date(2023, 5, 1), "a"),
    ]
    merge_into_table(path, table(spark, first), "id", "month")
    before = files_of(spark, path)
    assert len(before) == 4

    # 2 changes in place, 3 moves to January, 4 is new.
    change = table(
        spark,
        [(2, date(2023, 2, 6), "b"), (3, date(2023, 1, 9), "b"), (4, date(2023, 4, 1), "b")],
    )
    want = [
        (1, date(2023, 1, 5), "a"), (2, date(2023, 2, 6), "b"), (3, date(2023, 1, 9), "b"),
        (4, date(2023, 4, 1), "b"), (6, date(2023, 2, 7), "a"), (7, date(2023, 3, 6), "a"),
        (8, date(2023, 5, 1), "a"),
    ]
    for _ in range(2):  # a replayed batch changes nothing
        merge_into_table(path, change, "id", "month")
        assert rows(latest_version(spark, path), "id", "day", "state") == want
    after = files_of(spark, path)
    assert len(after) == 5 and len(versions(spark, path)) == 1
    assert after["month=2023-05-01"] == before["month=2023-05-01"]
    assert after["month=2023-03-01"] != before["month=2023-03-01"]

    # A batch for April leaves the files of the other months alone.
    late = table(spark, [(5, date(2023, 4, 2), "c")])
    merge_into_table(path, late, "id", "month", may_move=False)
    then = files_of(spark, path)
    assert {p for p in then if then[p] != after[p]} == {"month=2023-04-01"}
    assert latest_version(spark, path).count() == 8


def test_a_month_that_loses_its_last_row(spark):
    path = run_folder(spark, "table")
    first = [(1, date(2023, 1, 5), "a"), (2, date(2023, 2, 5), "a"), (3, None, "a")]
    merge_into_table(path, table(spark, first), "id", "month")
    merge_into_table(path, table(spark, [(2, date(2023, 1, 9), "b")]), "id", "month")
    want = [(1, date(2023, 1, 5), "a"), (2, date(2023, 1, 9), "b"), (3, None, "a")]
    assert rows(latest_version(spark, path), "id", "day", "state") == want
    merge_into_table(path, table(spark, [(3, date(2023, 1, 1), "c")]), "id", "month")
    assert set(files_of(spark, path)) == {"month=2023-01-01"}
    assert latest_version(spark, path).count() == 3


def test_table_merge_with_changed_columns_and_null_partition(spark):
    path = run_folder(spark, "table")
    first = table(spark, [(1, date(2023, 1, 5), "a"), (2, None, "a")])
    merge_into_table(path, first, "id", "month")
    change = table(spark, [(2, date(2023, 1, 7), "b")]).withColumn("extra", F.lit(7))
    merge_into_table(path, change, "id", "month")
    got = latest_version(spark, path)
    assert rows(got, "id", "state", "extra") == [(1, "a", None), (2, "b", 7)]
    merge_into_table(path, change.drop("state"), "id", "month")
    assert sorted(latest_version(spark, path).columns) == ["day", "extra", "id", "month"]


def test_moved_key_with_a_partition_name_that_needs_escaping(spark):
    path = run_folder(spark, "table")
    schema = "id int, part string"
    merge_into_table(path, spark.createDataFrame([(1, "x:1/%="), (2, "x")], schema), "id", "part")
    merge_into_table(path, spark.createDataFrame([(1, "y")], schema), "id", "part")
    assert rows(latest_version(spark, path)) == [(1, "y"), (2, "x")]


def test_newest_row_wins_over_batches(spark):
    path = run_folder(spark, "table")
    schema = "id int, version int, part string"
    for batch in ([(1, 5, "a"), (2, 1, "a")], [(1, 3, "b"), (2, 2, "b")], [(1, 4, "a")]):
        changes = spark.createDataFrame(batch, schema)
        merge_into_table(path, changes, "id", "part", order_col="version")
    assert rows(latest_version(spark, path), "id", "version", "part") == [(1, 5, "a"), (2, 2, "b")]


def test_a_merge_reads_only_files_near_the_changed_keys(spark):
    """Keys outside the range of the changes are pruned by the files' statistics."""
    near = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    path = run_folder(spark, "table")
    keyed = near.select(F.col("o_orderkey").alias("id"), (F.col("o_orderkey") % 3).alias("part"))
    merge_into_table(path, keyed, "id", "part")
    stored = latest_version(spark, path).filter(F.col("id").between(5, 9))
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id,5)" in plan and "LessThanOrEqual(id,9)" in plan


def test_a_write_that_breaks_off_leaves_the_old_rows(spark):
    path = run_folder(spark, "table")
    first = table(spark, [(k, date(2023, 1 + k % 3, 5), "a") for k in range(30)])
    merge_into_table(path, first, "id", "month")
    want = rows(latest_version(spark, path), "id", "state")
    breaks = F.when(F.col("id") == 29, F.raise_error(F.lit("lost"))).otherwise(F.lit("b"))
    broken = first.withColumn("state", breaks)
    with pytest.raises(Exception, match="lost"):
        write_table(broken, latest_folder(spark, path), ["month"], ["id"], dynamic=True)
    assert rows(latest_version(spark, path), "id", "state") == want
    with pytest.raises(Exception, match="lost"):
        replace_table(broken, path, "id", "month")
    assert rows(latest_version(spark, path), "id", "state") == want
    with pytest.raises(Exception, match="lost"):
        merge_into_table(path, broken, "id", "month")
    assert rows(latest_version(spark, path), "id", "state") == want
    merge_into_table(path, first.withColumn("state", F.lit("c")), "id", "month")
    assert {r["state"] for r in latest_version(spark, path).collect()} == {"c"}


def test_two_writers_of_different_months(spark):
    path = run_folder(spark, "table")
    first = table(spark, [(k, date(2023, 1 + k % 2, 5), "a") for k in range(40)])
    merge_into_table(path, first, "id", "month")
    parts = [first.filter(F.col("id") % 2 == n).withColumn("state", F.lit(f"w{n}")) for n in (0, 1)]
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda c: merge_into_table(path, c, "id", "month", may_move=False), parts))
    got = latest_version(spark, path)
    assert {(r["id"], r["state"]) for r in got.collect()} == {(k, f"w{k % 2}") for k in range(40)}
    assert got.count() == 40


def test_empty_tables(spark):
    path = run_folder(spark, "table")
    none = table(spark, [])
    merge_into_table(path, none, "id", "month")
    assert latest_version(spark, path).count() == 0
    merge_into_table(path, none, "id", "month")
    merge_into_table(path, table(spark, [(1, date(2023, 1, 5), "a")]), "id", "month")
    merge_into_table(path, none, "id", "month")
    assert rows(latest_version(spark, path), "id", "state") == [(1, "a")]


def test_a_table_stays_readable_while_it_is_replaced(spark):
    path = run_folder(spark, "table")
    replace_table(table(spark, [(1, date(2023, 1, 5), "a")]), path, "id", "month")
    old = latest_version(spark, path)
    replace_table(old.withColumn("state", F.lit("z")), path, "id", "month")
    assert rows(old, "state") == [("a",)]
    assert rows(latest_version(spark, path), "state") == [("z",)]
    half = f"{path}/version=999999999999-x"
    old.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(half)
    assert rows(latest_version(spark, path), "state") == [("z",)]
