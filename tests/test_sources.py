import time
from datetime import date

import pytest

from orderlens import catalog
from orderlens.catalog import buckets_of, totals_of_bucketed
from orderlens.session import tune
from orderlens.sources import (
    RAW_SCHEMAS,
    read_shop,
    read_table,
    run_folder,
    shared_folder,
    write_bucketed,
    write_table,
)
from orderlens.sources import commerce, scratch

FILES = {
    "users": "user_id,email,signup_date,country,customer_segment\n1,a@b.co,2023-01-10,USA,Basic\n",
    "products": "product_id,product_name,category,supplier_id,cost\n5,Cog,Office,7,3.50\n",
    "orders": "order_id,user_id,order_date,status,total_amount\n9,1,2023-05-01,completed,20.00\n",
    "order_items": "order_item_id,order_id,product_id,quantity,price\n3,9,5,2,10.00\n",
    "returns": "return_id,order_item_id,return_date,return_reason,refund_amount\n",
}


@pytest.fixture
def folder(tmp_path):
    for name, text in FILES.items():
        (tmp_path / f"raw_{name}.csv").write_text(text)
    return tmp_path


def test_csv_with_declared_types(spark, folder):
    shop = read_shop(spark, str(folder))
    assert dict(shop.orders.dtypes)["total_amount"] == "decimal(10,2)"
    assert shop.users.first()["signup_date"] == date(2023, 1, 10)
    assert shop.returns.count() == 0


def test_malformed_csv_fails(spark, folder):
    path = folder / "raw_orders.csv"
    path.write_text(FILES["orders"] + "x,1,2023-05-01,completed,20.00\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_table(spark, str(path), RAW_SCHEMAS["orders"], "csv").collect()
    with pytest.raises(ValueError):
        read_table(spark, str(path), fmt="csv")


def test_partitioned_table(spark):
    path = run_folder(spark, "table")
    df = spark.range(100).selectExpr("id", "id % 3 AS part", "-id AS v")
    write_table(df, path, ["part"], ["v"])
    write_table(df, path, ["part"], ["v"])
    back = spark.read.parquet(path)
    assert back.count() == 100
    plan = back.filter("part = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan
    write_table(df, run_folder(spark, "plain"))


def test_bucketed_join_needs_no_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(1000).selectExpr("id", "id * 2 AS v")
        write_bucketed(df, "bucketed_a", "id", 4)
        write_bucketed(df, "bucketed_b", "id", 4)
        joined = spark.table("bucketed_a").join(spark.table("bucketed_b"), "id")
        assert joined.count() == 1000
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
        spark.sql("DROP TABLE IF EXISTS bucketed_a")
        spark.sql("DROP TABLE IF EXISTS bucketed_b")


def test_shared_folder_is_stable_and_run_folders_differ(spark):
    assert shared_folder(spark) == shared_folder(spark)
    assert run_folder(spark, "x") != run_folder(spark, "x")


def test_shuffles_follow_the_input(spark):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    try:
        tune(spark, 100 * 2**40)
        assert spark.conf.get(key) == "204800"
        tune(spark, 2**30)
        assert spark.conf.get(key) == "4"
    finally:
        spark.conf.unset(key)


def test_facts_of_an_order_join_without_a_shuffle(spark):
    """Bucketed by order, neither the items' sums nor their join with the orders moves rows."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = totals_of_bucketed(spark, "/root/testdata/sf0.001")
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert joined.count() == spark.read.parquet("/root/testdata/sf0.001/orders.parquet").count()


def test_buckets_follow_the_input():
    assert [buckets_of(2**20), buckets_of(2**30), buckets_of(6 * 2**30)] == [8, 64, 384]


def test_shuffles_follow_the_rows_of_the_tables(spark):
    """The files are compressed; what is shuffled and sorted are their rows."""
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    catalog._SIZES[spark.sparkContext.applicationId, "/a"] = 2**30
    try:
        catalog._tuned(spark, "/a")
        assert int(spark.conf.get(key)) == 64
    finally:
        catalog._TUNED.clear()
        spark.conf.unset(key)


def test_returns_move_before_their_ids_are_made(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        returns = commerce.shop_from_sales_tables(spark, "/root/testdata/sf0.001").returns
        plan = returns._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    assert "md5" in plan and "md5" not in plan[plan.index("Exchange"):]


def shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return disk.getAllFiles().mkString(" ").count("shuffle_")


def test_written_tables_leave_no_shuffle_files(spark):
    """The setting for it holds for the job only."""
    setting = spark.conf.get(scratch.DROP_SHUFFLES)
    spark.conf.set(scratch.DROP_SHUFFLES, "false")
    try:
        before = shuffle_files(spark)
        df = spark.range(1000).repartition(3, "id").groupBy("id").count()
        out = scratch.written(df, "counts")
        until = time.time() + 20
        while (after := shuffle_files(spark)) > before and time.time() < until:
            time.sleep(0.2)
        assert after <= before
        assert spark.conf.get(scratch.DROP_SHUFFLES) == "false"
        assert out.count() == 1000
    finally:
        spark.conf.set(scratch.DROP_SHUFFLES, setting)


def test_written_texts_come_back(spark):
    texts = [("ab",), ("AB",), ("0f",), ("",), ("é",), (None,), ("f",)]
    df = spark.createDataFrame(texts, "k string")
    out = scratch.written(df, "texts", ["k"])
    assert out.schema == df.schema
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(texts, key=repr)
