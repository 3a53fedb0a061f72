from dataclasses import replace
from datetime import datetime

import pytest
from conftest import ROWS, day, frames, money, rows
from pyspark.sql import functions as F

from orderlens.plans import core, enrich, marketing
from orderlens.operators.history import scd2_apply
from orderlens.plans.build import build, read_history, refresh_history, refresh_orders
from orderlens.sources import SALES_PARAMS, Shop, latest_version, run_folder, write_table
from orderlens.sources.tables import versions, write_version

P = replace(SALES_PARAMS, run_ts=datetime(2001, 8, 2, 6))


def test_build_and_incremental_build(spark, shop):
    folder = run_folder(spark, "build")
    tables = build(shop, P, folder)
    assert len(tables) == 12
    plain = core.fct_orders(shop, SALES_PARAMS)
    assert rows(tables["fct_orders"], *plain.columns) == rows(plain)
    rfm = marketing.fct_rfm_analysis(shop, SALES_PARAMS)
    assert rows(tables["fct_rfm_analysis"], *rfm.columns) == rows(rfm)
    assert tables["snap_customers"].filter("valid_to IS NOT NULL").count() == 0

    # A late order, a late return of an old order, a customer who moved.
    later = {name: list(held) for name, held in ROWS.items()}
    later["orders"].append((110, 5, day(7, 30), "completed", money("3.00")))
    later["order_items"].append(("m", 110, 12, 6, money("1.00")))
    later["returns"].append(("r11", "c", day(8, 1), "defective", money("0.10")))
    later["users"][0] = (*later["users"][0][:3], "Z", *later["users"][0][4:])
    now = Shop(**frames(spark, later))
    next_run = replace(P, run_ts=datetime(2001, 8, 3, 6))
    tables = build(now, next_run, folder)
    facts = {r["order_id"]: r for r in tables["fct_orders"].collect()}
    assert len(facts) == 11 and facts[110]["subtotal"] == money("6.00")
    assert facts[101]["is_returned"]  # outside the lookback, named by its late return
    assert facts[100]["_updated_at"] == P.run_ts
    assert facts[110]["_updated_at"] == next_run.run_ts
    moved = tables["snap_customers"].filter("user_id = 1")
    assert rows(moved, "country") == [("A",), ("Z",)]

    # The daily figures follow the facts.
    sums = tables["fct_orders"].agg(F.sum("refund_amount"), F.sum("net_revenue")).first()
    daily = tables["fct_daily_revenue"].agg(F.sum("total_refunds"), F.sum("net_revenue")).first()
    assert tuple(sums) == tuple(daily)

    # A run that is repeated gives the same tables.
    before = rows(tables["fct_orders"])
    again = build(now, next_run, folder)
    assert again["snap_customers"].count() == 6
    assert rows(again["fct_orders"]) == before

    changed = spark.createDataFrame([(101,)], "order_id bigint")
    refresh_orders(now, next_run, f"{folder}/fct_orders", changed_orders=changed)
    facts = latest_version(spark, f"{folder}/fct_orders")
    assert facts.filter("order_id = 101").first()["is_returned"]
    want = core.fct_orders(now, SALES_PARAMS).filter("order_id IN (101, 104, 110)")
    same = facts.filter(F.col("order_id").isin(101, 104, 110))
    assert rows(same, *want.columns) == rows(want)

    refresh_orders(now, next_run, f"{folder}/fct_orders", full_refresh=True)
    whole = core.fct_orders(now, SALES_PARAMS)
    assert rows(latest_version(spark, f"{folder}/fct_orders"), *whole.columns) == rows(whole)


def test_history_runs_add_only_what_they_close(spark):
    path = run_folder(spark, "history")
    first = spark.range(1000).selectExpr("id", "'a' AS state", "1 AS other")
    days = [datetime(2023, 1, d) for d in range(1, 5)]
    changed = first.withColumn("state", F.when(F.col("id") < 10, "b").otherwise(F.col("state")))
    runs = [first, changed, changed.filter("id <> 999"), changed.withColumn("extra", F.lit(2))]
    history = None
    for day_, snapshot in zip(days, runs, strict=True):
        refresh_history(snapshot, path, "id", ["state"], day_)
        history = scd2_apply(history, snapshot, "id", ["state"], F.lit(day_))
        assert rows(read_history(spark, path), *history.columns) == rows(history)
        refresh_history(first.limit(0), path, "id", ["state"], day_)  # repeated: nothing to do
    closed = [spark.read.parquet(v).count() for v in versions(spark, f"{path}/closed")]
    assert closed == [10, 1, 0]
    opened = [spark.read.parquet(v).count() for v in versions(spark, f"{path}/open")]
    assert opened == [1000, 1000, 999, 1000]
    # A run that broke off after its closed rows isn't seen, and is written again.
    later = datetime(2023, 2, 1)
    old = rows(read_history(spark, path), "id", "state")
    write_version(history.limit(5), f"{path}/closed", name=f"{later:%Y%m%d%H%M%S%f}")
    assert rows(read_history(spark, path), "id", "state") == old
    refresh_history(first, path, "id", ["state"], later)
    assert read_history(spark, path).filter("valid_to IS NULL").count() == 1000
    assert read_history(spark, path).filter("valid_to IS NOT NULL").count() == 21


def test_build_after_a_load_that_broke_off(spark, shop):
    folder = run_folder(spark, "build")
    core.fct_orders(shop, SALES_PARAMS).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false"
    ).parquet(f"{folder}/fct_orders/version=000000000001-half")
    refresh_orders(shop, P, f"{folder}/fct_orders")
    assert latest_version(spark, f"{folder}/fct_orders").count() == 10


def test_full_write_removes_old_partitions_in_every_mode(spark):
    path = run_folder(spark, "mart")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        write_table(spark.createDataFrame([("a", 1), ("b", 2)], "p string, v int"), path, ["p"])
        write_table(spark.createDataFrame([("b", 3)], "p string, v int"), path, ["p"])
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert rows(spark.read.parquet(path), "p", "v") == [("b", 3)]


def test_null_quantity_and_repeated_items(spark):
    data = {name: list(held) for name, held in ROWS.items()}
    data["orders"] = [(1, 1, day(3, 1), "completed", money("10.00"))]
    data["order_items"] = [
        ("a", 1, 10, 4, money("1.00")), ("b", 1, 10, None, money("1.00")),
        ("a", 1, 10, 4, money("1.00")),
    ]
    data["returns"] = []
    held = Shop(**frames(spark, data))
    customers = enrich.int_customer_orders(held, SALES_PARAMS).filter("user_id = 1")
    assert rows(customers, "avg_items_per_order") == [(4.0,)]
    assert rows(enrich.order_rollup(held, SALES_PARAMS), "item_count") == [(2,)]


def test_build_needs_a_run_time(shop):
    with pytest.raises(ValueError):
        build(shop, SALES_PARAMS, "/nowhere")
