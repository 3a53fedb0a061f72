from datetime import date

import pytest
from conftest import rows as rows_of
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderlens.operators.calendar import date_spine, spine_of
from orderlens.operators.ranking import ntile, row_number, with_tiles
from orderlens.operators.rollup import (
    distinct,
    largest,
    nested_rollup,
    one_row,
    rows,
    smallest,
    total,
)
from orderlens.operators.windows import (
    first_of,
    moving_average,
    over_rows,
    previous,
    running_total,
)


@pytest.fixture(scope="module")
def sales(spark):
    """A third of all rows belongs to one customer; some ids are NULL."""
    return spark.range(3000).selectExpr(
        "id % 5 AS region",
        "if(id % 3 = 0, 1, id % 40) AS raw_user",
        "if(id % 97 = 0, NULL, id) AS order_id",
        "id % 11 AS amount",
        "id % 4 = 0 AS flag",
    ).selectExpr("*", "if(raw_user = 7, NULL, raw_user) AS user_id")


def test_nested_rollup_equals_distinct_counts(sales):
    got = nested_rollup(
        sales,
        by=["region"],
        nest=["user_id", "order_id"],
        measures={
            "users": distinct("user_id"),
            "flagged_users": distinct("user_id", "flag"),
            "orders": distinct("order_id"),
            "flagged_orders": distinct("order_id", "flag"),
            "amount": total("amount"),
            "n": rows(),
            "flagged": rows("flag"),
            "low": smallest("amount"),
            "high": largest("amount"),
        },
    )
    want = sales.groupBy("region").agg(
        F.countDistinct("user_id").alias("users"),
        F.countDistinct(F.when(F.col("flag"), F.col("user_id"))).alias("flagged_users"),
        F.countDistinct("order_id").alias("orders"),
        F.countDistinct(F.when(F.col("flag"), F.col("order_id"))).alias("flagged_orders"),
        F.sum("amount").alias("amount"),
        F.count(F.lit(1)).alias("n"),
        F.count_if("flag").alias("flagged"),
        F.min("amount").alias("low"),
        F.max("amount").alias("high"),
    )
    assert rows_of(got, *want.columns) == rows_of(want)


def test_nested_rollup_without_groups_and_rows(sales):
    measures = {"users": distinct("user_id"), "amount": total("amount")}
    assert nested_rollup(sales, [], ["user_id"], measures).first()["users"] == 39
    empty = nested_rollup(sales.limit(0), [], ["user_id"], measures).collect()
    assert [tuple(r) for r in empty] == [(0, None)]


def test_nested_rollup_rejects_unknown_level(sales):
    with pytest.raises(ValueError):
        nested_rollup(sales, ["region"], ["user_id"], {"x": distinct("order_id")})


def test_nested_rollup_does_not_copy_rows(sales):
    plan = nested_rollup(
        sales,
        ["region"],
        ["user_id", "order_id"],
        {"users": distinct("user_id"), "orders": distinct("order_id")},
    )._jdf.queryExecution().toString()
    assert "Expand" not in plan


def test_one_row_has_no_join(sales):
    df = one_row(
        sales.sparkSession,
        sales.agg(F.sum("amount").alias("a")),
        sales.agg(F.max("amount").alias("b"), F.count("user_id").alias("c")),
    )
    assert df.columns == ["a", "b", "c"]
    assert "Join" not in df._jdf.queryExecution().executedPlan().toString()
    assert df.first()["b"] == 10


@pytest.mark.parametrize("n", [0, 1, 4, 5, 6, 1003])
@pytest.mark.parametrize("tiles", [1, 3, 5])
def test_ntile_equals_window(spark, n, tiles):
    df = spark.range(n).selectExpr("id", "if(id % 4 = 0, NULL, id % 3) AS v")
    order = [F.desc_nulls_last("v"), F.asc("id")]
    got = ntile(df, tiles, order, out="t")
    want = df.withColumn("t", F.ntile(tiles).over(W.orderBy(*order)))
    assert rows_of(got) == rows_of(want)


def test_row_number_in_large_and_null_groups(spark):
    df = spark.range(2000).selectExpr("id", "if(id % 3 = 0, NULL, if(id % 3 = 1, 1, id % 7)) AS g")
    order = [F.desc("id")]
    got = row_number(df, order, ["g"], out="r")
    want = df.withColumn("r", F.row_number().over(W.partitionBy("g").orderBy(*order)))
    assert rows_of(got) == rows_of(want)


def test_distributed_rank_uses_many_tasks(spark):
    df = spark.range(20000).selectExpr("id", "1 AS g")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = row_number(df, ["id"], ["g"])
        assert ranked.rdd.getNumPartitions() > 1
        assert ranked.filter("row_number <> id + 1").count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_series_windows(spark):
    df = spark.createDataFrame(
        [(d, v) for d, v in enumerate([4, 1, 7, 2, 2, 9, 3, 5])], "d int, v int"
    )
    v = F.col("v")
    got = df.select(
        "d",
        running_total(v, "d").alias("sum"),
        moving_average(v, 3, "d").alias("mean"),
        previous(v, "d").alias("before"),
        first_of(v, "d").alias("first"),
    ).orderBy("d")
    got = [tuple(r) for r in got.collect()]
    assert [r[1] for r in got] == [4, 5, 12, 14, 16, 25, 28, 33]
    assert got[-1][1] == df.agg(F.sum("v")).first()[0]
    assert [r[2] for r in got][:4] == [4, 2.5, 4, 10 / 3]
    assert [r[3] for r in got] == [None, 4, 1, 7, 2, 2, 9, 3]
    assert {r[4] for r in got} == {4}


def test_date_spine(spark):
    start, end = date(2023, 1, 1), date(2023, 12, 31)
    assert date_spine(spark, start, end).count() == 364
    assert date_spine(spark, start, end, end_inclusive=True).count() == 365
    assert date_spine(spark, start, end, "month").count() == 12
    assert date_spine(spark, end, start).count() == 0
    with pytest.raises(ValueError):
        date_spine(spark, start, end, "hour")


def test_spine_of_a_column(spark, shop):
    days = spine_of(shop.orders, "order_date")
    assert days.agg(F.min("date_day"), F.max("date_day"), F.count("date_day")).first()[:] == (
        date(2001, 1, 31),
        date(2001, 7, 31),
        182,
    )
    assert spine_of(shop.orders.limit(0), "order_date").count() == 0


def test_tiles_by_several_values(spark):
    """As ntile over the rows in order, with ties, NULL and fewer rows than tiles."""
    for n in (0, 1, 3, 5, 7, 503):
        df = spark.range(n).selectExpr(
            "id", "if(id % 11 = 3, NULL, id % 4) AS a", "cast(id * 37 % 101 AS decimal(10,2)) AS b"
        )
        got = with_tiles(df, {"ta": F.col("a"), "tb": -F.col("b")}, 5, "id")
        assert got.columns == ["id", "a", "b", "ta", "tb"]
        want = df.selectExpr(
            "id", "ntile(5) OVER (ORDER BY a NULLS LAST, id) AS ta",
            "ntile(5) OVER (ORDER BY -b NULLS LAST, id) AS tb",
        )
        found = sorted(tuple(r) for r in got.select("id", "ta", "tb").collect())
        assert found == sorted(tuple(r) for r in want.collect())


@pytest.mark.parametrize("block_rows", [6, 50, 10_000])
def test_windows_over_any_number_of_rows(spark, block_rows):
    df = spark.range(700).selectExpr(
        "id", "if(id % 13 < 9, 'big', if(id % 13 = 9, NULL, 'small')) AS g",
        "id * 7919 % 101 AS day", "if(id % 10 = 4, NULL, cast(id % 37 AS decimal(12,2))) AS v",
    )
    for groups in ([], ["g"]):
        got = over_rows(df, ["day", "id"], groups, {"s": "v"}, {"m": "v"}, {"p": "v"},
                        block_rows=block_rows)
        w = W.partitionBy(*groups).orderBy("day", "id")
        last = w.rowsBetween(-6, 0)
        want = df.withColumns({
            "s": F.sum("v").over(w.rowsBetween(W.unboundedPreceding, 0)),
            "m": F.sum("v").over(last).cast("double") / F.count("v").over(last),
            "p": F.lag("v").over(w),
        })
        assert got.columns == want.columns
        found, expected = ({r["id"]: tuple(r) for r in x.collect()} for x in (got, want))
        assert found.keys() == expected.keys()
        for i, row in expected.items():
            assert found[i][:5] == row[:5] and found[i][6] == row[6]
            assert found[i][5] == (None if row[5] is None else pytest.approx(row[5]))
        assert "SinglePartition" not in got._jdf.queryExecution().toString()
    with pytest.raises(ValueError):
        over_rows(df, ["day", "id"], means={"m": "v"}, block_rows=3)
