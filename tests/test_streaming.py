from datetime import date, datetime

from conftest import rows
from pyspark.sql import functions as F

from orderlens.catalog import QUERIES
from orderlens.sources import latest_version, run_folder
from orderlens.sources.commerce import SALES_SCHEMAS
from orderlens.streaming.jobs import LateRows, daily_windows, stream_daily, stream_upsert

ORDER = "order_id int, version int, day date, state string"


def land(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def test_stream_upsert_over_several_arrivals(spark):
    landing, table = run_folder(spark, "landing"), run_folder(spark, "table")
    checkpoint = run_folder(spark, "stream")

    def arrive(*new):
        land(spark, landing, list(new), ORDER)
        stream = spark.readStream.schema(ORDER).parquet(landing)
        stream = stream.withColumn("month", F.trunc("day", "month"))
        stream_upsert(stream, table, "order_id", "version", "month", checkpoint).awaitTermination()
        return rows(latest_version(spark, table), "order_id", "version", "state")

    jan, feb = date(2023, 1, 5), date(2023, 2, 5)
    assert arrive((1, 1, jan, "open"), (1, 2, jan, "paid"), (2, 1, feb, "open")) == [
        (1, 2, "paid"),
        (2, 1, "open"),
    ]
    # 2 moves to January, 3 is new; a restart does not read the old files again.
    assert arrive((2, 2, jan, "moved"), (3, 1, feb, "open")) == [
        (1, 2, "paid"),
        (2, 2, "moved"),
        (3, 1, "open"),
    ]
    # What arrives out of order doesn't replace what is newer.
    assert arrive((1, 1, feb, "late"), (3, 0, jan, "late"))[0] == (1, 2, "paid")
    assert rows(latest_version(spark, table), "order_id").count((3,)) == 1


def test_stream_daily_drops_only_what_is_too_late(spark):
    schema = "order_id int, ts timestamp, amount int"
    landing, table = run_folder(spark, "landing"), run_folder(spark, "daily")
    checkpoint = run_folder(spark, "stream")
    measures = {"orders": F.count("order_id"), "revenue": F.sum("amount")}
    dropped = []
    late = LateRows()
    spark.streams.addListener(late)

    def arrive(*new):
        land(spark, landing, list(new), schema)
        stream = spark.readStream.schema(schema).parquet(landing)
        query = stream_daily(stream, table, "ts", measures, checkpoint)
        query.awaitTermination()
        dropped.append(late.of(query))
        got = latest_version(spark, table).select(F.dayofmonth("day"), "orders", "revenue")
        return sorted(tuple(r) for r in got.collect())

    def at(day, hour=12):
        return datetime(2023, 5, day, hour)

    assert arrive((1, at(1), 10), (2, at(9), 20), (3, at(10), 1)) == [
        (1, 1, 10),
        (9, 1, 20),
        (10, 1, 1),
    ]
    # The 9th is inside three days of the newest row, the 2nd is not.
    assert arrive((4, at(9, 1), 5), (5, at(2), 99)) == [(1, 1, 10), (9, 2, 25), (10, 1, 1)]
    assert dropped == [0, 1]
    spark.streams.removeListener(late)


def test_late_rows_of_more_batches_than_spark_remembers(spark):
    """Every batch but the first ones holds one row that is too late."""
    schema = "order_id int, ts timestamp, amount int"
    landing = run_folder(spark, "landing")
    for k in range(110):
        ts = [datetime(2023, 5, 20, 12)] if k < 5 else [datetime(2023, 5, 1), datetime(2023, 5, 20)]
        land(spark, landing, [(k, t, 1) for t in ts], schema)
    late = LateRows()
    spark.streams.addListener(late)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landing)
    daily = daily_windows(stream, "ts", {"orders": F.count("order_id")})
    query = (
        daily.writeStream.outputMode("update").format("noop")
        .option("checkpointLocation", run_folder(spark, "stream")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert late.of(query) == 105 and len(query.recentProgress) <= 100
    spark.streams.removeListener(late)


def test_upsert_settles_versions_in_its_state(spark):
    """One call of the sink per batch gets each changed key once, in its newest version."""
    landing, table = run_folder(spark, "landing"), run_folder(spark, "table")
    jan = date(2023, 1, 5)
    land(spark, landing, [(k, v, jan, f"s{v}") for k in range(50) for v in (3, 1, 2)], ORDER)
    stream = spark.readStream.schema(ORDER).parquet(landing).withColumn("month", F.trunc("day", "month"))
    checkpoint = run_folder(spark, "stream")
    query = stream_upsert(stream, table, "order_id", "version", "month", checkpoint)
    query.awaitTermination()
    state = query.lastProgress["stateOperators"][0]
    assert state["numRowsTotal"] == 50
    assert rows(latest_version(spark, table), "version") == [(3,)] * 50
    # A new checkpoint reads all files again; a stored newer row still wins.
    land(spark, landing, [(0, 9, jan, "s9")], ORDER)
    for _ in range(2):
        stream_upsert(
            stream, table, "order_id", "version", "month", run_folder(spark, "stream")
        ).awaitTermination()
    got = latest_version(spark, table)
    assert rows(got.filter("order_id = 0"), "version") == [(9,)] and got.count() == 50


def test_daily_query_on_a_table_of_several_files(spark, tmp_path):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    orders.repartition(3).write.parquet(f"{tmp_path}/orders.parquet")
    for name in SALES_SCHEMAS.keys() - {"orders"}:
        (tmp_path / f"{name}.parquet").mkdir()
    got = QUERIES["stream_daily_revenue"](spark, str(tmp_path))
    want = QUERIES["stream_daily_revenue"](spark, "/root/testdata/sf0.001")
    assert rows(got) == rows(want)
