"""Micro-batch upserts and daily figures from a stream of orders."""

from __future__ import annotations

import time
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

from orderlens.operators.incremental import merge_into_table, newest_per_key


def stream_upsert(
    stream: DataFrame,
    path: str,
    key: str,
    order_col: str,
    partition_by: str,
    checkpoint: str,
) -> StreamingQuery:
    """Upsert a stream into the table at ``path``. The newest row of each key (largest
    ``order_col``, of equal ones the largest in the other columns) is kept in the state store,
    so versions that arrive out of order, in a batch or over batches, are settled before the
    sink, which gets each changed key once. A batch that is replayed gives the same table, and
    so does a stream that starts anew without its state: the stored row's order counts too.

    The state holds one row per key; for many keys use the RocksDB state store."""

    def merge(batch: DataFrame, _batch_id: int) -> None:
        merge_into_table(path, batch, key, partition_by, order_col)

    return (
        newest_per_key(stream, key, order_col)
        .writeStream.outputMode("update")
        .foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def daily_windows(
    stream: DataFrame, ts_col: str, measures: Mapping[str, Column], lateness: str = "3 days"
) -> DataFrame:
    """Figures per day of event time. Rows later than ``lateness`` are not in the figures;
    ``LateRows`` says how many there were."""
    return (
        stream.withWatermark(ts_col, lateness)
        .groupBy(F.window(ts_col, "1 day").alias("_window"))
        .agg(*[m.alias(name) for name, m in measures.items()])
        .select(F.to_date("_window.start").alias("day"), *measures)
    )


def stream_daily(
    stream: DataFrame,
    path: str,
    ts_col: str,
    measures: Mapping[str, Column],
    checkpoint: str,
    lateness: str = "3 days",
) -> StreamingQuery:
    """Keep a table with one row per day up to date. State is one small row per open
    day; a batch sends only the days that changed, and these replace the stored ones."""
    daily = daily_windows(stream, ts_col, measures, lateness)

    def merge(batch: DataFrame, _batch_id: int) -> None:
        days = batch.withColumn("year", F.year("day"))
        merge_into_table(path, days, "day", "year", may_move=False)

    return (
        daily.writeStream.outputMode("update")
        .foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


class LateRows(StreamingQueryListener):
    """Counts, for every query of a session, the rows that came too late for their day, batch
    by batch. To bring such a day up to date, compute it from all its rows and merge it
    into the table. Register it with ``spark.streams.addListener``."""

    def __init__(self):
        self._counts: dict[str, dict[int, int]] = {}

    def of(self, query: StreamingQuery, wait_seconds: float = 30) -> int:
        """Late rows in all batches of the query so far; waits for the reports of the last
        ones, which come a moment after their batch."""
        last = query.lastProgress
        until = time.monotonic() + wait_seconds
        while last and last["batchId"] not in self._counts.get(str(query.id), {}):
            if time.monotonic() > until:
                raise TimeoutError(f"no report of batch {last['batchId']}")
            time.sleep(0.05)
        return sum(self._counts.get(str(query.id), {}).values())

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = event.progress
        batches = self._counts.setdefault(str(progress.id), {})
        dropped = sum(o.numRowsDroppedByWatermark for o in progress.stateOperators)
        # A batch without rows may be reported again and again.
        batches[progress.batchId] = max(dropped, batches.get(progress.batchId, 0))

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass
