"""Build all tables of the shop into a folder.

Dimensions, daily and monthly marts are written new, next to the old ones, which stay readable
until then; order facts are merged, only for recent and named orders; customer and product
history gets one more version of its table. What later plans share is read back from what was
written.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.operators.calendar import date_spine
from orderlens.operators.history import scd2_apply
from orderlens.operators.incremental import merge_into_table, replace_table
from orderlens.params import Params
from orderlens.plans import core, finance, marketing
from orderlens.plans.enrich import orders_of_returns, packed_ids, unpacked_ids, with_written_lines
from orderlens.plans.staging import stamp
from orderlens.sources.scratch import written
from orderlens.sources.tables import Shop, latest_version, versions, write_version

HISTORIES = {
    "snap_customers": ("users", "user_id", ["customer_segment", "country"]),
    "snap_products": ("products", "product_id", ["cost", "category"]),
}


@dataclass(frozen=True)
class Layout:
    """How a mart lies on disk: partitions for pruning, sort order for clustering."""

    partition_by: Sequence[str] = ()
    sort_by: Sequence[str] = ()


LAYOUTS = {
    "dim_customers": Layout(sort_by=["customer_segment", "customer_id"]),
    "dim_date": Layout(),
    "fct_order_items": Layout(["order_month"], ["category", "customer_id"]),
    "mart_product_performance": Layout(sort_by=["category", "product_id"]),
    "fct_daily_revenue": Layout(),
    "fct_product_profitability": Layout(["month_id"], ["product_id"]),
    "fct_customer_cohorts": Layout(),
    "fct_customer_segments": Layout(),
    "fct_rfm_analysis": Layout(),
}


def due_for_refresh(
    shop: Shop, newest: Column, lookback_days: int, changed_orders: DataFrame | None = None
) -> Shop:
    """The shop cut down to what an incremental run reads: orders dated no earlier than
    ``lookback_days`` before ``newest`` and those in ``changed_orders``, and their items, cut
    before any join of the plans. Returns don't name their order: finding those of the items
    would move as much as the plans' own join, which drops the others."""
    due = newest.isNull() | (F.col("order_date") >= F.date_sub(newest, lookback_days))
    orders = shop.orders
    if changed_orders is None:
        orders = orders.filter(due)
    else:
        named = changed_orders.select(F.col("order_id").alias("_named")).distinct()
        named = written(named, "named_orders")
        orders = orders.join(named, F.col("order_id") == F.col("_named"), "left").filter(
            due | F.col("_named").isNotNull()
        ).drop("_named")
    items = packed_ids(shop.order_items, shop).join(
        orders.select("order_id"), "order_id", "left_semi"
    )
    return shop.replace(orders=orders, order_items=unpacked_ids(items, shop))


def refresh_orders(
    shop: Shop,
    p: Params,
    path: str,
    full_refresh: bool = False,
    changed_orders: DataFrame | None = None,
) -> None:
    """Bring the order facts at ``path`` up to date. After the first finished load only
    orders in the lookback, those in ``changed_orders`` and those with a return since the
    last run's newest order are read and joined: the newest date is one small query, and
    the items are cut down to these orders before any join."""
    stored = None if full_refresh else latest_version(shop.orders.sparkSession, path)
    if stored is None:
        replace_table(core.fct_orders(shop, p), path, "order_id", "order_month")
        return
    newest = F.lit(stored.agg(F.max("order_date")).first()[0])
    since = F.date_sub(newest, p.lookback_days)
    late = shop.returns.filter(F.col("return_date") >= since)
    named = orders_of_returns(shop, late)
    if changed_orders is not None:
        named = named.unionByName(changed_orders.select("order_id"))
    due = due_for_refresh(shop, newest, p.lookback_days, named)
    merge_into_table(path, core.fct_orders(due, p), "order_id", "order_month")


def read_history(spark: SparkSession, path: str) -> DataFrame | None:
    """A history table: the open rows of the newest complete run, and what that run and those
    before it closed."""
    opened = versions(spark, f"{path}/open")
    if not opened:
        return None
    newest = opened[-1].rsplit("/", 1)[1]
    closed = [v for v in versions(spark, f"{path}/closed") if v.rsplit("/", 1)[1] <= newest]
    rows = spark.read.parquet(opened[-1])
    # Runs may differ in their columns.
    for folder in closed:
        rows = rows.unionByName(spark.read.parquet(folder), allowMissingColumns=True)
    return rows


def refresh_history(snapshot: DataFrame, path: str, key: str, check: list[str], at: datetime):
    """Bring a history table up to date. Closed rows never change, so a run only adds those it
    closes, and writes the open rows next to the old ones; it reads no closed row. A reader
    sees a run when its open rows are complete. A run that is repeated with the same time finds
    itself complete and does nothing; one that broke off is written again."""
    spark = snapshot.sparkSession
    name = f"{at:%Y%m%d%H%M%S%f}"
    done = versions(spark, f"{path}/open")
    if any(v.endswith(f"/version={name}") for v in done):
        return
    old = spark.read.parquet(done[-1]) if done else None
    after = scd2_apply(old, snapshot, key, check, F.lit(at))
    if old is not None:
        # Used for both parts.
        after = written(after, "history")
        closed = after.filter("valid_to IS NOT NULL")
        write_version(closed, f"{path}/closed", sort_by=[key], name=name)
    write_version(after.filter("valid_to IS NULL"), f"{path}/open", sort_by=[key], name=name)


def build(
    shop: Shop,
    p: Params,
    folder: str,
    full_refresh: bool = False,
    changed_orders: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Write every mart and history table below ``folder`` and return them by name."""
    if p.run_ts is None:
        raise ValueError("a build needs the time of its run: Params(run_ts=...)")
    spark = shop.orders.sparkSession
    refresh_orders(shop, p, f"{folder}/fct_orders", full_refresh, changed_orders)
    for name, (table, key, check) in HISTORIES.items():
        refresh_history(getattr(shop, table), f"{folder}/{name}", key, check, p.run_ts)

    shop = with_written_lines(shop)
    spine = date_spine(spark, p.spine_start, p.spine_end)
    plans = {
        "dim_customers": lambda: core.dim_customers(shop, p),
        "dim_date": lambda: core.dim_date(spine, p),
        "fct_order_items": lambda: core.fct_order_items(shop, p),
        "mart_product_performance": lambda: core.mart_product_performance(shop, p),
        "fct_daily_revenue": lambda: stamp(finance.daily_revenue(facts()), "_updated_at", p),
        "fct_product_profitability": lambda: finance.fct_product_profitability(shop, p),
        "fct_customer_cohorts": lambda: marketing.fct_customer_cohorts(shop, p),
        "fct_customer_segments": lambda: marketing.segments_of(customers(), p),
        "fct_rfm_analysis": lambda: marketing.rfm_of(customers(), p),
    }

    def facts() -> DataFrame:
        return latest_version(spark, f"{folder}/fct_orders")

    def customers() -> DataFrame:
        return latest_version(spark, f"{folder}/dim_customers").drop("_updated_at")

    for name, plan in plans.items():
        layout = LAYOUTS[name]
        write_version(plan(), f"{folder}/{name}", layout.partition_by, layout.sort_by)
    tables = {name: latest_version(spark, f"{folder}/{name}") for name in [*plans, "fct_orders"]}
    return tables | {name: read_history(spark, f"{folder}/{name}") for name in HISTORIES}
