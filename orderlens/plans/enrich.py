"""Joined and aggregated building blocks below the marts.

The item lines are read once: all order, customer and order-fact figures come from
one rollup of the lines to orders, done before any order column is joined, so that
only partial sums are shuffled by order.

An item with several returns makes one line per return, so it counts that many times
in every sum. The rollups get the same figures without making those lines: returns
are added up per item first, and an item's units are multiplied by its ``copies``.
Item ids are unique, as the declared checks demand.

Items are shuffled by their id, order and product, so what a row weighs counts. Text ids travel
``packed``, filters and narrow tables are joined first, wide columns last.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderlens.functions import packed, surrogate_key, unpacked
from orderlens.operators.rollup import (
    distinct,
    largest,
    nested_rollup,
    rows,
    smallest,
    total,
)
from orderlens.params import QUALITY_REASONS, Params
from orderlens.plans.staging import (
    stamp,
    stg_orders,
    stg_products,
    stg_returns,
    stg_users,
)
from orderlens.session import shuffle_partitions
from orderlens.sources.scratch import run_folder, shuffles_dropped, written
from orderlens.sources.tables import Shop, write_bucketed

MARGIN = "if(gross_amount > 0, gross_profit / double(gross_amount), 0d)"


def unstamped(p: Params) -> Params:
    return replace(p, run_ts=None)


ITEM_ID = "order_item_id"


def has_text_ids(shop: Shop) -> bool:
    return all(dict(t.dtypes)[ITEM_ID] == "string" for t in (shop.order_items, shop.returns))


def packed_ids(df: DataFrame, shop: Shop) -> DataFrame:
    """Items or returns with packed item ids, if both tables have text ids."""
    return df.withColumn(ITEM_ID, packed(F.col(ITEM_ID))) if has_text_ids(shop) else df


def unpacked_ids(df: DataFrame, shop: Shop) -> DataFrame:
    return df.withColumn(ITEM_ID, unpacked(F.col(ITEM_ID))) if has_text_ids(shop) else df


def orders_of_returns(shop: Shop, returns: DataFrame) -> DataFrame:
    """The order of each item with one of these ``returns``."""
    late = packed_ids(returns.select(ITEM_ID), shop)
    items = packed_ids(shop.order_items.select(ITEM_ID, "order_id"), shop)
    return items.join(late, ITEM_ID, "left_semi").select("order_id")


# What is numbered: rows of a key, in the order of what plans read of them, and the number's name.
PRODUCT_ROWS = ("product_id", ("cost", "product_name", "category", "supplier_id"), "product_row")
RETURN_ROWS = (ITEM_ID, ("return_id", "return_date", "return_reason", "refund"), "return_row")


def numbered(
    df: DataFrame, key: str, order: Sequence[str], name: str, **renamed: str
) -> DataFrame:
    """Rows with the place of each among those of its key, from 1. Rows without the key are left
    out. Key and place are grouped on, so Spark knows that they are unique, and drops a left
    join of which a plan reads nothing else."""
    place = W.partitionBy(key).orderBy(*[renamed.get(column, column) for column in order])
    rows = df.filter(F.col(key).isNotNull()).withColumn(name, F.row_number().over(place))
    return rows.dropDuplicates([key, name])


def int_order_items_enriched(shop: Shop, p: Params) -> DataFrame:
    """Items of known orders and products with economics, one row per return or one for
    an item without returns."""
    orders = stg_orders(shop.orders, unstamped(p)).select(
        "order_id", "user_id", "order_date", "order_status", "is_completed", "is_cancelled"
    )
    products = stg_products(shop.products, unstamped(p))
    returns = stg_returns(shop.returns, unstamped(p)).drop("return_month")
    returns = packed_ids(returns.withColumnRenamed("refund_amount", "refund"), shop)
    if shop.lines is not None and "product_row" in shop.lines.columns:
        products = numbered(products, *PRODUCT_ROWS, cost="unit_cost")
        returns = numbered(returns, *RETURN_ROWS)
        lines = (
            shop.lines.filter("known")
            .selectExpr(
                "order_item_id", "order_id", "product_id", "product_row", "quantity",
                "unit_price AS price", "explode(sequence(1, int(ifnull(copies, 1)))) AS return_row",
            )
            .join(orders, "order_id")
            .join(returns, ["order_item_id", "return_row"], "left")
            .join(products, ["product_id", "product_row"], "left")
        )
    else:
        lines = (
            packed_ids(shop.order_items, shop)
            .join(orders, "order_id")
            .join(returns, "order_item_id", "left")
            .join(products, "product_id")
        )
    out = (
        unpacked_ids(lines, shop)
        .selectExpr(
            "order_item_id",
            "order_id",
            "product_id",
            "user_id",
            "order_date",
            "order_status",
            "is_completed",
            "is_cancelled",
            "product_name",
            "category",
            "category_group",
            "supplier_id",
            "unit_cost",
            "quantity",
            "price AS unit_price",
            "quantity * price AS gross_amount",
            "unit_cost * quantity AS total_cost",
            "gross_amount - total_cost AS gross_profit",
            f"{MARGIN} AS gross_margin_pct",
            "return_id IS NOT NULL AS is_returned",
            "return_id",
            "return_date",
            "return_reason",
            "return_reason_category",
            "is_quality_issue",
            "ifnull(refund, 0) AS refund_amount",
            "gross_amount - ifnull(refund, 0) AS net_revenue",
        )
    )
    return stamp(out, "_loaded_at", p)


def returns_per_item(shop: Shop) -> DataFrame:
    quality = ", ".join(f"'{r}'" for r in QUALITY_REASONS)
    measures = [
        "count(*) AS copies",
        "count(return_id) AS returns",
        f"count_if(return_id IS NOT NULL AND return_reason IN ({quality})) AS quality_returns",
        "sum(refund_amount) AS refund",
        "min(if(return_id IS NOT NULL, return_date, NULL)) AS first_return_date",
    ]
    return packed_ids(shop.returns, shop).groupBy("order_item_id").agg(*[F.expr(m) for m in measures])


LINE = (
    "order_item_id",
    "order_id",
    "product_id",
    "ifnull(known, false) AS known",
    "unit_cost",
    "quantity",
    "price AS unit_price",
    "copies",
    "returns",
    "quality_returns",
    "refund",
    "first_return_date",
)


def with_costs(items: DataFrame, shop: Shop) -> DataFrame:
    products = shop.products.selectExpr("product_id", "cost AS unit_cost", "true AS known")
    return items.join(products, "product_id", "left")


def with_returns(items: DataFrame, shop: Shop) -> DataFrame:
    return items.join(returns_per_item(shop), ITEM_ID, "left")


def joined_lines(shop: Shop) -> DataFrame:
    """One row per item with its product's cost and the sum of its returns. Items of
    unknown products are kept and have ``known`` false. Item ids are ``packed``. Returns are
    joined last: rows that lie by item id need no shuffle to be grouped by order and item."""
    if shop.lines is not None:
        return shop.lines
    items = packed_ids(shop.order_items, shop)
    return with_returns(with_costs(items, shop), shop).selectExpr(*LINE)


def with_amounts(lines: DataFrame) -> DataFrame:
    """The figures that follow from a line's own columns, made after its last shuffle: they
    weigh more than what they are made of."""
    drop = ("unit_cost", "quantity", "refund")
    kept = [column for column in lines.columns if column not in drop]
    counts = ("copies", "returns", "quality_returns")
    return lines.selectExpr(
        *[column for column in kept if column not in counts],
        "ifnull(copies, 1) AS copies",
        "quantity * ifnull(copies, 1) AS units",
        "units * unit_price AS gross_amount",
        "units * unit_cost AS total_cost",
        "gross_amount - total_cost AS gross_profit",
        "ifnull(returns, 0) AS returns",
        "ifnull(quality_returns, 0) AS quality_returns",
        "ifnull(refund, 0) AS refund_amount",
        "gross_amount - ifnull(refund, 0) AS net_revenue",
    )


def item_lines(shop: Shop) -> DataFrame:
    return with_amounts(joined_lines(shop))


def with_written_lines(shop: Shop) -> Shop:
    """A shop whose item lines are joined once and written to the shared folder, for
    building several marts from them. They are bucketed by order, so no mart shuffles them
    to group them by order or to join the orders."""
    return shop.replace(lines=_by_order(joined_lines(shop), "lines"))


def odd_products(shop: Shop) -> DataFrame:
    """The product ids of items that don't stand for one product: an unknown one with a NULL
    ``product_row``, a repeated one once for each row. To find them, only ids are moved."""
    known = shop.products.groupBy("product_id").agg(F.count(F.lit(1)).alias("n"))
    ids = shop.order_items.select("product_id").filter("product_id IS NOT NULL").distinct()
    odd = ids.join(known, "product_id", "left").filter("n IS NULL OR n > 1")
    each = "explode(if(n IS NULL, array(CAST(NULL AS int)), sequence(1, int(n)))) AS product_row"
    return written(odd.selectExpr("product_id", each), "odd_products")


def with_written_items(shop: Shop) -> Shop:
    """A shop for many plans that each read few columns. Orders, and items with their
    product's row and their number of returns, are written bucketed by order, so no plan
    shuffles either to join them or to group them by order. ``lines`` gets the rest of its
    columns, and ``int_order_items_enriched`` those of products and returns, by joins on unique
    keys, which Spark leaves out of a plan that reads none of them. Returns are written once,
    too. Items meet their product by the exceptions, which are few as a rule, and move only if
    they aren't."""
    texts = [c for c in ("return_id", ITEM_ID) if dict(shop.returns.dtypes)[c] == "string"]
    shop = shop.replace(returns=written(shop.returns, "returns", texts))
    odd = odd_products(shop).withColumn("odd", F.lit(True))
    copies = packed_ids(shop.returns, shop).groupBy(ITEM_ID).agg(F.count(F.lit(1)).alias("copies"))
    row = F.when(F.col("odd"), F.col("product_row")).when(F.col("product_id").isNotNull(), 1)
    items = (
        packed_ids(shop.order_items, shop)
        .join(odd, "product_id", "left")
        .withColumn("product_row", row)
        .join(copies, ITEM_ID, "left")
        .select(ITEM_ID, "order_id", "product_id", "quantity", "price", "product_row", "copies")
    )
    items = _by_order(items, "items")
    costs = numbered(shop.products, *PRODUCT_ROWS)
    lines = (
        items.join(
            costs.selectExpr("product_id", "product_row", "cost AS unit_cost"),
            ["product_id", "product_row"],
            "left",
        )
        .join(returns_per_item(shop).drop("copies"), ITEM_ID, "left")
        .withColumn("known", F.expr("product_row IS NOT NULL"))
        .selectExpr(*LINE, "product_row")
    )
    # Each item as it came: one row, however many rows its product has.
    own = items.filter("ifnull(product_row, 1) = 1").drop("product_row", "copies")
    orders = _by_order(shop.orders, "orders")
    return shop.replace(orders=orders, order_items=unpacked_ids(own, shop), lines=lines)


def _by_order(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    table, path = f"{name}_{uuid.uuid4().hex}", run_folder(spark, name)
    with shuffles_dropped(spark):
        return write_bucketed(
            df, table, "order_id", shuffle_partitions(spark), path=path, compression="zstd"
        )


def order_rollup(shop: Shop, p: Params) -> DataFrame:
    """Item lines per order. Amounts cover known products; ``first_return_date``
    covers every returned item."""
    measures = {
        "item_count": distinct("order_item_id", "known"),
        "item_rows": total("if(known AND units IS NOT NULL, copies, 0)"),
        "returned_items": distinct("order_item_id", "known AND returns > 0"),
        "total_units": total("if(known, units, NULL)"),
        "total_amount": total("if(known, gross_amount, NULL)"),
        "total_cost": total("total_cost"),
        "total_gross_profit": total("gross_profit"),
        "total_refund_amount": total("if(known, refund_amount, NULL)"),
        "net_revenue": total("if(known, net_revenue, NULL)"),
        "has_returns": largest("known AND returns > 0"),
        "first_return_date": smallest("first_return_date"),
    }
    return nested_rollup(item_lines(shop), ["order_id"], ["order_item_id"], measures)


ROLLED_UP = (
    "item_count",
    "item_rows",
    "returned_items",
    "total_units",
    "total_amount",
    "total_cost",
    "total_gross_profit",
    "total_refund_amount",
    "net_revenue",
)


def with_line_totals(orders: DataFrame, shop: Shop, p: Params) -> DataFrame:
    """Join the item rollup to staged orders, zero for orders without items. From
    here on ``total_amount`` is the sum of the items, not the order header."""
    margin = "total_gross_profit / double(total_amount) * 100"
    orders = orders.drop("total_amount")
    return (
        orders.join(order_rollup(shop, p), "order_id", "left")
        .selectExpr(
            *orders.columns,
            *[f"ifnull({column}, 0) AS {column}" for column in ROLLED_UP],
            "ifnull(has_returns, false) AS has_returns",
            f"if(total_amount > 0, {margin}, 0d) AS avg_gross_margin_pct",
            "first_return_date",
        )
    )


def order_figures(shop: Shop, p: Params) -> DataFrame:
    """Every order with its item rollup, without its customer's columns."""
    return with_line_totals(stg_orders(shop.orders, unstamped(p)), shop, p)


def orders_with_customers(shop: Shop, p: Params) -> DataFrame:
    """Every order with its customer and its item rollup. The customer is joined first:
    the join on the order then leaves the rows partitioned by order."""
    users = stg_users(shop.users, unstamped(p)).select(
        "user_id", "email", "customer_segment", "country", "region", "signup_date"
    )
    orders = stg_orders(shop.orders, unstamped(p)).join(users, "user_id", "left")
    return with_line_totals(orders, shop, p)


def int_orders_enriched(shop: Shop, p: Params) -> DataFrame:
    out = orders_with_customers(shop, p).select(
        "order_id",
        "user_id",
        "order_date",
        "email",
        "customer_segment",
        "country",
        "region",
        "signup_date",
        "order_status",
        "is_completed",
        "is_cancelled",
        "is_high_value_order",
        "item_count",
        "total_units",
        "total_amount",
        "total_cost",
        "total_gross_profit",
        "total_refund_amount",
        "net_revenue",
        "has_returns",
        "avg_gross_margin_pct",
        "order_month",
        "order_week",
        "day_of_week",
        F.expr("datediff(order_date, signup_date) AS days_since_signup"),
        surrogate_key("order_id", "user_id").alias("order_surrogate_key"),
    )
    return stamp(out, "_loaded_at", p)


def int_customer_orders(shop: Shop, p: Params) -> DataFrame:
    """Orders and items per customer, from one pass over the order rollup."""

    def of_completed(column: str):
        return total(f"if(is_completed, {column}, 0)")

    # Item figures are looked up by customer, so they are zero without one.
    def of_sold(column: str):
        return total(f"if(is_completed AND user_id IS NOT NULL, {column}, 0)")

    per_customer = nested_rollup(
        order_figures(shop, p),
        by=["user_id"],
        nest=["order_id"],
        measures={
            "total_orders": distinct("order_id"),
            "completed_orders": distinct("order_id", "is_completed"),
            "cancelled_orders": distinct("order_id", "is_cancelled"),
            "high_value_orders": distinct("order_id", "is_completed AND is_high_value_order"),
            "total_revenue": of_completed("total_amount"),
            "total_net_revenue": of_completed("net_revenue"),
            "total_gross_profit": of_completed("total_gross_profit"),
            "completed_rows": rows("is_completed"),
            "first_order_date": smallest("if(is_completed, order_date, NULL)"),
            "last_order_date": largest("if(is_completed, order_date, NULL)"),
            "total_items_ordered": of_sold("total_units"),
            "item_rows": of_sold("item_rows"),
            "total_returned_items": of_sold("returned_items"),
            "total_refunds": of_sold("total_refund_amount"),
            "orders_with_returns": distinct(
                "order_id", "is_completed AND user_id IS NOT NULL AND has_returns"
            ),
        },
    )
    return per_customer.selectExpr(
        "user_id",
        "total_orders",
        "completed_orders",
        "cancelled_orders",
        "high_value_orders",
        "total_revenue",
        "total_net_revenue",
        "total_gross_profit",
        "try_divide(double(total_revenue), completed_rows) AS avg_order_value",
        "first_order_date",
        "last_order_date",
        "total_items_ordered",
        "ifnull(try_divide(double(total_items_ordered), item_rows), 0d) AS avg_items_per_order",
        "total_returned_items",
        "total_refunds",
        "orders_with_returns",
    )


def completed_items(shop: Shop, p: Params) -> DataFrame:
    return int_order_items_enriched(shop, unstamped(p)).filter("is_completed")


def sold_lines(shop: Shop) -> DataFrame:
    """Lines of known products in completed orders. The product is joined last: rows that lie
    by product need no shuffle to be grouped by it, and a skewed product is split by the join."""
    orders = shop.orders.filter("status = 'completed'").select("order_id", "user_id", "order_date")
    if shop.lines is not None:
        lines = shop.lines.filter("known").join(orders, "order_id")
    else:
        items = with_returns(packed_ids(shop.order_items, shop), shop).join(orders, "order_id")
        lines = with_costs(items, shop).filter("known")
        lines = lines.selectExpr(*LINE, "user_id", "order_date")
    return with_amounts(lines).withColumn("gross_margin_pct", F.expr(MARGIN))


# Measures of sold lines, common to all rollups by product.
SOLD = {
    "units": total("units"),
    "order_count": distinct("order_id"),
    "unique_customers": distinct("user_id"),
    "gross_revenue": total("gross_amount"),
    "net_revenue": total("net_revenue"),
    "total_cost": total("total_cost"),
    "gross_profit": total("gross_profit"),
    "margin_sum": total("gross_margin_pct * copies"),
    "margin_rows": total("if(gross_margin_pct IS NOT NULL, copies, 0)"),
    "return_count": total("returns"),
    "refund_amount": total("refund_amount"),
}


def int_product_performance(shop: Shop, p: Params) -> DataFrame:
    """Sales, margin and returns per product, completed orders only."""
    sums = nested_rollup(
        sold_lines(shop),
        by=["product_id"],
        nest=["user_id", "order_id"],
        measures={
            **SOLD,
            "price_sum": total("unit_price * copies"),
            "price_rows": total("if(unit_price IS NOT NULL, copies, 0)"),
            "min_selling_price": smallest("unit_price"),
            "max_selling_price": largest("unit_price"),
            "quality_issue_count": total("quality_returns"),
        },
    )
    return sums.selectExpr(
        "product_id",
        "units AS total_units_sold",
        "order_count",
        "unique_customers",
        "gross_revenue AS total_revenue",
        "net_revenue",
        "try_divide(double(price_sum), price_rows) AS avg_selling_price",
        "min_selling_price",
        "max_selling_price",
        "gross_profit AS total_gross_profit",
        "try_divide(margin_sum, margin_rows) AS avg_gross_margin_pct",
        "return_count",
        "refund_amount AS total_refund_amount",
        "quality_issue_count",
        "if(units > 0, return_count / double(units), 0d) AS return_rate",
        "if(return_count > 0, quality_issue_count / double(return_count), 0d)"
        " AS quality_issue_pct",
    )
