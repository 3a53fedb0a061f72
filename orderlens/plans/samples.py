"""Documented example queries on the marts, and the metric rollup."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions import date_trunc, money_avg
from orderlens.operators.ranking import row_number
from orderlens.operators.rollup import distinct, nested_rollup, rows, total


def customers_by_value(customers: DataFrame, segment: str, limit: int = 10) -> DataFrame:
    """Best customers of one segment by revenue."""
    return (
        customers.filter(F.col("customer_segment") == segment)
        .select(
            "customer_id",
            "email",
            "customer_segment",
            "total_orders",
            "total_revenue",
            "avg_order_value",
            "first_order_date",
            "last_order_date",
            "days_since_last_order",
        )
        .orderBy(F.desc("total_revenue"), "customer_id")
        .limit(limit)
    )


def high_return_products(products: DataFrame, min_rate: float = 0.10) -> DataFrame:
    return (
        products.filter(F.col("return_rate") > min_rate)
        .select(
            "product_id",
            "product_name",
            "category",
            "total_quantity_sold",
            "total_revenue",
            "total_returns",
            "return_rate",
            "gross_profit",
            "profit_margin",
        )
        .orderBy(F.desc("return_rate"), "product_id")
    )


def latest_returned_orders(orders: DataFrame, limit: int = 5) -> DataFrame:
    return (
        orders.filter("is_returned")
        .select(
            "order_id",
            "order_date",
            "customer_email",
            "customer_segment",
            "order_status",
            "total_items",
            "total_quantity",
            "subtotal",
            "is_returned",
            "days_to_return",
        )
        .orderBy(F.desc("order_date"), "order_id")
        .limit(limit)
    )


def monthly_trends(orders: DataFrame) -> DataFrame:
    """Completed orders, customers and revenue per month."""
    completed = orders.filter(F.col("order_status") == "completed")
    sums = nested_rollup(
        completed.withColumn("order_month", date_trunc("month", F.col("order_date"))),
        by=["order_month"],
        nest=["user_id", "order_id"],
        measures={
            "total_orders": distinct("order_id"),
            "unique_customers": distinct("user_id"),
            "total_revenue": total("subtotal"),
            "n_rows": rows(),
        },
    )
    mean = money_avg(F.col("total_revenue"), F.col("n_rows"))
    return sums.withColumn("avg_order_value", mean).drop("n_rows").orderBy("order_month")


def items_revenue_returns(items: DataFrame) -> DataFrame:
    """Revenue and number of returned lines per product and category."""
    return (
        items.groupBy("product_name", "category")
        .agg(F.sum("gross_amount").alias("revenue"), F.count_if("is_returned").alias("returns"))
        .orderBy(F.desc("revenue"), "product_name", "category")
    )


def daily_recent(daily: DataFrame, limit: int = 30) -> DataFrame:
    return (
        daily.select("date_id", "net_revenue", "cumulative_revenue", "revenue_7day_avg")
        .orderBy(F.desc("date_id"))
        .limit(limit)
    )


def category_rank_by_units(items: DataFrame) -> DataFrame:
    """Products ranked by units sold within their category."""
    sold = items.groupBy("product_id", "category").agg(F.sum("quantity").alias("total_sold"))
    order = [F.desc("total_sold"), F.asc("product_id")]
    return row_number(sold, order, ["category"], out="category_rank")


def metric_rollup(
    df: DataFrame,
    measures: Mapping[str, Column],
    time_col: str,
    grain: str,
    dims: Sequence[str] = (),
    derived: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Aggregate ``measures`` per period and dimension, then add the ``derived``
    metrics, which are expressions over the measures."""
    period = date_trunc(grain, F.col(time_col)).alias("period")
    out = df.groupBy(period, *dims).agg(*[m.alias(name) for name, m in measures.items()])
    for name, expression in (derived or {}).items():
        out = out.withColumn(name, expression)
    return out
