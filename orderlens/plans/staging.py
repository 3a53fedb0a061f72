"""Row-level cleaning of the raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions import email_domain, map_values
from orderlens.params import QUALITY_REASONS, REASON_CATEGORIES, Params


def stamp(df: DataFrame, name: str, p: Params) -> DataFrame:
    """Add the run's time stamp when the run has one."""
    return df if p.run_ts is None else df.withColumn(name, F.lit(p.run_ts))


def stg_users(users: DataFrame, p: Params) -> DataFrame:
    out = users.select(
        "user_id",
        "email",
        email_domain(F.col("email")).alias("email_domain"),
        "signup_date",
        "country",
        map_values(F.col(p.region_source), p.regions).alias("region"),
        "customer_segment",
    )
    return stamp(out, "_loaded_at", p)


def stg_products(products: DataFrame, p: Params) -> DataFrame:
    out = products.select(
        "product_id",
        "product_name",
        "category",
        "supplier_id",
        F.col("cost").alias("unit_cost"),
        map_values(F.col("category"), p.category_groups).alias("category_group"),
    )
    return stamp(out, "_loaded_at", p)


def stg_orders(orders: DataFrame, p: Params) -> DataFrame:
    """Flags are false, not NULL, for a NULL status or amount."""
    out = orders.selectExpr(
        "order_id",
        "user_id",
        "order_date",
        "status AS order_status",
        "total_amount",
        "ifnull(status = 'completed', false) AS is_completed",
        "ifnull(status = 'cancelled', false) AS is_cancelled",
        f"ifnull(total_amount >= {p.high_value_order}, false) AS is_high_value_order",
        "trunc(order_date, 'month') AS order_month",
        "trunc(order_date, 'week') AS order_week",
        "dayofweek(order_date) - 1 AS day_of_week",
    )
    return stamp(out, "_loaded_at", p)


def stg_order_items(order_items: DataFrame, p: Params) -> DataFrame:
    out = order_items.selectExpr(
        "order_item_id",
        "order_id",
        "product_id",
        "quantity",
        "price AS unit_price",
        "quantity * price AS line_total",
    )
    return stamp(out, "_loaded_at", p)


def stg_returns(returns: DataFrame, p: Params) -> DataFrame:
    quality = ", ".join(f"'{r}'" for r in QUALITY_REASONS)
    out = returns.select(
        "return_id",
        "order_item_id",
        "return_date",
        "return_reason",
        "refund_amount",
        map_values(F.col("return_reason"), REASON_CATEGORIES).alias("return_reason_category"),
        F.expr(f"ifnull(return_reason IN ({quality}), false) AS is_quality_issue"),
        F.expr("trunc(return_date, 'month') AS return_month"),
    )
    return stamp(out, "_loaded_at", p)
