"""Core marts: customers, dates, orders, order items, products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions import (
    activity_status,
    customer_tier,
    date_trunc,
    day_of_week,
    performance_tier,
    period_end,
    year_quarter,
)
from orderlens.params import Params
from orderlens.plans.enrich import (
    completed_items,
    int_customer_orders,
    int_product_performance,
    order_figures,
    orders_with_customers,
    unstamped,
)
from orderlens.plans.staging import stamp, stg_products, stg_users
from orderlens.sources.tables import Shop


def or_zero(source: str, name: str | None = None) -> Column:
    return F.expr(f"ifnull({source}, 0) AS {name or source}")


def dim_customers(shop: Shop, p: Params) -> DataFrame:
    """One row per customer, also for customers without orders."""
    users = stg_users(shop.users, unstamped(p))
    history = int_customer_orders(shop, p).withColumnRenamed("total_orders", "lifetime_orders")
    c = F.col
    out = users.join(history, "user_id", "left").select(
        c("user_id").alias("customer_id"),
        "email",
        "customer_segment",
        "country",
        "region",
        "signup_date",
        or_zero("completed_orders", "total_orders"),
        or_zero("total_revenue"),
        or_zero("avg_order_value"),
        "first_order_date",
        "last_order_date",
        F.expr(f"datediff(DATE '{p.as_of}', last_order_date) AS days_since_last_order"),
        or_zero("lifetime_orders"),
        or_zero("cancelled_orders"),
        or_zero("high_value_orders"),
        or_zero("total_net_revenue"),
        or_zero("total_gross_profit"),
        or_zero("avg_items_per_order"),
        or_zero("total_returned_items"),
        or_zero("total_refunds"),
        or_zero("orders_with_returns"),
        customer_tier(c("total_revenue"), c("completed_orders"), p).alias("customer_tier"),
        activity_status(c("first_order_date"), c("last_order_date"), p).alias("activity_status"),
        F.expr(f"datediff(DATE '{p.as_of}', signup_date) AS days_as_customer"),
        F.expr("ifnull(completed_orders > 1, false) AS is_repeat_customer"),
    )
    return stamp(out, "_updated_at", p)


def dim_date(spine: DataFrame, p: Params, date_col: str = "date_day") -> DataFrame:
    """Calendar attributes for each date of a spine."""
    day, as_of = F.col(date_col), F.lit(p.as_of)

    def number(value):
        return value.cast("bigint")

    dow = day_of_week(day)
    return spine.select(
        day.alias("date_id"),
        number(F.year(day)).alias("year"),
        number(F.month(day)).alias("month"),
        number(F.dayofmonth(day)).alias("day"),
        number(F.quarter(day)).alias("quarter"),
        number(F.weekofyear(day)).alias("week_of_year"),
        number(dow).alias("day_of_week"),
        number(F.dayofyear(day)).alias("day_of_year"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "MMM").alias("month_short"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "EEE").alias("day_short"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        year_quarter(day).alias("year_quarter"),
        date_trunc("week", day).alias("week_start_date"),
        period_end("week", day).alias("week_end_date"),
        date_trunc("month", day).alias("month_start_date"),
        period_end("month", day).alias("month_end_date"),
        date_trunc("quarter", day).alias("quarter_start_date"),
        period_end("quarter", day).alias("quarter_end_date"),
        dow.isin(0, 6).alias("is_weekend"),
        dow.between(1, 5).alias("is_weekday"),
        (day == as_of).alias("is_today"),
        (day == F.date_sub(as_of, 1)).alias("is_yesterday"),
        day.between(date_trunc("month", as_of), as_of).alias("is_current_month"),
        day.between(date_trunc("quarter", as_of), as_of).alias("is_current_quarter"),
    )


FACT_FIGURES = (
    "order_id",
    "user_id",
    "order_date",
    "order_status",
    "is_completed",
    "is_cancelled",
    "item_count AS total_items",
    "total_units AS total_quantity",
    "total_amount AS subtotal",
    "has_returns AS is_returned",
    "datediff(first_return_date, order_date) AS days_to_return",
    "total_refund_amount AS refund_amount",
    "net_revenue",
    "total_gross_profit AS gross_profit",
    "avg_gross_margin_pct",
    "is_high_value_order",
    "item_count > 1 AS is_multi_item_order",
    "order_month",
    "order_week",
    "day_of_week",
)


def fct_orders(shop: Shop, p: Params) -> DataFrame:
    """One row per order of any status, with its items, returns and customer."""
    out = orders_with_customers(shop, p).selectExpr(
        *FACT_FIGURES[:3],
        "email AS customer_email",
        "customer_segment",
        "country",
        "region",
        *FACT_FIGURES[3:],
        "datediff(order_date, signup_date) AS days_since_signup",
    )
    return stamp(out, "_updated_at", p)


def fct_order_figures(shop: Shop, p: Params) -> DataFrame:
    """The order facts that do not need the customer: no join on the customer."""
    return order_figures(shop, p).selectExpr(*FACT_FIGURES)


def fct_order_items(shop: Shop, p: Params) -> DataFrame:
    """One row per item of a completed order."""
    out = completed_items(shop, p).select(
        "order_item_id",
        "order_id",
        "product_id",
        F.col("user_id").alias("customer_id"),
        F.col("order_date").alias("order_date_id"),
        "product_name",
        "category",
        "category_group",
        "supplier_id",
        "quantity",
        "unit_price",
        "unit_cost",
        "gross_amount",
        "gross_profit",
        "gross_margin_pct",
        "is_returned",
        "return_id",
        "return_date",
        "return_reason",
        "return_reason_category",
        "refund_amount",
        "is_quality_issue",
        "net_revenue",
        "order_status",
        "is_completed",
        date_trunc("month", F.col("order_date")).alias("order_month"),
    )
    return stamp(out, "_updated_at", p)


def mart_product_performance(shop: Shop, p: Params) -> DataFrame:
    """One row per product, also for products without sales."""
    products = stg_products(shop.products, unstamped(p))
    sales = int_product_performance(shop, p).drop("return_rate", "avg_gross_margin_pct")

    def rate_if_positive(top: str, bottom: str, name: str) -> Column:
        return F.expr(f"ifnull(if({bottom} > 0, {top} / double({bottom}), 0d), 0d) AS {name}")

    c = F.col
    out = products.join(sales, "product_id", "left").select(
        "product_id",
        "product_name",
        "category",
        "category_group",
        "supplier_id",
        "unit_cost",
        or_zero("total_units_sold", "total_quantity_sold"),
        or_zero("total_revenue"),
        or_zero("order_count", "total_orders"),
        or_zero("unique_customers"),
        or_zero("return_count", "total_returns"),
        rate_if_positive("return_count", "total_units_sold", "return_rate"),
        or_zero("total_gross_profit", "gross_profit"),
        rate_if_positive("total_gross_profit", "total_revenue", "profit_margin"),
        or_zero("avg_selling_price"),
        or_zero("min_selling_price"),
        or_zero("max_selling_price"),
        or_zero("net_revenue"),
        or_zero("total_refund_amount"),
        or_zero("quality_issue_count", "quality_issue_returns"),
        or_zero("quality_issue_pct"),
        performance_tier(
            c("total_revenue"), c("return_count"), c("total_units_sold"), p
        ).alias("performance_tier"),
    )
    return stamp(out, "_updated_at", p)
