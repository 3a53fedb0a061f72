"""Reports on top of the marts. Each builder takes mart DataFrames, so a caller may
pass marts that were written before instead of building them again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderlens.functions import (
    date_diff,
    date_trunc,
    money_avg,
    pct_change,
    ratio,
    retention_health,
    round_to,
)
from orderlens.operators.rollup import (
    distinct,
    largest,
    nested_rollup,
    one_row,
    rows,
    smallest,
    total,
)
from orderlens.operators.windows import first_of, previous, running_total
from orderlens.params import Params
from orderlens.plans.enrich import unstamped
from orderlens.plans.marketing import cohort_orders, cohort_sizes, signup_cohorts
from orderlens.plans.staging import (
    stg_order_items,
    stg_orders,
    stg_products,
    stg_returns,
    stg_users,
)
from orderlens.sources.scratch import written
from orderlens.sources.tables import Shop


def executive_summary(orders: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """One row of headline figures from the order, customer and product marts."""
    c = F.col
    order_kpis = nested_rollup(
        orders,
        by=[],
        nest=["user_id", "order_id"],
        measures={
            "total_orders": distinct("order_id"),
            "ordering_customers": distinct("user_id"),
            "gross_revenue": total("subtotal"),
            "net_revenue": total("net_revenue"),
            "gross_profit": total("gross_profit"),
            "order_rows": rows(),
            "orders_with_returns": rows("is_returned"),
            "period_start": smallest("order_date"),
            "period_end": largest("order_date"),
        },
    )
    customer_kpis = customers.agg(
        F.count("customer_id").alias("total_customers"),
        F.count_if("is_repeat_customer").alias("repeat_customers"),
        money_avg(F.sum("total_revenue"), F.count("total_revenue")).alias("ltv"),
    )
    product_kpis = products.filter(c("total_revenue") > 0).agg(
        F.count("product_id").alias("active_products"),
        F.avg("return_rate").alias("return_rate"),
    )
    return one_row(orders.sparkSession, order_kpis, customer_kpis, product_kpis).select(
        "period_start",
        "period_end",
        "total_orders",
        "ordering_customers",
        "gross_revenue",
        "net_revenue",
        "gross_profit",
        round_to(money_avg(c("gross_revenue"), c("order_rows")), 2).alias("avg_order_value"),
        round_to(ratio(c("gross_profit"), c("gross_revenue")) * 100, 2).alias("gross_margin_pct"),
        "total_customers",
        "repeat_customers",
        round_to(ratio(c("repeat_customers"), c("total_customers")) * 100, 2).alias(
            "repeat_rate_pct"
        ),
        round_to(c("ltv"), 2).alias("avg_customer_ltv"),
        "active_products",
        round_to(c("return_rate") * 100, 2).alias("avg_return_rate_pct"),
        "orders_with_returns",
        round_to(ratio(c("orders_with_returns"), c("total_orders")) * 100, 2).alias(
            "order_return_rate_pct"
        ),
    )


def customer_segmentation_summary(rfm: DataFrame) -> DataFrame:
    """Size, averages and shares of each RFM segment."""
    c = F.col
    groups = rfm.groupBy("rfm_customer_segment", "recommended_action").agg(
        F.count(F.lit(1)).alias("customer_count"),
        F.sum("recency_days").alias("_recency"),
        F.sum("frequency").alias("_orders"),
        F.sum("monetary").alias("_revenue"),
    )
    # One row per segment and action: at most nine names times eight actions. Used twice.
    groups = written(groups, "segments")
    whole = groups.agg(
        F.sum("customer_count").alias("_all_customers"),
        F.sum("_revenue").alias("_all_revenue"),
    )
    whole = whole.select(F.struct("_all_customers", "_all_revenue")).scalar()
    count = c("customer_count")
    return groups.withColumn("_all", whole).select(
        "rfm_customer_segment",
        "customer_count",
        round_to(ratio(count, c("_all._all_customers")) * 100, 2).alias("pct_of_customers"),
        round_to(ratio(c("_recency"), count), 0).alias("avg_recency_days"),
        round_to(ratio(c("_orders"), count), 1).alias("avg_orders"),
        round_to(ratio(c("_revenue"), count), 2).alias("avg_revenue"),
        F.round("_revenue", 2).alias("total_revenue"),
        round_to(ratio(c("_revenue"), c("_all._all_revenue")) * 100, 2).alias("pct_of_revenue"),
        "recommended_action",
    ).orderBy(F.desc("total_revenue"), "rfm_customer_segment", "recommended_action")


def top_products_by_revenue(products: DataFrame, limit: int = 20) -> DataFrame:
    """Best sellers with their place by revenue, by profit, and in their category."""
    c = F.col
    sold = products.filter(c("total_revenue") > 0).select(
        "product_id",
        "product_name",
        "category",
        "category_group",
        "total_orders",
        "total_quantity_sold",
        "unique_customers",
        "total_revenue",
        "net_revenue",
        "gross_profit",
        round_to(c("profit_margin") * 100, 2).alias("profit_margin_pct"),
        "performance_tier",
        round_to(c("return_rate") * 100, 2).alias("return_rate_pct"),
        "total_returns",
    )
    # The products are worked out once, for the best sellers and for what is ahead of them.
    sold = written(sold, "sold")
    best = sold.orderBy(F.desc("net_revenue"), "product_id").limit(limit)
    kinds = {f.name: f.dataType for f in sold.schema.fields}
    thresholds = best.select("product_id", "gross_profit").collect()
    places = []
    for r in thresholds:
        profit = F.lit(r["gross_profit"]).cast(kinds["gross_profit"])
        number = F.lit(r["product_id"]).cast(kinds["product_id"])
        ahead = (c("gross_profit") > profit) | (
            (c("gross_profit") == profit) & (c("product_id") < number)
        )
        places.append(F.struct(number.alias("product_id"),
                               (F.count_if(ahead) + 1).alias("profit_rank")))
    none = F.array().cast("array<struct<product_id:bigint,profit_rank:bigint>>")
    ranked = sold.agg((F.array(*places) if places else none).alias("places")).select(
        F.inline("places")
    )
    best = best.join(ranked, "product_id")
    # Whatever precedes one of the best sellers by revenue, in all or in its category,
    # is itself a best seller: these two places need only the limited rows.
    by_revenue = [F.desc("net_revenue"), F.asc("product_id")]
    return best.withColumns(
        {
            "revenue_rank": F.row_number().over(W.orderBy(*by_revenue)).cast("bigint"),
            "category_revenue_rank": F.row_number()
            .over(W.partitionBy("category").orderBy(*by_revenue))
            .cast("bigint"),
        }
    ).orderBy("revenue_rank")


def weekly_revenue_trend(orders: DataFrame) -> DataFrame:
    """Revenue per week with growth against the previous week that had orders."""
    c = F.col
    weekly = nested_rollup(
        orders.withColumn("week_start", date_trunc("week", c("order_date"))),
        by=["week_start"],
        nest=["user_id", "order_id"],
        measures={
            "orders": distinct("order_id"),
            "customers": distinct("user_id"),
            "gross_revenue": total("subtotal"),
            "net_revenue": total("net_revenue"),
            "n_rows": rows(),
        },
    )
    before = previous(c("net_revenue"), "week_start"), previous(c("orders"), "week_start")
    return weekly.select(
        "week_start",
        "orders",
        "customers",
        F.round("gross_revenue", 2).alias("gross_revenue"),
        F.round("net_revenue", 2).alias("net_revenue"),
        round_to(money_avg(c("gross_revenue"), c("n_rows")), 2).alias("avg_order_value"),
        round_to(pct_change(c("net_revenue"), before[0]), 2).alias("revenue_wow_growth_pct"),
        round_to(pct_change(c("orders"), before[1]), 2).alias("orders_wow_growth_pct"),
        F.round(running_total(c("net_revenue"), "week_start"), 2).alias("cumulative_revenue"),
    ).orderBy("week_start")


def return_analysis(shop: Shop, p: Params) -> DataFrame:
    """Returns by reason, category, customer segment, and quality issues by supplier.

    All four reports come from one pass: returns are added up per item and reason
    before any join, and each sum contributes one row per report. An item with n
    returns counts each of them n times, as the join of returns with item lines (one
    line per return) does.
    """
    p = unstamped(p)
    c = F.col
    per_item = (
        stg_returns(shop.returns, p)
        .groupBy("order_item_id", "return_reason", "is_quality_issue")
        .agg(F.count(F.lit(1)).alias("_returns"), F.sum("refund_amount").alias("_refunds"))
        .withColumn("_copies", F.sum("_returns").over(W.partitionBy("order_item_id")))
    )
    items = stg_order_items(shop.order_items, p).select("order_item_id", "order_id", "product_id")
    products = stg_products(shop.products, p).select("product_id", "category", "supplier_id")
    orders = stg_orders(shop.orders, p).select("order_id", "user_id")
    users = stg_users(shop.users, p).select("user_id", "customer_segment")
    detail = (
        items.join(per_item, "order_item_id")
        .join(products, "product_id")
        .join(orders, "order_id")
        .join(users, "user_id", "left")
    )

    def entry(report: str, dimension):
        return F.struct(
            F.lit(report).alias("analysis_type"), dimension.cast("string").alias("dimension")
        )

    reports = F.array(
        entry("By Reason", c("return_reason")),
        entry("By Category", c("category")),
        entry("By Customer Segment", c("customer_segment")),
        F.when(c("is_quality_issue"), entry("Quality Issues by Supplier", c("supplier_id"))),
    )
    return (
        detail.select(
            F.explode(F.array_compact(reports)).alias("_report"),
            (c("_returns") * c("_copies")).alias("_n"),
            (c("_refunds") * c("_copies")).alias("_amount"),
        )
        .groupBy("_report.analysis_type", "_report.dimension")
        .agg(F.sum("_n").alias("return_count"), F.sum("_amount").alias("total_refunds"))
        .withColumn("avg_refund", round_to(money_avg(c("total_refunds"), c("return_count")), 2))
        .orderBy("analysis_type", F.desc("return_count"), "dimension")
    )


def cohort_periods(shop: Shop, p: Params) -> DataFrame:
    """Every (signup month, order month) pair with the order month not before the
    signup month: months are listed up to the last order month and matched by value."""
    c = F.col
    months = (
        shop.orders.select(date_trunc("month", c("order_date")).alias("period_month"))
        .distinct()
        .filter(c("period_month").isNotNull())
    )
    cohorts = signup_cohorts(shop, p).select("cohort_month").distinct()
    last = months.agg(F.max("period_month")).scalar()
    upto = "if(cohort_month <= _last, sequence(cohort_month, _last, INTERVAL 1 MONTH), NULL)"
    listed = cohorts.withColumn("_last", last).select(
        "cohort_month", F.explode(F.expr(upto)).alias("period_month")
    )
    return listed.join(months, "period_month").select(
        "cohort_month",
        "period_month",
        date_diff(c("cohort_month"), c("period_month"), "month")
        .cast("bigint")
        .alias("months_since_signup"),
    )


def cohort_retention_matrix(shop: Shop, p: Params) -> DataFrame:
    """Retention per signup cohort and month of activity, completed orders only.

    Pairs without activity are not shown, so the pairs need not be listed: grouping
    the orders gives exactly those with activity.
    """
    c = F.col
    orders = cohort_orders(shop, p).filter(
        c("is_completed") & (c("order_month") >= c("cohort_month"))
    )
    activity = nested_rollup(
        orders,
        by=["cohort_month", "order_month"],
        nest=["user_id", "order_id"],
        measures={
            "active_customers": distinct("user_id"),
            "total_orders": distinct("order_id"),
            "period_revenue": total("total_amount"),
        },
    )
    age = date_diff(c("cohort_month"), c("order_month"), "month").cast("bigint")
    cell = activity.join(cohort_sizes(signup_cohorts(shop, p)), "cohort_month").withColumn(
        "period", age
    )
    by = ("period", ["cohort_month"])
    revenue, size, active = c("period_revenue"), c("cohort_size"), c("active_customers")
    cell = cell.withColumns(
        {
            "retention_rate_pct": round_to(ratio(active, size) * 100, 2),
            "_so_far": running_total(revenue, *by),
            "churn_indicator": active - previous(active, *by),
            "_first": first_of(revenue, *by),
        }
    )
    return cell.orderBy("cohort_month", "period").select(
        F.date_format("cohort_month", "yyyy-MM").alias("cohort_label"),
        "cohort_size",
        "period",
        "active_customers",
        "retention_rate_pct",
        "total_orders",
        round_to(ratio(c("total_orders"), active), 2).alias("orders_per_active_customer"),
        "period_revenue",
        round_to(ratio(revenue, c("total_orders")), 2).alias("avg_order_value"),
        round_to(ratio(c("_so_far"), size), 2).alias("cumulative_ltv_per_customer"),
        "churn_indicator",
        round_to(ratio(revenue, c("_first")) * 100, 2).alias("revenue_retention_pct"),
        retention_health(c("period"), c("retention_rate_pct")).alias("retention_health"),
    )

