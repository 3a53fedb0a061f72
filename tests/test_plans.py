"""The marts on a small shop full of odd rows, against plain joins in SQL."""

import duckdb
import pytest
from compare import rows_of
from conftest import ROWS, day, frames, money, rows
from pyspark.sql import functions as F

import oracle.base
from oracle import STATEMENTS
from orderlens.catalog import plain
from orderlens.operators import quality as dq
from orderlens.plans import analyses, core, enrich, finance, marketing, samples, staging
from orderlens.plans.build import due_for_refresh
from orderlens.sources import SALES_PARAMS as P
from orderlens.sources import Shop

AVERAGES = (
    "avg_gross_margin_pct",
    "avg_order_margin_pct",
    "avg_margin_pct",
    "avg_return_rate_pct",
)

PLANS = {
    "stg_users": lambda s: staging.stg_users(s.users, P),
    "stg_products": lambda s: staging.stg_products(s.products, P),
    "stg_orders": lambda s: staging.stg_orders(s.orders, P),
    "stg_order_items": lambda s: staging.stg_order_items(s.order_items, P),
    "stg_returns": lambda s: staging.stg_returns(s.returns, P),
    "int_order_items_enriched": lambda s: enrich.int_order_items_enriched(s, P),
    "int_orders_enriched": lambda s: enrich.int_orders_enriched(s, P),
    "int_customer_orders": lambda s: enrich.int_customer_orders(s, P),
    "int_product_performance": lambda s: enrich.int_product_performance(s, P),
    "dim_customers": lambda s: core.dim_customers(s, P),
    "fct_order_items": lambda s: core.fct_order_items(s, P),
    "mart_product_performance": lambda s: core.mart_product_performance(s, P),
    "fct_daily_revenue": lambda s: finance.fct_daily_revenue(s, P),
    "fct_product_profitability": lambda s: finance.fct_product_profitability(s, P),
    "fct_customer_cohorts": lambda s: marketing.fct_customer_cohorts(s, P),
    "fct_rfm_analysis": lambda s: marketing.fct_rfm_analysis(s, P),
    "return_analysis": lambda s: analyses.return_analysis(s, P),
    "cohort_retention_matrix": lambda s: analyses.cohort_retention_matrix(s, P),
    "theta_cohort_periods": lambda s: analyses.cohort_periods(s, P),
    "executive_summary": lambda s: analyses.executive_summary(
        core.fct_orders(s, P), core.dim_customers(s, P), core.mart_product_performance(s, P)
    ),
    "weekly_revenue_trend": lambda s: analyses.weekly_revenue_trend(core.fct_orders(s, P)),
    "top_products_by_revenue": lambda s: analyses.top_products_by_revenue(
        core.mart_product_performance(s, P)
    ),
    "customer_segmentation_summary": lambda s: analyses.customer_segmentation_summary(
        marketing.fct_rfm_analysis(s, P)
    ),
    "monthly_trends": lambda s: samples.monthly_trends(core.fct_orders(s, P)),
    "items_revenue_returns": lambda s: samples.items_revenue_returns(core.fct_order_items(s, P)),
}

TABLES = ", ".join(
    f"{name} AS (SELECT * FROM t_{table})"
    for name, table in [
        ("users", "users"),
        ("products", "products"),
        ("heads", "orders"),
        ("items", "order_items"),
        ("rets", "returns"),
    ]
)


@pytest.fixture(scope="module")
def duck(spark):
    con = duckdb.connect()
    for name, df in frames(spark).items():
        con.register(f"t_{name}", df.toArrow())
    return con


@pytest.mark.parametrize("name", PLANS)
def test_plan_equals_plain_joins(shop, duck, name):
    got = plain(PLANS[name](shop), AVERAGES).toPandas()
    sql = STATEMENTS[name].replace(oracle.base.ENTITIES, "\n" + TABLES)
    want = duck.execute(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    for column in AVERAGES:
        if column in got:
            got[column], want[column] = got[column].round(6), want[column].round(6)
    assert rows_of(got) == rows_of(want)


@pytest.mark.parametrize("name", PLANS)
def test_plan_on_empty_tables(empty_shop, name):
    got = PLANS[name](empty_shop)
    assert got.count() == (1 if name == "executive_summary" else 0)


def test_several_returns_multiply_the_line(shop):
    lines = enrich.int_order_items_enriched(shop, P).filter("order_item_id = 'a'")
    assert lines.count() == 3
    order = enrich.int_orders_enriched(shop, P).filter("order_id = 100").first()
    assert (order["item_count"], order["total_units"]) == (2, 3 * 2 + 3)


def test_unknown_products_count_for_returns_only(shop):
    fact = core.fct_orders(shop, P).filter("order_id = 103").first()
    assert fact["total_items"] == 1
    assert fact["days_to_return"] == 1


def test_written_lines_give_the_same_marts(shop):
    shared = enrich.with_written_lines(shop)
    for plan in (core.dim_customers, core.mart_product_performance, core.fct_orders):
        assert rows(plan(shared, P)) == rows(plan(shop, P))


def test_order_figures_are_the_order_facts(shop):
    figures = core.fct_order_figures(shop, P)
    assert rows(figures) == rows(core.fct_orders(shop, P), *figures.columns)


def test_stamps_only_with_a_run_time(shop):
    from dataclasses import replace
    from datetime import datetime

    stamped = replace(P, run_ts=datetime(2001, 8, 2, 12))
    assert "_updated_at" not in core.fct_orders(shop, P).columns
    assert core.fct_orders(shop, stamped).columns[-1] == "_updated_at"
    assert staging.stg_users(shop.users, stamped).columns[-1] == "_loaded_at"
    assert finance.fct_daily_revenue(shop, stamped).first()["_updated_at"] == stamped.run_ts


def test_shop_needs_all_tables(shop):
    with pytest.raises(TypeError):
        Shop(users=shop.users)
    with pytest.raises(AttributeError):
        _ = shop.nothing


def test_metric_rollup(shop):
    from pyspark.sql import functions as F

    out = samples.metric_rollup(
        core.fct_orders(shop, P),
        {"revenue": F.sum("subtotal"), "n": F.count("order_id")},
        "order_date",
        "quarter",
        ["region"],
        {"mean": F.col("revenue") / F.col("n")},
    )
    assert out.columns == ["period", "region", "revenue", "n", "mean"]
    assert out.agg(F.sum("n")).first()[0] == len(ROWS["orders"])


def exchanges(df):
    """Shuffles in a plan without broadcasts."""
    conf, key = df.sparkSession.conf, "spark.sql.autoBroadcastJoinThreshold"
    conf.set(key, "-1")
    try:
        plan = df.filter("true")._jdf.queryExecution().executedPlan().toString()
    finally:
        conf.set(key, "10MB")
    return plan.count("Exchange hashpartitioning")


def test_written_lines_are_rolled_up_without_a_shuffle(shop):
    shared = enrich.with_written_lines(shop)
    assert exchanges(enrich.order_rollup(shared, P)) == 0
    # Only the orders move to join the lines.
    assert exchanges(enrich.sold_lines(shared)) == 1


def test_products_are_summed_where_their_rows_were_joined(shop):
    # Items and returns by item, items and orders by order, items and products by product.
    assert exchanges(enrich.sold_lines(shop)) == 6
    # Only the names' join brings another table.
    assert exchanges(finance.fct_product_profitability(shop, P)) == 7


def test_item_ids_travel_as_bytes(shop):
    assert dict(enrich.joined_lines(shop).dtypes)["order_item_id"] == "binary"
    items = enrich.packed_ids(shop.order_items, shop)
    assert rows(enrich.unpacked_ids(items, shop)) == rows(shop.order_items)
    numbered = shop.replace(
        order_items=shop.order_items.withColumn("order_item_id", F.ascii("order_item_id")),
        returns=shop.returns.withColumn("order_item_id", F.ascii("order_item_id")),
    )
    assert dict(enrich.joined_lines(numbered).dtypes)["order_item_id"] == "int"
    assert rows(enrich.order_rollup(numbered, P)) == rows(enrich.order_rollup(shop, P))


def test_due_returns_are_not_looked_up_by_their_items(shop):
    newest = F.lit(day(4, 3))
    due = due_for_refresh(shop, newest, 3)
    # Orders and items by order, items and returns by item; products by product; sums by order.
    assert exchanges(due.returns) == 0
    got = core.fct_order_figures(due, P)
    want = core.fct_order_figures(shop, P).filter(F.col("order_date") >= day(3, 31))
    assert rows(got) == rows(want)


@pytest.fixture(scope="module")
def odd_shop(spark):
    """Products, items, orders and returns that come twice, and keys that are NULL."""
    more = {
        "products": [
            (10, "ring", "STANDARD", 1, money("100.00")),
            (10, "bracelet", "MEDIUM", 2, money("7.00")),
            (10, None, None, None, None),
            (None, "lost", "LARGE", 3, money("5.00")),
            (None, "lost", "LARGE", 3, money("6.00")),
        ],
        "orders": [(101, 2, day(3, 2), "completed", money("11.00")), (None, 1, day(3, 2), "completed", money("1.00"))],
        "order_items": [
            ("a", 100, 10, 2, money("150.00")),
            ("a", 103, 11, 1, money("3.00")),
            ("k", 109, None, 2, money("4.00")),
            (None, 100, 10, 1, money("5.00")),
            ("m", None, 12, 1, money("6.00")),
            ("abcd", 100, 999, 1, money("5.00")),
        ],
        "returns": [
            ("r1", "a", day(3, 20), "defective", money("150.00")),
            (None, "a", None, None, None),
            ("r11", None, day(3, 20), "defective", money("1.00")),
            ("r12", "abcd", day(3, 20), "defective", money("1.00")),
        ],
    }
    return Shop(**frames(spark, {name: ROWS[name] + more.get(name, []) for name in ROWS}))


@pytest.fixture(scope="module")
def odd_items(odd_shop):
    return enrich.with_written_items(odd_shop)


@pytest.mark.parametrize("table", ["orders", "order_items", "returns"])
def test_written_items_keep_the_rows(odd_shop, odd_items, table):
    assert getattr(odd_items, table).schema == getattr(odd_shop, table).schema
    assert rows(getattr(odd_items, table)) == rows(getattr(odd_shop, table))


def test_written_items_have_all_of_a_line(odd_shop, odd_items):
    plain_lines = enrich.joined_lines(odd_shop)
    assert rows(odd_items.lines, *plain_lines.columns) == rows(plain_lines)


@pytest.mark.parametrize(
    "name",
    ["int_order_items_enriched", "fct_order_items", "int_orders_enriched", "int_customer_orders",
     "int_product_performance", "fct_product_profitability", "fct_customer_cohorts"],
)
def test_plans_on_written_items(odd_shop, odd_items, name):
    ours, plain_rows = PLANS[name](odd_items), PLANS[name](odd_shop)
    assert ours.dtypes == plain_rows.dtypes
    assert rows_of(plain(ours, AVERAGES).toPandas()) == rows_of(plain(plain_rows, AVERAGES).toPandas())


def test_checked_columns_of_item_facts_need_no_shuffle(spark, odd_items):
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        for build in (enrich.int_order_items_enriched, core.fct_order_items):
            ids = build(odd_items, P).select("order_item_id", "order_id", "product_id", "quantity")
            plan = ids._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and "returns" not in plan
    finally:
        spark.conf.set(limit, before)


def test_refunds_are_compared_by_packed_ids(odd_shop):
    """Any text is an id; the failing rows have it as it was."""
    returns, items = staging.stg_returns(odd_shop.returns, P), staging.stg_order_items(odd_shop.order_items, P)
    found = dq.refund_above_limit(returns, items, "0.1")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "unhex" in plan
    joined = returns.join(items, "order_item_id").filter("refund_amount > line_total * 0.1")
    columns = ["return_id", "order_item_id", "refund_amount"]
    assert rows(found, *columns) == rows(joined, *columns) != []
    assert dict(found.dtypes)["order_item_id"] == "string"
