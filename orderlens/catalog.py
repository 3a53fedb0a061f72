"""Every query by name, as ``(spark, folder) -> DataFrame`` on the sales tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from orderlens import functions as fn
from orderlens.operators import quality as dq
from orderlens.operators.calendar import spine_of
from orderlens.operators.history import join_as_of, scd2_apply, scd2_as_of
from orderlens.operators.incremental import incremental_merge, upsert
from orderlens.operators.ranking import Rank, with_ranks
from orderlens.operators.rollup import distinct, nested_rollup
from orderlens.operators.windows import (
    first_of,
    moving_average,
    over_rows,
    previous,
    running_total,
)
from orderlens.params import REASON_CATEGORIES
from orderlens.plans import analyses, core, enrich, finance, marketing, samples, staging
from orderlens.plans.build import due_for_refresh
from orderlens.plans.checks import EMAIL_REGEX, all_checks, check_columns, staging_checks
from orderlens.session import folder_bytes, tune
from orderlens.sources.commerce import SALES_PARAMS as P
from orderlens.sources.commerce import SALES_SCHEMAS
from orderlens.sources.commerce import orders_from, shop_from_sales_tables
from orderlens.sources.scratch import run_folder, written
from orderlens.sources.tables import TABLES, Shop, latest_version, stream_table, write_bucketed
from orderlens.streaming.jobs import stream_daily, stream_upsert

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AVERAGE_DIGITS = 6


def plain(df: DataFrame, averages: Sequence[str] = ()) -> DataFrame:
    """Decimals as double; means of doubles, whose last digits depend on the order of
    the rows, rounded."""
    out = []
    for f in df.schema.fields:
        value = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DecimalType):
            value = value.cast("double")
        if f.name in averages:
            value = fn.round_to(value, AVERAGE_DIGITS)
        out.append(value.alias(f.name))
    return df.select(*out)


# A byte of these files is about 12 bytes of sorted rows, and a join holds two sorted inputs.
# Shuffles sized for the rows, not for the files, don't spill.
ROWS_PER_FILE_BYTE = 32

# Sizes of the folders that a session has used, and the one it is set up for.
_SIZES: dict[tuple[str, str], int] = {}
_TUNED: dict[str, str] = {}


def _tuned(spark: SparkSession, folder: str) -> None:
    """Set the session up for the tables in ``folder``, whenever the folder changes."""
    app = spark.sparkContext.applicationId
    if (app, folder) not in _SIZES:
        _SIZES[app, folder] = folder_bytes(spark, folder, SALES_SCHEMAS)
    if _TUNED.get(app) != folder:
        tune(spark, ROWS_PER_FILE_BYTE * _SIZES[app, folder])
        _TUNED[app] = folder


def query(name: str, averages: Sequence[str] = ()):
    """Register ``shop -> DataFrame`` under ``name``."""

    def register(build: Callable[[Shop], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            _tuned(spark, folder)
            return plain(build(shop_from_sales_tables(spark, folder)), averages)

        QUERIES[name] = run
        return build

    return register


def table_query(name: str):
    """Register ``(read, folder) -> DataFrame`` on the unmapped tables."""

    def register(build):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            _tuned(spark, folder)
            return plain(build(lambda t: spark.read.parquet(f"{folder}/{t}.parquet"), folder))

        QUERIES[name] = run
        return build

    return register


c = F.col

# ---- staging, intermediate, marts ----

query("stg_users")(lambda s: staging.stg_users(s.users, P))
query("stg_products")(lambda s: staging.stg_products(s.products, P))
query("stg_orders")(lambda s: staging.stg_orders(s.orders, P))
query("stg_order_items")(lambda s: staging.stg_order_items(s.order_items, P))
query("stg_returns")(lambda s: staging.stg_returns(s.returns, P))

query("int_order_items_enriched")(lambda s: enrich.int_order_items_enriched(s, P))
query("int_orders_enriched")(lambda s: enrich.int_orders_enriched(s, P))
query("int_customer_orders")(lambda s: enrich.int_customer_orders(s, P))
query("int_product_performance", ["avg_gross_margin_pct"])(
    lambda s: enrich.int_product_performance(s, P)
)

query("dim_customers")(lambda s: core.dim_customers(s, P))
query("dim_date")(lambda s: core.dim_date(spine_of(s.orders, "order_date"), P))
query("fct_orders")(lambda s: core.fct_orders(s, P))
query("fct_order_items")(lambda s: core.fct_order_items(s, P))
query("mart_product_performance")(lambda s: core.mart_product_performance(s, P))
query("fct_daily_revenue", ["avg_order_margin_pct"])(lambda s: finance.fct_daily_revenue(s, P))
query("fct_product_profitability", ["avg_margin_pct"])(
    lambda s: finance.fct_product_profitability(s, P)
)
query("fct_customer_cohorts")(lambda s: marketing.fct_customer_cohorts(s, P))
query("fct_customer_segments", ["avg_order_value", "avg_margin_pct", "avg_return_rate_pct"])(
    lambda s: marketing.fct_customer_segments(s, P)
)
query("fct_rfm_analysis")(lambda s: marketing.fct_rfm_analysis(s, P))

# ---- filters, joins, aggregations ----


@query("filter_completed")
def _(s: Shop):
    orders = staging.stg_orders(s.orders, P)
    return orders.filter("is_completed").select("order_id", "user_id", "order_date", "total_amount")


@query("join_items_orders_products")
def _(s: Shop):
    items = staging.stg_order_items(s.order_items, P)
    orders = staging.stg_orders(s.orders, P).select("order_id", "user_id", "order_date")
    products = staging.stg_products(s.products, P).select("product_id", "category", "unit_cost")
    return items.join(orders, "order_id").join(products, "product_id")


@query("join_items_returns")
def _(s: Shop):
    items = staging.stg_order_items(s.order_items, P)
    returns = staging.stg_returns(s.returns, P)
    return items.join(returns, "order_item_id", "left").select(
        "order_item_id",
        "line_total",
        "return_id",
        "return_reason",
        fn.zero_if_null(c("refund_amount")).alias("refund_amount"),
        "is_quality_issue",
    )


query("theta_cohort_periods")(lambda s: analyses.cohort_periods(s, P))


@query("anti_orphans")
def _(s: Shop):
    """Orders of customers outside a region, and items of cancelled orders: both are
    rows without a partner in the kept part of the other table."""
    users = staging.stg_users(s.users, P).filter("region <> 'Other'")
    orders = staging.stg_orders(s.orders, P)
    kept = orders.filter("is_completed")
    no_user = dq.orphans(orders, "user_id", users, "user_id", skip_null=False)
    items = staging.stg_order_items(s.order_items, P)
    no_order = dq.orphans(items, "order_id", kept, "order_id", skip_null=False)
    return no_user.select(
        F.lit("order").alias("kind"), c("order_id").cast("string").alias("id")
    ).unionAll(no_order.select(F.lit("item"), "order_item_id"))


@query("order_rollup")
def _(s: Shop):
    out = enrich.order_rollup(s, P).select(
        "order_id",
        "item_count",
        "total_units",
        "total_amount",
        "total_cost",
        "total_gross_profit",
        "total_refund_amount",
        "net_revenue",
        "has_returns",
    )
    return out


@query("conditional_distinct")
def _(s: Shop):
    return nested_rollup(
        staging.stg_orders(s.orders, P),
        by=["user_id"],
        nest=["order_id"],
        measures={
            "total_orders": distinct("order_id"),
            "completed_orders": distinct("order_id", "is_completed"),
            "cancelled_orders": distinct("order_id", "is_cancelled"),
            "high_value_orders": distinct(
                "order_id", "is_completed AND is_high_value_order"
            ),
        },
    )


@query("distinct_months")
def _(s: Shop):
    return s.orders.select(fn.date_trunc("month", c("order_date")).alias("order_month")).distinct()


# ---- windows ----


def header_by(s: Shop, unit: str) -> DataFrame:
    """Header totals of all orders per period."""
    period = fn.date_trunc(unit, c("order_date")).alias("period")
    return s.orders.groupBy(period).agg(
        F.sum("total_amount").alias("amount"), F.count("order_id").alias("orders")
    )


def cohort_months(s: Shop) -> DataFrame:
    """Header totals per signup cohort and month of the order."""
    orders = s.orders.join(marketing.signup_cohorts(s, P), "user_id")
    age = fn.date_diff(c("cohort_month"), c("order_date"), "month").cast("bigint")
    return orders.groupBy("cohort_month", age.alias("age")).agg(
        F.sum("total_amount").alias("amount"), F.count("order_id").alias("orders")
    )


@query("win_running_total")
def _(s: Shop):
    running = running_total(c("amount"), "period")
    return header_by(s, "day").select("period", "amount", running.alias("running"))


@query("win_moving_avg")
def _(s: Shop):
    mean = moving_average(c("amount"), 7, "period")
    return header_by(s, "day").select("period", "amount", mean.alias("mean_7_rows"))


@query("win_over_orders")
def _(s: Shop):
    """Windows over all orders, not over periods: totals so far, the mean of the last seven
    orders and the order before, by status; and the total so far of all."""
    orders = s.orders.select("order_id", "order_date", "status", "total_amount")
    order = ["order_date", "order_id"]
    by_status = over_rows(
        orders, order, ["status"], {"status_running": "total_amount"},
        {"status_mean_7_rows": "total_amount"}, {"previous_order_id": "order_id"}, block_rows=4096,
    )
    return over_rows(by_status, order, running={"running": "total_amount"}, block_rows=4096)


@query("win_cohort_cumulative")
def _(s: Shop):
    sizes = marketing.cohort_sizes(marketing.signup_cohorts(s, P))
    so_far = running_total(c("amount"), "age", ["cohort_month"])
    return (
        cohort_months(s)
        .join(sizes, "cohort_month")
        .select(
            "cohort_month",
            "age",
            so_far.alias("so_far"),
            fn.ratio(so_far, c("cohort_size")).alias("so_far_per_customer"),
        )
    )


@query("win_lag")
def _(s: Shop):
    weekly = header_by(s, "week").select(
        F.lit(None).cast("date").alias("cohort_month"),
        c("period").cast("string").alias("step"),
        "orders",
        previous(c("orders"), "period").alias("previous_orders"),
    )
    monthly = cohort_months(s).select(
        "cohort_month",
        c("age").cast("string").alias("step"),
        "orders",
        previous(c("orders"), "age", ["cohort_month"]).alias("previous_orders"),
    )
    return weekly.unionByName(monthly)


@query("win_first_value")
def _(s: Shop):
    first = first_of(c("amount"), "age", ["cohort_month"])
    return cohort_months(s).select("cohort_month", "age", "amount", first.alias("first_amount"))


@query("win_row_number")
def _(s: Shop):
    orders = s.orders.select("order_id", "status", "total_amount")
    order = [F.desc("total_amount"), F.asc("order_id")]
    ranks = {"overall_rank": Rank(order), "status_rank": Rank(order, ["status"])}
    return with_ranks(orders, ranks, key=["order_id"])


@query("win_ntile")
def _(s: Shop):
    orders = s.orders.select("order_id", "order_date", "total_amount")
    ranks = {
        "date_tile": Rank([F.desc("order_date"), F.asc("order_id")], tiles=5),
        "amount_tile": Rank([F.asc("total_amount"), F.asc("order_id")], tiles=7),
    }
    return with_ranks(orders, ranks, key=["order_id"])


query("win_rank_over_agg")(
    lambda s: samples.category_rank_by_units(enrich.int_order_items_enriched(s, P))
)


@query("topk_products")
def _(s: Shop):
    return (
        core.mart_product_performance(s, P)
        .filter("total_revenue > 0")
        .select("product_id", "product_name", "net_revenue")
        .orderBy(F.desc("net_revenue"), "product_id")
        .limit(20)
    )


query("return_analysis")(lambda s: analyses.return_analysis(s, P))

# ---- scalar functions ----


def partly_broken_email():
    """The customer's address, or for every ninth customer its part before the @."""
    return F.when(c("user_id") % 9 == 0, F.split_part(c("email"), F.lit("@"), F.lit(1))).otherwise(
        c("email")
    )


@query("fn_email_domain")
def _(s: Shop):
    return s.users.select("user_id", fn.email_domain(partly_broken_email()).alias("email_domain"))


@query("fn_region")
def _(s: Shop):
    return s.users.select("user_id", fn.map_values(c("region_name"), P.regions).alias("region"))


@query("fn_date_trunc")
def _(s: Shop):
    units = ("day", "week", "month", "quarter", "year")
    return s.orders.select(
        "order_id", *[fn.date_trunc(u, c("order_date")).alias(f"{u}_start") for u in units]
    )


@query("fn_datediff")
def _(s: Shop):
    orders = s.orders.join(s.users.select("user_id", "signup_date"), "user_id")
    return orders.select(
        "order_id",
        *[
            fn.date_diff(c("signup_date"), c("order_date"), u).alias(f"{u}s")
            for u in ("day", "week", "month", "year")
        ],
    )


@query("fn_safe_divide")
def _(s: Shop):
    units = c("quantity") % 7
    return s.order_items.select(
        "order_item_id",
        fn.safe_divide(c("price"), units).alias("per_unit"),
        fn.safe_divide(c("price"), units, default=None).alias("per_unit_or_null"),
    )


@query("fn_surrogate_key")
def _(s: Shop):
    maybe = F.nullif(c("status"), F.lit("cancelled"))
    return s.orders.select(
        "order_id",
        fn.surrogate_key("order_id", "user_id").alias("order_key"),
        fn.surrogate_key(c("order_date"), maybe).alias("state_key"),
    )


@query("fn_cents")
def _(s: Shop):
    cents = fn.dollars_to_cents(c("price"))
    return s.order_items.select(
        "order_item_id",
        cents.alias("cents"),
        fn.cents_to_dollars(cents).alias("dollars"),
        fn.cents_to_dollars(cents, 1).alias("dollars_1"),
    )


@query("fn_date_parts")
def _(s: Shop):
    day = c("order_date")
    return s.orders.select(
        "order_id",
        F.year(day).cast("bigint").alias("year"),
        F.month(day).cast("bigint").alias("month"),
        F.dayofmonth(day).cast("bigint").alias("day"),
        F.quarter(day).cast("bigint").alias("quarter"),
        F.weekofyear(day).cast("bigint").alias("week"),
        fn.day_of_week(day).cast("bigint").alias("dow"),
        F.dayofyear(day).cast("bigint").alias("doy"),
    )


@query("fn_date_format")
def _(s: Shop):
    day = c("order_date")
    return s.orders.select(
        "order_id",
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "MMM").alias("month_short"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "EEE").alias("day_short"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        fn.year_quarter(day).alias("year_quarter"),
    )


@query("fn_period_bounds")
def _(s: Shop):
    day, out = c("order_date"), []
    for unit in ("week", "month", "quarter"):
        out.append(fn.date_trunc(unit, day).alias(f"{unit}_first"))
        out.append(fn.period_end(unit, day).alias(f"{unit}_last"))
    return s.orders.select("order_id", *out)


@query("fn_case_tier")
def _(s: Shop):
    per_customer = s.orders.groupBy("user_id").agg(
        F.sum("total_amount").alias("revenue"),
        F.count_if(c("status") == "completed").alias("orders"),
        F.min("order_date").alias("first_day"),
        F.max("order_date").alias("last_day"),
    )
    p = replace(P, vip_revenue=2_500_000, loyal_revenue=1_500_000)
    return per_customer.select(
        "user_id",
        fn.customer_tier(c("revenue"), c("orders"), p).alias("tier"),
        fn.activity_status(c("first_day"), c("last_day"), p).alias("activity"),
    )


@query("fn_concat_code")
def _(s: Shop):
    day = c("order_date")
    maybe = F.nullif(F.quarter(day), F.lit(4))
    return s.orders.select(
        "order_id",
        fn.concat_code(fn.day_of_week(day), F.month(day), c("status")).alias("code"),
        fn.concat_code(F.year(day), maybe).alias("code_or_null"),
    )


@query("fn_pct_change")
def _(s: Shop):
    change = fn.pct_change(c("amount"), previous(c("amount"), "period"))
    return header_by(s, "month").select("period", change.alias("growth_pct"))


# ---- spine, incremental, history, streams ----

query("date_spine")(lambda s: spine_of(s.orders, "order_date"))

CUT = date(2000, 1, 1)
FACT_COLUMNS = (
    "order_id",
    "order_date",
    "order_status",
    "total_items",
    "subtotal",
    "refund_amount",
    "net_revenue",
    "is_returned",
    "days_to_return",
)


def facts_before_cut(s: Shop) -> DataFrame:
    """Order facts as they were on the cut date: later orders and returns unknown."""
    known = s.replace(
        orders=s.orders.filter(c("order_date") < F.lit(CUT)),
        returns=s.returns.filter(c("return_date") < F.lit(CUT)),
    )
    return core.fct_order_figures(known, P).select(*FACT_COLUMNS)


def facts_now(s: Shop) -> DataFrame:
    return core.fct_order_figures(s, P).select(*FACT_COLUMNS)


# Targets of merges, written once for a session and folder: an incremental run finds its target.
_TARGETS: dict[tuple[str, str], DataFrame] = {}


def merge_query(name: str):
    """Register ``(shop, target) -> DataFrame``, where ``target`` is a written table of the
    order facts on the cut date."""

    def register(build: Callable[[Shop, DataFrame], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            _tuned(spark, folder)
            shop = shop_from_sales_tables(spark, folder)
            of = (spark.sparkContext.applicationId, folder)
            if of not in _TARGETS:
                _TARGETS[of] = written(facts_before_cut(shop), "facts")
            return plain(build(shop, _TARGETS[of]))

        QUERIES[name] = run
        return build

    return register


def merged_facts(
    s: Shop, target: DataFrame, lookback_days: int, changed_orders: DataFrame | None = None
) -> DataFrame:
    """The target with the facts of recent and named orders as they are now. Only these
    orders, their items and returns are rolled up."""
    newest = F.lit(target.agg(F.max("order_date")).first()[0])
    due = due_for_refresh(s, newest, lookback_days, changed_orders)
    return upsert(target, written(facts_now(due), "changes"), "order_id")


@merge_query("incremental_merge")
def _(s: Shop, target: DataFrame):
    return merged_facts(s, target, P.lookback_days)


@merge_query("incremental_changed_keys")
def _(s: Shop, target: DataFrame):
    late = enrich.orders_of_returns(s, s.returns.filter(c("return_date") >= F.lit(CUT)))
    return merged_facts(s, target, P.lookback_days, late)


@merge_query("schema_sync")
def _(s: Shop, target: DataFrame):
    """The target lacks two columns and has two that the source no longer has."""
    older = target.drop("net_revenue", "is_returned").withColumn("old", F.lit(1))
    source = facts_now(s).drop("refund_amount")
    return incremental_merge(older, source, "order_id", "order_date", P.lookback_days)


@merge_query("full_refresh")
def _(s: Shop, target: DataFrame):
    return incremental_merge(target, facts_now(s), "order_id", "order_date", full_refresh=True)


@merge_query("catch_up_window")
def _(s: Shop, target: DataFrame):
    return merged_facts(s, target, 7)


# Of the input; a task reads about six times as much to write its bucket.
BYTES_PER_BUCKET = 2**24


def buckets_of(input_bytes: int) -> int:
    return max(8, input_bytes // BYTES_PER_BUCKET)


def bucketed_facts(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Orders and their items as catalog tables bucketed by order, made once for a session and
    folder. Buckets follow the input's size."""
    of = (spark.sparkContext.applicationId, folder)
    if of not in _BUCKETED:
        shop = shop_from_sales_tables(spark, folder)
        buckets = buckets_of(folder_bytes(spark, folder, SALES_SCHEMAS))
        name = f"facts_{uuid.uuid4().hex}"
        _BUCKETED[of] = tuple(
            write_bucketed(
                df, f"{name}_{part}", "order_id", buckets, path=run_folder(spark, f"bucketed_{part}")
            )
            for part, df in (("orders", staging.stg_orders(shop.orders, P)),
                             ("items", staging.stg_order_items(shop.order_items, P)))
        )
    return _BUCKETED[of]


_BUCKETED: dict[tuple[str, str], tuple[DataFrame, DataFrame]] = {}


def totals_of_bucketed(spark: SparkSession, folder: str) -> DataFrame:
    """Header and item totals per order, joined and added up bucket by bucket."""
    _tuned(spark, folder)
    orders, items = bucketed_facts(spark, folder)
    sums = items.groupBy("order_id").agg(
        F.count("order_item_id").alias("items"), F.sum("line_total").alias("items_total")
    )
    return plain(
        orders.select("order_id", "order_status", "total_amount").join(sums, "order_id", "left")
    )


QUERIES["join_bucketed_facts"] = totals_of_bucketed


RUNS = (date(1996, 1, 1), date(1998, 1, 1), date(2000, 1, 1))


def history_of(snapshots: Sequence[DataFrame], key: str, check_cols: Sequence[str]) -> DataFrame:
    history = None
    for day, snapshot in zip(RUNS, snapshots, strict=True):
        history = scd2_apply(history, snapshot, key, check_cols, F.lit(day))
    return history


def customer_history(s: Shop) -> DataFrame:
    """Every tenth customer changes segment before the second run, every fiftieth is
    missing then, and every hundredth is back in the third."""
    users = s.users.select("user_id", "email", "signup_date", "country", "customer_segment")
    moved = users.withColumn(
        "customer_segment",
        F.when(c("user_id") % 10 == 0, F.concat(F.lit("EX-"), "customer_segment")).otherwise(
            c("customer_segment")
        ),
    )
    second = moved.filter(c("user_id") % 50 != 0)
    third = moved.filter((c("user_id") % 50 != 0) | (c("user_id") % 100 == 0))
    return history_of([users, second, third], "user_id", ["customer_segment", "country"])


def product_history(s: Shop) -> DataFrame:
    """Every seventh product gets dearer before the second run, every eleventh changes
    category before the third, every thirteenth is missing in the second."""
    first = s.products.select("product_id", "product_name", "category", "supplier_id", "cost")
    dearer = first.withColumn(
        "cost",
        F.when(c("product_id") % 7 == 0, c("cost") + 100).otherwise(c("cost")).cast("decimal(14,2)"),
    )
    moved = dearer.withColumn(
        "category",
        F.when(c("product_id") % 11 == 0, F.lit("MOVED")).otherwise(c("category")),
    )
    second = dearer.filter(c("product_id") % 13 != 0)
    return history_of([first, second, moved], "product_id", ["cost", "category"])


query("scd2_customers")(customer_history)
query("scd2_products")(product_history)


@query("scd2_point_in_time")
def _(s: Shop):
    then = scd2_as_of(customer_history(s), F.lit(date(1999, 6, 1)))
    return then.select("user_id", "country", "customer_segment", "valid_from")


@query("asof_product_cost")
def _(s: Shop):
    sales = s.order_items.join(s.orders.select("order_id", "order_date"), "order_id").select(
        "order_item_id", "product_id", "order_date", "quantity"
    )
    priced = join_as_of(sales, product_history(s), "product_id", "order_date", ["cost"])
    return priced.select(
        "order_item_id", "product_id", "order_date", "cost", (c("cost") * c("quantity")).alias("total_cost")
    )


@table_query("stream_upsert")
def _(read, folder):
    """Two arrivals of orders: first those before the cut, all still completed, then
    those since a month before the cut with their status of today."""
    orders = orders_from(read("orders")).withColumn(
        "order_month", fn.date_trunc("month", c("order_date"))
    )
    first = orders.filter(c("order_date") < F.lit(CUT)).withColumns(
        {"status": F.lit("completed"), "arrival": F.lit(1)}
    )
    second = orders.filter(c("order_date") >= F.date_sub(F.lit(CUT), 30)).withColumn(
        "arrival", F.lit(2)
    )
    spark = orders.sparkSession
    landing, table = run_folder(spark, "landing"), run_folder(spark, "orders")
    checkpoint = run_folder(spark, "stream")
    for arrival in (first, second):
        arrival.write.mode("append").parquet(landing)
        stream = spark.readStream.schema(first.schema).parquet(landing)
        run = stream_upsert(stream, table, "order_id", "arrival", "order_month", checkpoint)
        run.awaitTermination()
    return latest_version(spark, table)


@table_query("stream_daily_revenue")
def _(read, folder):
    """Daily figures from the stream of order files."""
    schema = read("orders").schema
    spark = read("orders").sparkSession
    stream = orders_from(stream_table(spark, folder, "orders", schema))
    stream = stream.withColumn("ts", c("order_date").cast("timestamp"))
    table, checkpoint = run_folder(spark, "daily"), run_folder(spark, "stream")
    measures = {
        "order_count": F.count("order_id"),
        "completed_orders": F.count_if(c("status") == "completed"),
        "revenue": F.sum("total_amount"),
    }
    run = stream_daily(stream, table, "ts", measures, checkpoint)
    run.awaitTermination()
    return latest_version(spark, table).select("day", *measures)


# ---- analyses, documented queries, metrics ----


@query("executive_summary")
def _(s: Shop):
    s = enrich.with_written_lines(s)
    return analyses.executive_summary(
        core.fct_order_figures(s, P),
        core.dim_customers(s, P),
        core.mart_product_performance(s, P),
    )


query("customer_segmentation_summary")(
    lambda s: analyses.customer_segmentation_summary(marketing.fct_rfm_analysis(s, P))
)
query("top_products_by_revenue")(
    lambda s: analyses.top_products_by_revenue(core.mart_product_performance(s, P))
)
query("weekly_revenue_trend")(lambda s: analyses.weekly_revenue_trend(core.fct_order_figures(s, P)))
query("cohort_retention_matrix")(lambda s: analyses.cohort_retention_matrix(s, P))
query("clv_premium_top10")(
    lambda s: samples.customers_by_value(core.dim_customers(s, P), "BUILDING")
)
query("high_return_products")(
    lambda s: samples.high_return_products(core.mart_product_performance(s, P), 0.02)
)
query("returned_orders_recent")(lambda s: samples.latest_returned_orders(core.fct_orders(s, P)))
query("monthly_trends")(lambda s: samples.monthly_trends(core.fct_order_figures(s, P)))
query("items_revenue_returns")(lambda s: samples.items_revenue_returns(core.fct_order_items(s, P)))
query("daily_recent")(lambda s: samples.daily_recent(finance.fct_daily_revenue(s, P)))


@query("metric_rollup")
def _(s: Shop):
    return samples.metric_rollup(
        core.fct_orders(s, P),
        measures={"revenue": F.sum("subtotal"), "order_count": F.count("order_id")},
        time_col="order_date",
        grain="month",
        dims=["region"],
        derived={"average_order_value": fn.ratio(c("revenue"), c("order_count"))},
    )


# ---- data quality ----


@query("dq_unique")
def _(s: Shop):
    return dq.duplicates(staging.stg_orders(s.orders, P), ["user_id"])


@query("dq_not_null")
def _(s: Shop):
    customers = core.dim_customers(s, P)
    return dq.failing(customers, dq.is_null("first_order_date")).select("customer_id", "email")


@query("dq_accepted_values")
def _(s: Shop):
    returns = staging.stg_returns(s.returns, P)
    bad = dq.not_accepted("return_reason", list(REASON_CATEGORIES))
    return dq.failing(returns, bad).select("return_id", "return_reason")


@query("dq_relationships")
def _(s: Shop):
    orders = staging.stg_orders(s.orders, P)
    users = staging.stg_users(s.users, P).filter("region <> 'Other'")
    return dq.orphans(orders, "user_id", users, "user_id").select("order_id", "user_id")


@table_query("dq_positive_value")
def _(read, folder):
    return dq.failing(read("customer"), dq.not_positive("c_acctbal")).select(
        "c_custkey", "c_acctbal"
    )


@query("dq_valid_email")
def _(s: Shop):
    users = s.users.select("user_id", partly_broken_email().alias("email"))
    return dq.failing(users, dq.bad_email("email"))


@query("dq_date_not_in_future")
def _(s: Shop):
    returns = staging.stg_returns(s.returns, P)
    return dq.failing(returns, dq.in_future("return_date", P.as_of)).select(
        "return_id", "return_date"
    )


@query("dq_unique_combination")
def _(s: Shop):
    return dq.duplicates(s.order_items, ["order_id", "product_id"], skip_null=False)


@query("dq_match_regex")
def _(s: Shop):
    users = s.users.select("user_id", partly_broken_email().alias("email"))
    return dq.failing(users, dq.not_matching("email", EMAIL_REGEX))


@query("dq_between")
def _(s: Shop):
    orders = core.fct_order_figures(s, P)
    return dq.failing(orders, dq.not_between("subtotal", 0, 5_000_000)).select(
        "order_id", "subtotal"
    )


@table_query("dq_column_type")
def _(read, folder):
    orders = read("orders")
    return dq.wrong_type(orders, "o_orderdate", "date").unionByName(
        dq.wrong_type(orders, "o_orderkey", "bigint")
    )


@query("dq_order_totals")
def _(s: Shop):
    return dq.order_total_mismatch(
        staging.stg_orders(s.orders, P), staging.stg_order_items(s.order_items, P)
    )


@query("dq_refund_limit")
def _(s: Shop):
    return dq.refund_above_limit(
        staging.stg_returns(s.returns, P), staging.stg_order_items(s.order_items, P), "0.5"
    )


@query("dq_orphans")
def _(s: Shop):
    users = staging.stg_users(s.users, P).filter("customer_segment <> 'BUILDING'")
    orders = staging.stg_orders(s.orders, P)
    recent = orders.filter(c("order_date") >= F.lit(CUT))
    items = staging.stg_order_items(s.order_items, P)
    no_user = dq.orphans(orders, "user_id", users, "user_id", skip_null=False)
    no_order = dq.orphans(items, "order_id", recent, "order_id", skip_null=False)
    return no_user.select(
        F.lit("orders without user").alias("check"),
        c("order_id").cast("string").alias("id"),
        c("user_id").alias("parent_id"),
    ).unionAll(no_order.select(F.lit("items without order"), "order_item_id", "order_id"))


@query("dq_freshness")
def _(s: Shop):
    as_of = F.lit(P.as_of)
    parts = [
        dq.freshness(s.users, "users", "signup_date", as_of, 12, 24),
        dq.freshness(s.orders, "orders", "order_date", as_of, 6, 36),
        dq.freshness(s.returns, "returns", "return_date", as_of, 12, 24),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("dq_row_count_change")
def _(s: Shop):
    return dq.row_count_change(s.orders.filter(c("order_date") < F.lit(date(1997, 1, 1))), s.orders)


@query("dq_contract")
def _(s: Shop):
    orders = staging.stg_orders(s.orders, P)
    contract = dq.Contract(
        types={"order_id": "string", "total_amount": "decimal(14,2)"},
        not_null=["order_id", "total_amount"],
        primary_key=["order_id"],
        expressions=["total_amount >= 0", "total_amount < 400000"],
    )
    return dq.run_checks({"orders": orders}, dq.contract_checks(orders, contract, "orders"))


def staged_tables(s: Shop) -> dict[str, DataFrame]:
    return {
        "stg_users": staging.stg_users(s.users, P),
        "stg_products": staging.stg_products(s.products, P),
        "stg_orders": staging.stg_orders(s.orders, P),
        "stg_order_items": staging.stg_order_items(s.order_items, P),
        "stg_returns": staging.stg_returns(s.returns, P),
    }


def checked(
    tables: dict[str, DataFrame],
    checks: Sequence[dq.Check],
    write: Sequence[str],
    settled: bool = True,
):
    """Results of the checks. The tables of ``write`` are written with the columns that several
    checks read, and their row rules are counted while they are."""
    counted = {}
    for name in write:
        if columns := check_columns(checks, name):
            tables[name], counted[name] = dq.write_counted(name, tables[name], checks, columns)
    return dq.run_checks(tables, checks, counted, settled)


@query("dq_suite")
def _(s: Shop):
    """All declared checks of the staging tables. Items and returns are read by many
    checks, so their keys are made once. Its shuffles are few enough to be made all at once."""
    checks = staging_checks(P.as_of, SALES_DOMAINS)
    return checked(staged_tables(s), checks, ["stg_order_items", "stg_returns"], settled=False)


@query("dq_all")
def _(s: Shop):
    """All declared checks of the raw, staging, intermediate, mart and history tables. Returns,
    orders and items are written once, and every mart is made once from them, for its rules and
    for its keys; staging tables and enriched items are cheaper to read again than to write."""
    s = enrich.with_written_items(s)
    customers = core.dim_customers(s, P)
    marts = {
        "int_customer_orders": enrich.int_customer_orders(s, P),
        "int_order_items_enriched": enrich.int_order_items_enriched(s, P),
        "int_orders_enriched": enrich.int_orders_enriched(s, P),
        "int_product_performance": enrich.int_product_performance(s, P),
        "dim_customers": customers,
        "dim_date": core.dim_date(spine_of(s.orders, "order_date"), P),
        "fct_order_items": core.fct_order_items(s, P),
        "fct_orders": core.fct_orders(s, P),
        "mart_product_performance": core.mart_product_performance(s, P),
        "fct_daily_revenue": finance.fct_daily_revenue(s, P),
        "fct_product_profitability": finance.fct_product_profitability(s, P),
        "fct_customer_cohorts": marketing.fct_customer_cohorts(s, P),
        "fct_rfm_analysis": marketing.fct_rfm_analysis(s, P),
        "snap_customers": customer_history(s),
        "snap_products": product_history(s),
    }
    raw = {f"raw_{name}": getattr(s, name) for name in TABLES}
    checks = all_checks(P.as_of, SALES_DOMAINS, (0, 5_000_000))
    tables = raw | staged_tables(s) | marts
    write = [name for name in marts if name != "int_order_items_enriched"]
    return checked(tables, checks, write)


# Accepted values of the sales tables (two left out on purpose).
SALES_DOMAINS = {
    "order_status": ["completed"],
    "status": ["completed"],
    "category": ["STANDARD", "ECONOMY", "MEDIUM", "LARGE", "SMALL", "PROMO"],
    "return_reason": ["defective", "changed_mind", "wrong_item", "damaged_shipping"],
    "customer_segment": ["BUILDING", "AUTOMOBILE", "MACHINERY", "HOUSEHOLD", "FURNITURE"],
    "country": [f"NATION_{i}" for i in range(25)],
}
