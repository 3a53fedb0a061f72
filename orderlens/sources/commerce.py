"""Retail entities derived from the customer / part / orders / lineitem star schema."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.params import Params
from orderlens.sources.tables import Shop, read_table

# Thresholds that split this data into classes of useful size.
SALES_PARAMS = Params(
    as_of=date(2001, 8, 2),
    high_value_order=400_000,
    vip_revenue=50_000_000,
    vip_orders=8,
    loyal_revenue=30_000_000,
    loyal_orders=6,
    active_days=90,
    at_risk_days=365,
    star_revenue=30_000_000,
    star_return_rate=0.02,
    strong_revenue=25_000_000,
    average_revenue=15_000_000,
    spine_start=date(1995, 1, 1),
    spine_end=date(2001, 8, 2),
    category_groups={
        "STANDARD": "Core",
        "ECONOMY": "Core",
        "MEDIUM": "Sized",
        "LARGE": "Sized",
    },
    region_source="region_name",
    regions={
        "AMERICA": "North America",
        "EUROPE": "Europe",
        "ASIA": "Asia Pacific",
    },
)

MONEY = "decimal(14,2)"

# Declared column types of the sales tables.
SALES_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def _users(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    places = nation.join(region, F.expr("n_regionkey = r_regionkey"))
    return customer.join(places, F.expr("c_nationkey = n_nationkey")).selectExpr(
        "c_custkey AS user_id",
        "concat(lower(replace(c_name, '#', '')), '@', lower(replace(r_name, ' ', '')), "
        "'.example.com') AS email",
        "date_add(DATE '1994-01-01', cast(c_custkey % 360 AS int)) AS signup_date",
        "n_name AS country",
        "r_name AS region_name",
        "c_mktsegment AS customer_segment",
    )


def _products(part: DataFrame) -> DataFrame:
    return part.selectExpr(
        "p_partkey AS product_id",
        "p_name AS product_name",
        "p_type AS category",
        "p_size AS supplier_id",
        f"cast(cast(p_retailprice AS decimal(12,2)) * 40 AS {MONEY}) AS cost",
    )


def orders_from(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(
        "o_orderkey AS order_id",
        "o_custkey AS user_id",
        "cast(o_orderdate AS date) AS order_date",
        "if(o_orderstatus = 'P', 'cancelled', 'completed') AS status",
        f"cast(if(o_orderstatus = 'P', 0, o_totalprice) AS {MONEY}) AS total_amount",
    )


def _order_items(lineitem: DataFrame, *more: str) -> DataFrame:
    parts = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "cast(l_shipdate AS date)")
    texts = ", ".join(f"cast({part} AS string)" for part in parts)
    return lineitem.selectExpr(
        f"md5(concat_ws('-', {texts})) AS order_item_id",
        "l_orderkey AS order_id",
        "l_partkey AS product_id",
        "cast(l_quantity AS int) AS quantity",
        f"cast(l_extendedprice AS {MONEY}) AS price",
        "l_linenumber",
        "l_returnflag",
        *more,
    )


# Reason of a return by line number modulo 5.
REASONS = ("defective", "changed_mind", "wrong_item", "damaged_shipping", "unspecified")


def _returns(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """The item ids are made after the join, which moves the numbers that they are made of."""
    reasons = ", ".join(f"'{r}'" for r in REASONS)
    dated = orders.select(F.col("order_id").alias("_order"), "order_date")
    returned = lineitem.filter("l_returnflag = 'R'").join(dated, F.expr("l_orderkey = _order"))
    return _order_items(returned, "order_date").selectExpr(
        "concat('R-', order_item_id) AS return_id",
        "order_item_id",
        "date_add(order_date, cast((order_id * 7 + l_linenumber) % 60 AS int)) AS return_date",
        f"array({reasons})[l_linenumber % 5] AS return_reason",
        "price AS refund_amount",
    )


def shop_from_sales_tables(spark: SparkSession, folder: str) -> Shop:
    """Map the star schema in ``folder`` to the five retail tables."""

    def table(name: str) -> DataFrame:
        return read_table(spark, f"{folder}/{name}.parquet", SALES_SCHEMAS[name])

    return Shop(
        users=lambda: _users(table("customer"), table("nation"), table("region")),
        products=lambda: _products(table("part")),
        orders=lambda: orders_from(table("orders")),
        order_items=lambda: _order_items(table("lineitem")).drop("l_linenumber", "l_returnflag"),
        returns=lambda: _returns(table("lineitem"), orders_from(table("orders"))),
    )
