import os
import sys
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from orderlens.session import tune  # noqa: E402
from orderlens.sources import Shop  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


def day(month, number, year=2001):
    return date(year, month, number)


def money(text):
    return None if text is None else Decimal(text)


SCHEMAS = {
    "users": "user_id bigint, email string, signup_date date, country string, "
    "region_name string, customer_segment string",
    "products": "product_id bigint, product_name string, category string, supplier_id int, "
    "cost decimal(14,2)",
    "orders": "order_id bigint, user_id bigint, order_date date, status string, "
    "total_amount decimal(14,2)",
    "order_items": "order_item_id string, order_id bigint, product_id bigint, quantity int, "
    "price decimal(14,2)",
    "returns": "return_id string, order_item_id string, return_date date, return_reason string, "
    "refund_amount decimal(14,2)",
}

# Customers without orders, unknown regions and categories, orders of unknown or no
# customer, cancelled orders with items, items of unknown orders and products, items
# with several returns, returns without a reason, zero amounts, ties.
ROWS = {
    "users": [
        (1, "ann@shop.example.com", day(1, 5), "A", "AMERICA", "BUILDING"),
        (2, "bob.example.com", day(1, 20), "B", "EUROPE", "BUILDING"),
        (3, "cy@shop.example.com", day(2, 1), "C", "ATLANTIS", None),
        (4, "di@shop.example.com", day(2, 28), "D", None, "MACHINERY"),
        (5, "ed@shop.example.com", day(3, 1), "A", "ASIA", "MACHINERY"),
    ],
    "products": [
        (10, "ring", "STANDARD", 1, money("100.00")),
        (11, "disk", "MEDIUM", 2, money("2000000.00")),
        (12, "cog", "WEIRD", 1, money("0.50")),
        (13, "unsold", "LARGE", 3, money("5.00")),
    ],
    "orders": [
        (100, 1, day(3, 1), "completed", money("500000.00")),
        (101, 1, day(3, 1), "completed", money("10.00")),
        (102, 1, day(6, 15), "cancelled", money("0.00")),
        (103, 2, day(3, 9), "completed", money("400000.00")),
        (104, 2, day(7, 31), None, None),
        (105, 3, day(4, 2), "completed", money("1.00")),
        (106, 99, day(4, 2), "completed", money("77.00")),
        (107, None, day(4, 3), "completed", money("78.00")),
        (108, 4, day(5, 5), "cancelled", money("0.00")),
        (109, 2, day(1, 31), "completed", money("12.00")),
    ],
    "order_items": [
        ("a", 100, 10, 2, money("150.00")),
        ("b", 100, 11, 3, money("15000000.00")),
        ("c", 101, 12, 7, money("0.10")),
        ("d", 102, 10, 1, money("90.00")),
        ("e", 103, 11, 1, money("31000000.00")),
        ("f", 103, 999, 4, money("10.00")),
        ("g", 105, 10, 0, money("10.00")),
        ("h", 106, 12, 5, money("3.00")),
        ("i", 107, 10, 1, money("101.00")),
        ("j", 888, 10, 1, money("55.00")),
        ("k", 109, 10, 2, money("99.99")),
        ("l", 109, 10, 2, money("99.99")),
    ],
    "returns": [
        ("r1", "a", day(3, 20), "defective", money("150.00")),
        ("r2", "a", day(3, 11), "changed_mind", money("100.00")),
        ("r3", "a", day(4, 11), "defective", money("20.00")),
        ("r4", "d", day(7, 1), "wrong_item", money("90.00")),
        ("r5", "f", day(3, 10), "damaged_shipping", money("10.00")),
        ("r6", "i", day(4, 30), None, money("1.00")),
        ("r7", "j", day(4, 30), "defective", money("2.00")),
        ("r8", "zz", day(4, 30), "defective", money("2.00")),
        ("r9", "k", day(2, 28), "whatever", None),
        ("r10", "e", day(8, 30), "damaged_shipping", money("31000000.00")),
    ],
}


def frames(spark, rows=ROWS):
    return {name: spark.createDataFrame(rows[name], SCHEMAS[name]) for name in SCHEMAS}


@pytest.fixture(scope="session")
def shop(spark):
    return Shop(**frames(spark))


@pytest.fixture(scope="session")
def empty_shop(spark):
    return Shop(**{n: spark.createDataFrame([], schema) for n, schema in SCHEMAS.items()})


def rows(df, *columns):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)
