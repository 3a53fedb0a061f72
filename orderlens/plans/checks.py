"""The declared data-quality checks of every table."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from datetime import date

from orderlens.operators import quality as dq
from orderlens.operators.quality import Check

# Pattern of a valid address, bounds of an order's subtotal.
EMAIL_REGEX = r"^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+$"
SUBTOTAL_BOUNDS = (0, 10_000)

# Accepted values per column.
STORE_DOMAINS = {
    "country": ["USA", "Canada", "UK", "Australia"],
    "customer_segment": ["Premium", "Standard", "Basic"],
    "category": ["Electronics", "Office", "Furniture", "Home"],
    "order_status": ["completed", "cancelled"],
    "status": ["completed", "cancelled"],
    "return_reason": ["defective", "changed_mind", "wrong_item", "damaged_shipping"],
}

# Checks per table and column. "accepted" looks up the column's domain,
# "parent(table.column)" asks for a matching row, "together(a,b)" for unique tuples.
STAGING_CHECKS = {
    "stg_users": """
        user_id: unique not_null
        email: unique not_null valid_email
        signup_date: not_null not_future
        country: not_null accepted
        customer_segment: not_null accepted
    """,
    "stg_products": """
        product_id: unique not_null
        product_name: not_null
        category: not_null accepted
        supplier_id: not_null
        unit_cost: not_null positive
    """,
    "stg_orders": """
        order_id: unique not_null
        user_id: not_null parent(stg_users.user_id)
        order_date: not_null not_future
        order_status: not_null accepted
        total_amount: not_null
    """,
    "stg_order_items": """
        order_item_id: unique not_null
        order_id: not_null parent(stg_orders.order_id)
        product_id: not_null parent(stg_products.product_id)
        quantity: not_null positive
        unit_price: not_null positive
        line_total: not_null
    """,
    "stg_returns": """
        return_id: unique not_null
        order_item_id: not_null
        return_date: not_null not_future
        return_reason: not_null accepted
        refund_amount: not_null positive
    """,
}
RAW_CHECKS = {
    "raw_users": """
        user_id: unique not_null
        email: unique not_null
        signup_date: not_null
        country: not_null accepted
        customer_segment: not_null accepted
    """,
    "raw_products": """
        product_id: unique not_null
        product_name: not_null
        category: not_null accepted
        supplier_id: not_null
        cost: not_null
    """,
    "raw_orders": """
        order_id: unique not_null
        user_id: not_null
        order_date: not_null
        status: not_null accepted
        total_amount: not_null
    """,
    "raw_order_items": """
        order_item_id: unique not_null
        order_id: not_null
        product_id: not_null
        quantity: not_null
        price: not_null
    """,
    "raw_returns": """
        return_id: unique not_null
        order_item_id: not_null
        return_date: not_null
        return_reason: not_null accepted
        refund_amount: not_null
    """,
}
# The source declaration repeats the key checks of the raw tables.
SOURCE_CHECKS = {
    "raw_users": "user_id: unique not_null\nemail: unique",
    "raw_products": "product_id: unique not_null",
    "raw_orders": "order_id: unique not_null",
    "raw_order_items": "order_item_id: unique not_null",
    "raw_returns": "return_id: unique not_null",
}
MART_CHECKS = {
    "int_customer_orders": "user_id: unique not_null",
    "int_order_items_enriched": "order_item_id: unique not_null",
    "int_orders_enriched": "order_id: unique not_null",
    "int_product_performance": "product_id: unique not_null",
    "dim_customers": """
        customer_id: unique not_null
        email: unique not_null
        customer_segment: not_null accepted
    """,
    "dim_date": "date_id: unique not_null",
    "fct_order_items": """
        order_item_id: unique not_null
        order_id: not_null
        product_id: not_null
        quantity: not_null
    """,
    "fct_orders": """
        order_id: unique not_null
        order_date: not_null type(date)
        customer_email: email_regex
        subtotal: subtotal_bounds
    """,
    "mart_product_performance": """
        product_id: unique not_null
        product_name: not_null
    """,
    "fct_daily_revenue": "date_id: unique not_null",
    "fct_product_profitability": """
        product_id: not_null
        month_id: not_null
        *: together(product_id,month_id)
    """,
    "fct_customer_cohorts": """
        cohort_month: not_null
        months_since_signup: not_null
        *: together(cohort_month,months_since_signup)
    """,
    "fct_rfm_analysis": "customer_id: unique not_null",
    "snap_customers": "user_id: not_null",
    "snap_products": "product_id: not_null",
}


def parse_checks(
    text_by_table: Mapping[str, str],
    as_of: date,
    domains: Mapping[str, Sequence[str]] = STORE_DOMAINS,
    subtotal_bounds: tuple = SUBTOTAL_BOUNDS,
) -> list[Check]:
    """Checks for a declaration of the form above."""
    checks = []
    for table, text in text_by_table.items():
        for line in filter(None, map(str.strip, text.splitlines())):
            column, names = line.split(":")
            for kind in names.split():
                checks.append(_check(table, column, kind, as_of, domains, subtotal_bounds))
    return checks


def _check(table, column, kind, as_of, domains, bounds) -> Check:
    word, argument = re.fullmatch(r"(\w+)(?:\((.*)\))?", kind).groups()
    name = f"{kind} {column}"
    if word == "unique":
        return Check(table, name, key=(column,))
    if word == "together":
        return Check(table, name, key=tuple(argument.split(",")), skip_null=False)
    if word == "parent":
        return Check(table, name, key=(column,), parent=tuple(argument.split(".")))
    if word == "type":
        return Check(table, name, rows=lambda t: dq.wrong_type(t[table], column, argument))
    rules = {
        "not_null": lambda: dq.is_null(column),
        "accepted": lambda: dq.not_accepted(column, domains[column]),
        "positive": lambda: dq.not_positive(column, allow_zero=False),
        "valid_email": lambda: dq.bad_email(column),
        "not_future": lambda: dq.in_future(column, as_of),
        "email_regex": lambda: dq.not_matching(column, EMAIL_REGEX),
        "subtotal_bounds": lambda: dq.not_between(column, *bounds),
    }
    return Check(table, name, rule=rules[word]())


# Columns that the checks with a function of their own read.
BUSINESS_COLUMNS = {
    "fct_orders": {"order_date"},
    "stg_orders": {"order_id", "order_status", "total_amount"},
    "stg_order_items": {"order_id", "order_item_id", "line_total"},
    "stg_returns": {"return_id", "order_item_id", "refund_amount"},
}


def business_checks() -> list[Check]:
    """The four checks across staging tables."""
    return [
        Check(
            "stg_orders",
            "orders reference known users",
            key=("user_id",),
            parent=("stg_users", "user_id"),
            skip_null=False,
        ),
        Check(
            "stg_order_items",
            "items belong to known orders",
            key=("order_id",),
            parent=("stg_orders", "order_id"),
            skip_null=False,
        ),
        Check(
            "stg_order_items",
            "items add up to the order total",
            rows=lambda t: dq.order_total_mismatch(t["stg_orders"], t["stg_order_items"]),
            severity="warn",
        ),
        Check(
            "stg_returns",
            "refund within the limit",
            rows=lambda t: dq.refund_above_limit(t["stg_returns"], t["stg_order_items"]),
        ),
    ]


def staging_checks(as_of: date, domains=STORE_DOMAINS) -> list[Check]:
    return parse_checks(STAGING_CHECKS, as_of, domains) + business_checks()


def all_checks(as_of: date, domains=STORE_DOMAINS, subtotal_bounds=SUBTOTAL_BOUNDS) -> list[Check]:
    """Every declared check of the raw, staging, intermediate and mart tables."""
    declared = []
    for group in (RAW_CHECKS, SOURCE_CHECKS, STAGING_CHECKS, MART_CHECKS):
        declared += parse_checks(group, as_of, domains, subtotal_bounds)
    return declared + business_checks()


def check_columns(checks: Sequence[Check], table: str) -> list[str]:
    """Columns of a table that its checks on sets of rows read."""
    columns = {k for c in checks if c.table == table for k in c.key}
    columns |= {c.parent[1] for c in checks if c.parent and c.parent[0] == table}
    return sorted(columns | BUSINESS_COLUMNS.get(table, set()))
