from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from orderlens.operators import quality as dq
from orderlens.plans import core, staging
from orderlens.plans.checks import (
    EMAIL_REGEX,
    MART_CHECKS,
    all_checks,
    parse_checks,
    staging_checks,
)
from orderlens.sources import SALES_PARAMS as P


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(
        [
            (1, "a@b.co", 5, date(2023, 1, 1)),
            (2, "nobody", 0, date(2023, 1, 2)),
            (2, "x@y", -1, date(2023, 1, 3)),
            (None, None, None, None),
            (None, None, None, None),
        ],
        "id int, email string, n int, day date",
    )


def failures(df, rule):
    return dq.failing(df, rule).count()


def test_row_rules(df):
    assert failures(df, dq.is_null("id")) == 2
    assert failures(df, dq.not_accepted("n", [5, 0])) == 1
    assert failures(df, dq.not_positive("n")) == 1
    assert failures(df, dq.not_positive("n", allow_zero=False)) == 2
    assert failures(df, dq.bad_email("email")) == 2
    assert failures(df, dq.not_matching("email", EMAIL_REGEX)) == 2
    assert failures(df, dq.in_future("day", date(2023, 1, 2))) == 1
    assert failures(df, dq.not_between("n", 0, 4)) == 2


def test_duplicates(df):
    assert rows(dq.duplicates(df, ["id"])) == [(2, 2)]
    assert dq.duplicates(df, ["id", "email"]).count() == 0
    assert dq.duplicates(df, ["id", "email"], skip_null=False).count() == 1


def test_orphans(spark, df):
    parent = spark.createDataFrame([(1,), (None,)], "pid int")
    assert dq.orphans(df, "id", parent, "pid").count() == 2
    assert dq.orphans(df, "id", parent, "pid", skip_null=False).count() == 4


def test_wrong_type(df):
    assert rows(dq.wrong_type(df, "day", "timestamp")) == [("day", "date", "timestamp", 3)]
    assert dq.wrong_type(df, "day", "date").count() == 0


def test_freshness(spark):
    as_of = F.lit(datetime(2023, 1, 3, 0, 0))

    def status(hour):
        df = spark.createDataFrame([(datetime(2023, 1, 2, hour),)], "ts timestamp")
        return dq.freshness(df, "t", "ts", as_of, 12, 20).first()["status"]

    assert [status(h) for h in (13, 11, 3)] == ["pass", "warn", "error"]
    none = spark.createDataFrame([], "ts timestamp")
    assert dq.freshness(none, "t", "ts", as_of, 12, 20).first()["status"] == "error"


def test_row_count_change(spark):
    def change(a, b, **kw):
        return rows(dq.row_count_change(spark.range(a), spark.range(b), **kw))

    assert change(200, 250) == []
    assert change(200, 301) == [(200, 301, 50.5)]
    assert change(100, 99) == [(100, 99, 1.0)]
    assert change(0, 200) == [(0, 200, None)]


def test_contract(df):
    contract = dq.Contract(
        types={"id": "int", "n": "string", "missing": "int"},
        not_null=["n"],
        primary_key=["id"],
        expressions=["n >= 0"],
    )
    got = dq.run_checks({"t": df}, dq.contract_checks(df, contract, "t"))
    assert {r["check"]: r["failures"] for r in got.collect()} == {
        "type id int": 0,
        "type n string": 5,
        "type missing int": 5,
        "not_null n": 2,
        "not_null id": 2,
        "check n >= 0": 1,
        "unique id": 1,
    }


def test_staging_suite_finds_the_odd_rows(shop):
    tables = {
        "stg_users": staging.stg_users(shop.users, P),
        "stg_products": staging.stg_products(shop.products, P),
        "stg_orders": staging.stg_orders(shop.orders, P),
        "stg_order_items": staging.stg_order_items(shop.order_items, P),
        "stg_returns": staging.stg_returns(shop.returns, P),
    }
    got = dq.run_checks(tables, staging_checks(P.as_of))
    found = {(r["table"], r["check"]): r["failures"] for r in got.collect() if r["failures"]}
    assert found[("stg_users", "valid_email email")] == 1
    assert found[("stg_users", "not_null customer_segment")] == 1
    assert found[("stg_orders", "parent(stg_users.user_id) user_id")] == 1
    assert found[("stg_orders", "orders reference known users")] == 2
    assert found[("stg_order_items", "parent(stg_orders.order_id) order_id")] == 1
    assert found[("stg_order_items", "parent(stg_products.product_id) product_id")] == 1
    assert found[("stg_order_items", "positive quantity")] == 1
    assert found[("stg_returns", "not_future return_date")] == 1
    severities = {r["check"]: r["severity"] for r in got.collect()}
    assert severities["items add up to the order total"] == "warn"


def test_mart_checks(shop):
    tables = {
        "dim_customers": core.dim_customers(shop, P),
        "fct_orders": core.fct_orders(shop, P),
        "mart_product_performance": core.mart_product_performance(shop, P),
    }
    text = {name: MART_CHECKS[name] for name in tables}
    got = dq.run_checks(tables, parse_checks(text, P.as_of))
    found = {(r["table"], r["check"]): r["failures"] for r in got.collect()}
    assert found[("dim_customers", "unique customer_id")] == 0
    assert found[("fct_orders", "type(date) order_date")] == 0
    assert found[("fct_orders", "email_regex customer_email")] == 3
    assert found[("fct_orders", "subtotal_bounds subtotal")] == 2


def test_number_of_declared_checks():
    assert len(all_checks(date(2023, 1, 1))) == 141


def test_text_keys_are_compared_as_bytes(spark):
    """Hex digits, other text and numbers as keys; text against numbers as before."""
    a = spark.createDataFrame([("ab",), ("ab",), ("AB",), ("5",), ("x",), (None,)], "k string")
    b = spark.createDataFrame([("ab",), ("x",)], "k string")
    n = spark.createDataFrame([(5,), (6,)], "k bigint")
    own = dq.Check("a", "unique", key=("k",))
    text = dq.Check("a", "known", key=("k",), parent=("b", "k"))
    digits = spark.createDataFrame([("5",), ("7",)], "k string")
    mixed = dq.Check("a", "numbered", key=("k",), parent=("n", "k"))
    found = dq.run_checks({"a": a, "b": b, "n": n}, [own, text])
    assert {r["check"]: r.failures for r in found.collect()} == {"unique": 1, "known": 2}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "unhex" in plan
    found = dq.run_checks({"a": digits, "n": n}, [mixed])
    assert [r.failures for r in found.collect()] == [1]


def test_all_checks_write_returns_and_marts_only(spark, monkeypatch):
    from orderlens import catalog

    names = []
    monkeypatch.setattr(catalog, "checked", lambda tables, checks, write: names.extend(write) or tables["raw_returns"])
    catalog.QUERIES["dq_all"](spark, "/root/testdata/sf0.001")
    assert "raw_order_items" not in names and "stg_order_items" not in names
    assert "fct_order_items" in names


@pytest.mark.parametrize("few, bits", [(10_000, 48), (10_000, 1), (0, 48), (0, 1)])
def test_settled_checks_find_the_same(spark, monkeypatch, few, bits):
    """Keys are compared themselves wherever hashes are equal, by chance or not."""
    monkeypatch.setattr(dq, "FEW_HASHES", few)
    monkeypatch.setattr(dq, "HASH_BITS", bits)
    ids = [f"{i:032x}" for i in range(50)] + ["ab", "AB", None, None]
    a = spark.createDataFrame([(i, 1) for i in [*ids, ids[7], ids[7], "ab"]], "k string, n int")
    b = spark.createDataFrame([(i, 2) for i in ids], "k string, n int")
    tables = {"a": a, "b": b}
    checks = [
        dq.Check("a", "unique", key=("k",)),
        dq.Check("b", "unique", key=("k",)),
        dq.Check("a", "pairs", key=("k", "n"), skip_null=False),
        dq.Check("b", "unique n", key=("n",)),
        dq.Check("a", "known", key=("n",), parent=("b", "n")),
        dq.Check("a", "not null", rule=dq.is_null("k")),
        dq.Check("b", "counted", rows=lambda t: t["b"].filter("n > 1"), severity="warn"),
    ]
    want = {
        ("a", "unique"): 2, ("b", "unique"): 0, ("a", "pairs"): 3, ("b", "unique n"): 1,
        ("a", "known"): 57, ("a", "not null"): 2, ("b", "counted"): 54,
    }
    for settled in (False, True):
        found = dq.run_checks(tables, checks, settled=settled).collect()
        assert {(r["table"], r["check"]): r["failures"] for r in found} == want


def test_settled_checks_hold_no_shuffle(spark):
    """The results are tables: to read them moves nothing."""
    a = spark.range(100).selectExpr("md5(string(id % 90)) AS k")
    found = dq.run_checks({"a": a}, [dq.Check("a", "unique", key=("k",))], settled=True)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert [r["failures"] for r in found.collect()] == [10]
