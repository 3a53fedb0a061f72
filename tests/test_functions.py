from datetime import date

import pytest
from pyspark.sql import functions as F

from orderlens import Params
from orderlens import functions as fn

P = Params(as_of=date(2023, 7, 1))


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("email", "domain"),
    [("a@b.com", "b.com"), ("nobody", ""), ("a@b@c", "b"), ("", ""), (None, None)],
)
def test_email_domain(spark, email, domain):
    assert value(spark, fn.email_domain(F.lit(email).cast("string"))) == domain


@pytest.mark.parametrize(
    ("country", "region"),
    [
        ("USA", "North America"),
        ("Canada", "North America"),
        ("UK", "Europe"),
        ("Australia", "Asia Pacific"),
        ("France", "Other"),
        (None, "Other"),
    ],
)
def test_map_values(spark, country, region):
    assert value(spark, fn.map_values(F.lit(country).cast("string"), P.regions)) == region


@pytest.mark.parametrize(
    ("unit", "expected"),
    [
        ("day", date(2023, 5, 17)),
        ("week", date(2023, 5, 15)),
        ("month", date(2023, 5, 1)),
        ("quarter", date(2023, 4, 1)),
        ("year", date(2023, 1, 1)),
    ],
)
def test_date_trunc(spark, unit, expected):
    assert value(spark, fn.date_trunc(unit, F.lit(date(2023, 5, 17)))) == expected


@pytest.mark.parametrize(
    ("unit", "expected"), [("day", 31), ("week", 31 / 7), ("month", 1), ("year", 1)]
)
def test_date_diff(spark, unit, expected):
    start, end = F.lit(date(2022, 12, 31)), F.lit(date(2023, 1, 31))
    assert value(spark, fn.date_diff(start, end, unit)) == expected


def test_unknown_units_raise():
    with pytest.raises(ValueError):
        fn.date_diff(F.lit(1), F.lit(2), "hour")
    with pytest.raises(ValueError):
        fn.date_trunc("hour", F.lit(1))


def test_calendar_names(spark):
    sunday = F.lit(date(2023, 1, 1))
    assert value(spark, fn.day_of_week(sunday)) == 0
    assert value(spark, fn.period_end("week", sunday)) == date(2023, 1, 1)
    assert value(spark, fn.period_end("month", F.lit(date(2024, 2, 3)))) == date(2024, 2, 29)
    assert value(spark, fn.period_end("quarter", sunday)) == date(2023, 3, 31)
    assert value(spark, fn.year_quarter(sunday)) == "2023-Q1"


def test_safe_divide(spark):
    assert value(spark, fn.safe_divide(F.lit(1), F.lit(4))) == 0.25
    assert value(spark, fn.safe_divide(F.lit(1), F.lit(0))) == 0
    assert value(spark, fn.safe_divide(F.lit(1), F.lit(None).cast("int"), default=-1)) == -1
    assert value(spark, fn.safe_divide(F.lit(1), F.lit(0), default=None)) is None


def test_pct_change(spark):
    assert value(spark, fn.pct_change(F.lit(15), F.lit(10))) == 50
    assert value(spark, fn.pct_change(F.lit(15), F.lit(0))) is None
    assert value(spark, fn.pct_change(F.lit(15), F.lit(-3))) is None


@pytest.mark.parametrize(
    ("number", "digits", "expected"), [(2.5, 0, 3), (-2.5, 0, -3), (1.125, 2, 1.13), (7.0, 2, 7)]
)
def test_round_half_away_from_zero(spark, number, digits, expected):
    assert value(spark, fn.round_to(F.lit(number), digits)) == expected


def test_cents(spark):
    assert float(value(spark, fn.cents_to_dollars(F.lit(1234)))) == 12.34
    assert value(spark, fn.dollars_to_cents(F.lit(12.34))) == 1234


def test_surrogate_key_marks_null(spark):
    import hashlib

    key = value(spark, fn.surrogate_key(F.lit(1), F.lit(None).cast("string")))
    assert key == hashlib.md5(b"1-_dbt_utils_surrogate_key_null_").hexdigest()


@pytest.mark.parametrize(
    ("revenue", "orders", "tier"),
    [
        (500, 3, "VIP"),
        (500, 2, "Loyal"),
        (10, 2, "Loyal"),
        (200, 1, "Loyal"),
        (10, 1, "Active"),
        (0, 0, "New"),
        (None, None, "New"),
    ],
)
def test_customer_tier(spark, revenue, orders, tier):
    column = fn.customer_tier(F.lit(revenue).cast("int"), F.lit(orders).cast("int"), P)
    assert value(spark, column) == tier


@pytest.mark.parametrize(
    ("last", "status"),
    [
        (date(2023, 6, 1), "Active"),
        (date(2023, 5, 31), "At Risk"),
        (date(2023, 4, 2), "At Risk"),
        (date(2023, 4, 1), "Churned"),
        (None, "Never Ordered"),
    ],
)
def test_activity_status(spark, last, status):
    column = F.lit(last).cast("date")
    assert value(spark, fn.activity_status(column, column, P)) == status


@pytest.mark.parametrize(
    ("scores", "segment", "action"),
    [
        ((5, 5, 5), "Champions", "Reward them, make them brand advocates"),
        ((4, 4, 3), "Loyal Customers", "Reward them, make them brand advocates"),
        ((4, 3, 1), "Loyal Customers", "Upsell higher value products"),
        ((4, 2, 5), "New Customers", "Build relationship, offer onboarding"),
        ((3, 3, 3), "Potential Loyalists", "Offer membership/loyalty program"),
        ((3, 1, 4), "Big Spenders", "Monitor and engage"),
        ((3, 1, 1), "Other", "Monitor and engage"),
        ((2, 4, 1), "At Risk", "Send personalized reactivation campaigns"),
        ((1, 2, 1), "Hibernating", "Offer comeback promotions"),
        ((1, 1, 5), "Lost", "Revive interest with aggressive offers"),
    ],
)
def test_rfm_rules(spark, scores, segment, action):
    columns = [F.lit(s) for s in scores]
    assert value(spark, fn.rfm_segment_name(*columns)) == segment
    assert value(spark, fn.rfm_action(*columns)) == action


def test_concat_code(spark):
    assert value(spark, fn.concat_code(F.lit(5), F.lit(1), F.lit(3))) == "513"
    assert value(spark, fn.concat_code(F.lit(5), F.lit(None).cast("int"))) is None


def test_packed_text(spark):
    texts = [None, "", "ab", "AB", "aB", "abc", "00ff", "zz", "ab\n", "\x01", "é", "ab ", "d41d8cd98f00b204e9800998ecf8427e"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("b", fn.packed(F.col("t")))
    back = df.select("t", "b", fn.unpacked(F.col("b")).alias("back")).collect()
    assert [r.back for r in back] == texts
    assert len({bytes(r.b) for r in back if r.b is not None}) == len(texts) - 1
    assert len(back[-1].b) == 17
