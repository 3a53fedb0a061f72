"""Rule tables turned into ``when`` chains. The order of the rules matters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderlens.functions.numeric import ratio
from orderlens.params import Params


def first_match(rules: Sequence[tuple[Column, str]], default: str) -> Column:
    """Label of the first rule that holds; a NULL condition does not hold."""
    chain = F.lit(default)
    for condition, label in reversed(rules):
        chain = F.when(condition, F.lit(label)).otherwise(chain)
    return chain


def map_values(value: Column, mapping: Mapping[str, str], default: str = "Other") -> Column:
    """Value -> group lookup; unknown and NULL values give ``default``."""
    members: dict[str, list[str]] = {}
    for source, group in mapping.items():
        members.setdefault(group, []).append(source)
    return first_match([(value.isin(vals), group) for group, vals in members.items()], default)


def customer_tier(revenue: Column, orders: Column, p: Params) -> Column:
    return first_match(
        [
            ((revenue >= p.vip_revenue) & (orders >= p.vip_orders), "VIP"),
            ((revenue >= p.loyal_revenue) | (orders >= p.loyal_orders), "Loyal"),
            (orders >= 1, "Active"),
        ],
        "New",
    )


def activity_status(first_order: Column, last_order: Column, p: Params) -> Column:
    as_of = F.lit(p.as_of)
    return first_match(
        [
            (first_order.isNull(), "Never Ordered"),
            (last_order >= F.date_sub(as_of, p.active_days), "Active"),
            (last_order >= F.date_sub(as_of, p.at_risk_days), "At Risk"),
        ],
        "Churned",
    )


def performance_tier(revenue: Column, returns: Column, units: Column, p: Params) -> Column:
    rate = ratio(returns, units)
    return first_match(
        [
            ((revenue >= p.star_revenue) & (rate < p.star_return_rate), "Star"),
            (revenue >= p.strong_revenue, "Strong"),
            (revenue >= p.average_revenue, "Average"),
            (revenue > 0, "Underperforming"),
        ],
        "No Sales",
    )


# Fixed values: (score ranges that must hold, label), first match wins. A range is
# (lowest, highest); a score that is not named may be anything from 1 to 5.
RFM_SEGMENTS = (
    ({"r": (4, 5), "f": (4, 5), "m": (4, 5)}, "Champions"),
    ({"r": (4, 5), "f": (3, 5)}, "Loyal Customers"),
    ({"r": (4, 5), "f": (1, 2)}, "New Customers"),
    ({"r": (3, 5), "f": (3, 5), "m": (3, 5)}, "Potential Loyalists"),
    ({"r": (3, 5), "m": (4, 5)}, "Big Spenders"),
    ({"r": (1, 2), "f": (4, 5)}, "At Risk"),
    ({"r": (1, 2), "f": (2, 5)}, "Hibernating"),
    ({"r": (1, 2), "f": (1, 2)}, "Lost"),
)
RFM_SEGMENT_DEFAULT = "Other"
RFM_ACTIONS = (
    ({"r": (4, 5), "f": (4, 5)}, "Reward them, make them brand advocates"),
    ({"r": (4, 5), "f": (3, 5)}, "Upsell higher value products"),
    ({"r": (4, 5), "f": (1, 2)}, "Build relationship, offer onboarding"),
    ({"r": (3, 5), "f": (3, 5)}, "Offer membership/loyalty program"),
    ({"r": (1, 2), "f": (4, 5)}, "Send personalized reactivation campaigns"),
    ({"r": (1, 2), "f": (2, 5)}, "Offer comeback promotions"),
    ({"r": (1, 2), "f": (1, 2)}, "Revive interest with aggressive offers"),
)
RFM_ACTION_DEFAULT = "Monitor and engage"


def _score_rules(rules, recency: Column, frequency: Column, monetary: Column):
    scores = {"r": recency, "f": frequency, "m": monetary}
    out = []
    for ranges, label in rules:
        condition = F.lit(True)
        for name, (low, high) in ranges.items():
            condition = condition & scores[name].between(low, high)
        out.append((condition, label))
    return out


def rfm_segment_name(recency: Column, frequency: Column, monetary: Column) -> Column:
    return first_match(
        _score_rules(RFM_SEGMENTS, recency, frequency, monetary), RFM_SEGMENT_DEFAULT
    )


def rfm_action(recency: Column, frequency: Column, monetary: Column) -> Column:
    return first_match(_score_rules(RFM_ACTIONS, recency, frequency, monetary), RFM_ACTION_DEFAULT)


def retention_health(period: Column, retention_pct: Column) -> Column:
    return first_match(
        [
            (period == 0, "New"),
            (retention_pct >= 50, "Excellent"),
            (retention_pct >= 30, "Good"),
            (retention_pct >= 15, "Average"),
        ],
        "At Risk",
    )
