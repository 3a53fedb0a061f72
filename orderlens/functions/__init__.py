"""Scalar building blocks: plain functions from Column to Column."""

from orderlens.functions.classify import (
    activity_status,
    customer_tier,
    map_values,
    performance_tier,
    retention_health,
    rfm_action,
    rfm_segment_name,
)
from orderlens.functions.dates import (
    date_diff,
    date_trunc,
    day_of_week,
    period_end,
    year_quarter,
)
from orderlens.functions.numeric import (
    cents_to_dollars,
    dollars_to_cents,
    money_avg,
    pct_change,
    pct_of,
    ratio,
    round_to,
    safe_divide,
    zero_if_null,
)
from orderlens.functions.text import concat_code, email_domain, packed, surrogate_key, unpacked

__all__ = [
    "activity_status",
    "cents_to_dollars",
    "concat_code",
    "customer_tier",
    "date_diff",
    "date_trunc",
    "day_of_week",
    "dollars_to_cents",
    "email_domain",
    "map_values",
    "money_avg",
    "packed",
    "pct_change",
    "pct_of",
    "performance_tier",
    "period_end",
    "ratio",
    "retention_health",
    "rfm_action",
    "rfm_segment_name",
    "round_to",
    "safe_divide",
    "surrogate_key",
    "unpacked",
    "year_quarter",
    "zero_if_null",
]
