"""Business thresholds and run settings, passed explicitly to every plan."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date, datetime

# The store's default groupings.
CATEGORY_GROUPS = {
    "Electronics": "Tech",
    "Furniture": "Home & Office",
    "Office": "Home & Office",
    "Home": "Home & Office",
}
REGIONS = {
    "USA": "North America",
    "Canada": "North America",
    "UK": "Europe",
    "Australia": "Asia Pacific",
}
REASON_CATEGORIES = {
    "defective": "Quality Issue",
    "damaged_shipping": "Quality Issue",
    "wrong_item": "Fulfillment Error",
    "changed_mind": "Customer Decision",
}
QUALITY_REASONS = ("defective", "damaged_shipping")


@dataclass(frozen=True)
class Params:
    """Everything a plan needs besides its input tables.

    ``as_of`` replaces the wall clock, so a plan gives the same rows whenever it
    runs. ``run_ts`` adds load stamps (``_loaded_at`` / ``_updated_at``) when set.
    """

    as_of: date
    run_ts: datetime | None = None

    high_value_order: float = 200
    vip_revenue: float = 500
    vip_orders: int = 3
    loyal_revenue: float = 200
    loyal_orders: int = 2
    active_days: int = 30
    at_risk_days: int = 90

    star_revenue: float = 1000
    star_return_rate: float = 0.10
    strong_revenue: float = 500
    average_revenue: float = 100

    spine_start: date = date(2023, 1, 1)
    spine_end: date = date(2023, 12, 31)
    lookback_days: int = 3

    category_groups: Mapping[str, str] = field(default_factory=lambda: CATEGORY_GROUPS)
    region_source: str = "country"
    regions: Mapping[str, str] = field(default_factory=lambda: REGIONS)
