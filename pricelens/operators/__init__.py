"""Relational operators of the price panel (DataFrame -> DataFrame)."""

from pricelens.operators.dates import distinct_dates, latest_date, latest_dates
from pricelens.operators.changes import price_changes
from pricelens.operators.topk import top_k_per_group
from pricelens.operators.reports import (
    avg_deals_30d, avg_price_30d, discounts, list_price_decreases, list_price_increases,
)
from pricelens.operators.history import REPORT_TABS, histories, history
from pricelens.operators.feed import dashboard_feed, report_entries, report_stores, with_labels
from pricelens.operators.upsert import dedup_latest
from pricelens.operators.checks import change_violations, report_violations
from pricelens.operators.categories import select_categories

__all__ = [
    "distinct_dates", "latest_date", "latest_dates", "price_changes", "top_k_per_group",
    "avg_deals_30d", "avg_price_30d", "discounts", "list_price_decreases",
    "list_price_increases", "REPORT_TABS", "histories", "history", "dashboard_feed",
    "report_entries", "report_stores", "with_labels", "dedup_latest", "change_violations", "report_violations",
    "select_categories",
]
