"""Dashboard feed: every report row with its price series, ready to plot."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.functions import change_label, escape_html, image_or_placeholder, link_or_hash
from pricelens.operators.history import KEY, REPORT_TABS, pruned
from pricelens.operators.joins import join_checked, materialise_small
from pricelens.schemas import HISTORY_COLUMNS


def report_entries(reports: dict[str, DataFrame]) -> DataFrame:
    """Unify the four reports to (tab, is_increase, store, rank, product, before, after, pct_change)."""
    parts = []
    for name, df in reports.items():
        tab, is_increase, before, after, pct = REPORT_TABS[name]
        parts.append(df.select(
            F.lit(tab).alias("tab"), F.lit(is_increase).alias("is_increase"),
            "store", F.col("rank").cast("int").alias("rank"), "product_id",
            escape_html(F.coalesce(F.col("name"), F.lit(""))).alias("name"),
            escape_html(F.coalesce(F.col("brand"), F.lit(""))).alias("brand"),
            image_or_placeholder(F.col("image")).alias("image"),
            link_or_hash(F.col("link")).alias("link"),
            F.col(before).alias("before"), F.col(after).alias("after"),
            F.col(pct).alias("pct_change"),
            F.lit(name).alias("report"),
        ))
    return reduce(DataFrame.unionByName, parts)


def report_stores(report: DataFrame) -> DataFrame:
    """The distinct stores of a report, sorted (one tab section per store)."""
    return report.select("store").distinct().orderBy("store")


def with_labels(entries: DataFrame) -> DataFrame:
    """add the display text of each report entry."""
    return entries.withColumn("label", change_label("is_increase", "pct_change", "before", "after"))


def dashboard_feed(reports: dict[str, DataFrame], products: DataFrame, labels: bool = False) -> DataFrame:
    """Report rows x their history points (flat; one row per plotted point).

    A product without history keeps one row with NULL point columns.  The
    series is not collected into arrays: it stays one row per snapshot,
    ordered by (tab, store, rank, scrape_date).  ``labels`` adds each
    entry's display text.
    """
    entries = materialise_small(report_entries(reports))
    # keys come from the already materialised entries: no second checkpoint needed
    keys = entries.select("report", *KEY).distinct()
    hist = join_checked(pruned(products.select(*HISTORY_COLUMNS), keys), keys, KEY, "inner", materialised=True)
    if labels:
        entries = with_labels(entries)
    return (entries.join(hist, ["report", *KEY], "left")
            .drop("report")
            .orderBy("tab", "store", "rank", "scrape_date"))
