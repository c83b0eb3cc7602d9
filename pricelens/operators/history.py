"""Full price history of the products a report lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.operators.joins import join_checked, materialise_small
from pricelens.schemas import HISTORY_COLUMNS

# Report name -> dashboard tab, whether it is an increase,
# and the report columns shown as "before" and "after".
REPORT_TABS = {
    "list_price_increases": ("list_increase", True, "prev_list_price", "current_list_price", "pct_increase"),
    "list_price_decreases": ("list_decrease", False, "prev_list_price", "current_list_price", "pct_decrease"),
    "discounts": ("price_decrease", False, "prev_price", "current_price", "pct_decrease"),
    "avg_deals_30d": ("best_deals", False, "avg_price_30d", "current_price", "pct_discount"),
}

KEY = ["product_id", "store"]

#: Most product ids that are put into the scan as literals; longer lists only join.
MAX_LITERALS = 500


def pruned(products: DataFrame, keys: DataFrame, max_literals: int = MAX_LITERALS) -> DataFrame:
    """``products`` filtered by the stores and product ids of ``keys``, a superset of what a join on them keeps.

    The values are literals: stores prune partition folders, ids reach the
    Parquet scan, which skips row groups (the writer sorts files by
    product_id).  A report lists at most k products a store, so ``keys``
    is small; beyond ``max_literals`` ids only the stores are used, and
    beyond as many stores nothing.  ``keys`` should be a written frame, as
    it is read three times with this.
    """
    for column in ("store", "product_id"):
        values = [r[0] for r in keys.select(column).distinct().limit(max_literals + 1).collect()]
        if len(values) <= max_literals:
            products = products.where(F.col(column).isin(sorted(v for v in values if v is not None)))
    return products


def history(report: DataFrame, products: DataFrame) -> DataFrame:
    """Every snapshot (all dates, available or not) of the report's products.

    A left-semi join against the report's distinct keys; the key set is a
    top-k result (k rows per store), written once, put into the products
    scan as literals and broadcast after a size check, so only row groups
    that may hold its products are read, with no shuffle.
    """
    keys = materialise_small(report.select(*KEY).distinct())
    scan = pruned(products.select(*HISTORY_COLUMNS), keys)
    return (join_checked(scan, keys, KEY, "left_semi", materialised=True)
            .orderBy("product_id", "store", "scrape_date"))


def histories(reports: dict[str, DataFrame], products: DataFrame) -> DataFrame:
    """Histories of several reports from ONE products scan.

    The reports' keys are tagged with the report name and unioned; a
    product listed by two reports yields its history once per report.
    """
    tagged = [r.select(*KEY).distinct().withColumn("report", F.lit(name))
              for name, r in reports.items()]
    keys = materialise_small(reduce(DataFrame.unionByName, tagged))
    scan = pruned(products.select(*HISTORY_COLUMNS), keys)
    return (join_checked(scan, keys, KEY, "inner", materialised=True)
            .select("report", *HISTORY_COLUMNS))
