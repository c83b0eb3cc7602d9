"""price_changes: what changed between the two latest snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelens.functions import pct_change
from pricelens.operators.dates import latest_dates
from pricelens.schemas import ANALYSIS_COLUMNS

KEY = ["product_id", "store"]


def _derive(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "list_price_diff": F.col("list_price") - F.col("prev_list_price"),
        "list_price_pct_change": pct_change("list_price", "prev_list_price"),
        "price_diff": F.col("price") - F.col("prev_price"),
        "price_pct_change": pct_change("price", "prev_price"),
    })


def _changed() -> F.Column:
    return (F.col("is_available") & (F.col("prev_list_price") > 0) & (F.col("prev_price") > 0)
            & ((F.col("list_price_diff") != 0) | (F.col("price_diff") != 0)))


def price_changes(products: DataFrame, dates: list | None = None, method: str = "join") -> DataFrame:
    """Rows of the latest snapshot whose list or sale price moved since the previous one.

    Semantics: only the two latest snapshot dates (global, not per store)
    are read; previous values are those of the same (product_id, store) on
    the earlier date; the row must be available, have positive previous
    prices and a change.  The key (product_id, store, scrape_date) is
    unique in the table (the upsert enforces it).

    ``method="join"`` (default): latest snapshot (available rows only)
    joined with the previous snapshot projected to 4 narrow columns and
    filtered to positive prices.  Both filters reach the Parquet scan,
    and the shuffle carries the wide text columns for one snapshot only.
    ``method="lag"``: the literal formulation, ``lag`` over
    (product_id, store) ordered by date, one shuffle of both snapshots.
    Either way each key holds at most two rows, so no group can be hot.
    """
    if dates is None:
        dates = latest_dates(products, 2)
    snap = products.select(*ANALYSIS_COLUMNS)
    if len(dates) < 2:
        # fewer than two snapshots: nothing has a previous value
        return _derive(snap.withColumns({"prev_list_price": F.lit(None).cast("double"),
                                         "prev_price": F.lit(None).cast("double")})
                       ).where(F.lit(False))
    latest, prev = sorted(dates)[-1], sorted(dates)[-2]
    if method == "lag":
        w = Window.partitionBy(*KEY).orderBy("scrape_date")
        out = _derive(snap.where(F.col("scrape_date").isin([prev, latest])).withColumns({
            "prev_list_price": F.lag("list_price").over(w),
            "prev_price": F.lag("price").over(w),
        }))
        return out.where((F.col("scrape_date") == F.lit(latest)) & _changed())
    cur = snap.where((F.col("scrape_date") == F.lit(latest)) & F.col("is_available"))
    before = (products.where(F.col("scrape_date") == F.lit(prev))
              .where((F.col("list_price") > 0) & (F.col("price") > 0))
              .select(*KEY, F.col("list_price").alias("prev_list_price"),
                      F.col("price").alias("prev_price")))
    return _derive(cur.join(before, KEY)).where(_changed()).select(
        *ANALYSIS_COLUMNS, "prev_list_price", "prev_price", "list_price_diff",
        "list_price_pct_change", "price_diff", "price_pct_change")
