"""The four weekly top-k reports.

All four share one shape: filter -> ``top_k_per_group`` by store ->
project.  Ties in the ranking value are broken by ``product_id`` so the
k-th place is deterministic.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.functions import exact_avg, round2
from pricelens.operators.dates import latest_date
from pricelens.operators.joins import join_checked, materialise_small
from pricelens.operators.topk import top_k_per_group
from pricelens.schemas import (
    DEALS_COLUMNS, DECREASES_COLUMNS, DISCOUNTS_COLUMNS, INCREASES_COLUMNS,
)

DEFAULT_K = 20
TIE_BREAK = ["product_id"]


def _ranked(df: DataFrame, order, k: int, columns: list[str]) -> DataFrame:
    ranked = top_k_per_group(df, "store", order, k, tie_break=TIE_BREAK)
    return ranked.select(*columns).orderBy("store", "rank")


def list_price_increases(pc: DataFrame, k: int = DEFAULT_K) -> DataFrame:
    """Largest relative list-price increases per store."""
    df = pc.where(F.col("list_price") > F.col("prev_list_price")).withColumns({
        "current_list_price": F.col("list_price"),
        "price_increase": F.col("list_price_diff"),
        "pct_increase": round2("list_price_pct_change"),
    })
    return _ranked(df, [F.col("list_price_pct_change").desc()], k, INCREASES_COLUMNS)


def list_price_decreases(pc: DataFrame, k: int = DEFAULT_K) -> DataFrame:
    """Largest relative list-price decreases per store (available products only)."""
    drop = (F.col("prev_list_price") - F.col("list_price")) / F.col("prev_list_price")
    df = (pc.where((F.col("prev_list_price") > 0) & (F.col("list_price") < F.col("prev_list_price"))
                   & F.col("is_available"))
          .withColumns({
              "current_list_price": F.col("list_price"),
              "price_decrease": F.col("prev_list_price") - F.col("list_price"),
              "pct_decrease": round2((F.col("prev_list_price") - F.col("list_price"))
                                     / F.col("prev_list_price") * 100),
              "_drop": drop,
          }))
    return _ranked(df, [F.col("_drop").desc()], k, DECREASES_COLUMNS)


def discounts(pc: DataFrame, k: int = DEFAULT_K) -> DataFrame:
    """Largest sale-price drops that are below the list price, per store."""
    df = (pc.where((F.col("price") < F.col("prev_price")) & (F.col("price") < F.col("list_price")))
          .withColumns({
              "current_price": F.col("price"),
              "price_decrease": -F.col("price_diff"),
              "pct_decrease": round2(-F.col("price_pct_change")),
          }))
    return _ranked(df, [F.col("price_pct_change").asc()], k, DISCOUNTS_COLUMNS)


def avg_price_30d(products: DataFrame, latest: _dt.date | None = None, days: int = 30) -> DataFrame:
    """Rounded average sale price per (product_id, store) over [latest - days, latest).

    ``latest`` is resolved to a literal first, so the range is a static
    partition filter; the aggregate is partial + final (map-side combine),
    which absorbs hot keys before the shuffle.
    """
    if latest is None:
        latest = latest_date(products)
    base = products.select("product_id", "store", "scrape_date", "price")
    if latest is None:
        base = base.where(F.lit(False))
    else:
        lo = latest - _dt.timedelta(days=days)
        base = base.where((F.col("scrape_date") >= F.lit(lo)) & (F.col("scrape_date") < F.lit(latest)))
    return base.groupBy("product_id", "store").agg(round2(exact_avg("price")).alias("avg_price_30d"))


def avg_deals_30d(products: DataFrame, k: int = DEFAULT_K, days: int = 30,
                  latest: _dt.date | None = None) -> DataFrame:
    """Products priced furthest below their trailing ``days``-day average, per store.

    The average is rounded before it is compared, ranked and turned into
    a percentage.  Plan, narrow first:

    1. latest snapshot (available rows) projected to (product_id, store,
       price) joins the aggregate on (product_id, store); the aggregate's
       hash partitioning is reused, so only narrow latest rows shuffle;
    2. top k per store (partial ``WindowGroupLimit`` before the shuffle),
       materialised: at most k rows per store;
    3. the wide display columns (name, brand, link, image) are fetched for
       those winners only, by a size-checked broadcast join over a
       streamed scan of the latest snapshot (no shuffle of text columns).
    """
    if latest is None:
        latest = latest_date(products)
    avg = avg_price_30d(products, latest, days)
    cur = products.select("product_id", "store", "name", "brand", "link", "image", "price",
                          "scrape_date", "is_available")
    if latest is None:
        cur = cur.where(F.lit(False))
    else:
        cur = cur.where((F.col("scrape_date") == F.lit(latest)) & F.col("is_available"))
    gap = (F.col("avg_price_30d") - F.col("price")) / F.col("avg_price_30d")
    cand = (cur.select("product_id", "store", "price").join(avg, ["product_id", "store"])
            .where((F.col("avg_price_30d") > 0) & (F.col("price") < F.col("avg_price_30d")))
            .withColumns({
                "current_price": F.col("price"),
                "pct_discount": round2((F.col("avg_price_30d") - F.col("price"))
                                       / F.col("avg_price_30d") * 100),
                "_gap": gap,
            }))
    top = materialise_small(top_k_per_group(cand, "store", [F.col("_gap").desc()], k,
                                            tie_break=TIE_BREAK)
                            .select("product_id", "store", "current_price", "avg_price_30d",
                                    "pct_discount", "rank"))
    wide = cur.select("product_id", "store", "name", "brand", "link", "image")
    return (join_checked(wide, top, ["product_id", "store"], "inner", materialised=True)
            .select(*DEALS_COLUMNS).orderBy("store", "rank"))
