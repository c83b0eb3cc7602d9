"""The whole weekly refresh as one Spark application.

products table -> price_changes (materialised) -> four reports (run
concurrently, each materialised: at most k rows per store) -> the four
histories from ONE products scan -> dashboard feed.  Every intermediate
is written under ``out`` (a shared folder), which also cuts lineage: a
lost executor recomputes from the last written table, not from the raw
scan.
"""

from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens import operators as ops
from pricelens.operators.dates import latest_date, latest_dates
from pricelens.sources.products import materialise, read_products, snapshot_dates
from pricelens.sources.reports_io import write_csv

REPORT_NAMES = ["list_price_increases", "list_price_decreases", "discounts", "avg_deals_30d"]


def _join(out: str, *p: str) -> str:
    return "/".join([out.rstrip("/"), *p]) if "://" in out else os.path.join(out, *p)


def refresh(spark: SparkSession, root: str, out: str, k: int = 20, csv: bool = True,
            products: DataFrame | None = None) -> dict[str, DataFrame]:
    """Recompute every derived table from the products table at ``root``.

    Returns the materialised frames: price_changes, the four reports,
    ``histories`` (tagged by report) and ``feed``.
    """
    products = products if products is not None else read_products(spark, root)
    dates = snapshot_dates(spark, root, 2) if root else latest_dates(products, 2)
    pc = materialise(ops.price_changes(products, dates), _join(out, "price_changes"))
    latest = dates[0] if dates else latest_date(products)
    builders = {
        "list_price_increases": lambda: ops.list_price_increases(pc, k),
        "list_price_decreases": lambda: ops.list_price_decreases(pc, k),
        "discounts": lambda: ops.discounts(pc, k),
        "avg_deals_30d": lambda: ops.avg_deals_30d(products, k, latest=latest),
    }

    def run(name: str) -> tuple[str, DataFrame]:
        df = materialise(builders[name](), _join(out, "reports", name))
        if csv:
            write_csv(df.orderBy("store", "rank"), _join(out, "csv", name), single_file=True)
        return name, df

    with ThreadPoolExecutor(max_workers=len(REPORT_NAMES)) as pool:
        reports = dict(pool.map(run, REPORT_NAMES))
    hist_path = _join(out, "histories")
    # static overwrite: the whole histories table is replaced, so a report that is empty
    # this run leaves no stale partition behind (the session default is dynamic)
    histories = ops.histories(reports, products)
    (histories.write.mode("overwrite")
     .option("partitionOverwriteMode", "static").partitionBy("report").parquet(hist_path))
    # declared schema: empty reports (a first run, or no change) write no file to infer one from
    hist = spark.read.schema(histories.schema).parquet(hist_path)
    entries = ops.report_entries(reports)
    feed = (entries.join(hist, ["report", "product_id", "store"], "left").drop("report")
            .orderBy("tab", "store", "rank", "scrape_date"))
    feed = materialise(feed, _join(out, "feed"))
    if csv:
        def history_csv(name: str) -> None:
            write_csv(hist.where(F.col("report") == name).drop("report")
                      .orderBy("product_id", "store", "scrape_date"),
                      _join(out, "csv", f"{name}_history"))

        # independent small jobs (partition-pruned reads of one report each): run together
        with ThreadPoolExecutor(max_workers=len(REPORT_NAMES)) as pool:
            list(pool.map(history_csv, REPORT_NAMES))
    return {"price_changes": pc, **reports, "histories": hist, "feed": feed}
