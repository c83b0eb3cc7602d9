"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf"}.
Each query is executed to completion with the ``noop`` sink (no collect).
The weekly panel is first written to the partitioned products table
(timed as ``ingest_weekly``); report queries then read that table, so
their date filters are partition filters, as in production.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from pricelens import operators as ops  # noqa: E402
from pricelens.plans import compose, panels  # noqa: E402
from pricelens.plans.refresh import refresh  # noqa: E402
from pricelens.session import get_session, work_path  # noqa: E402
from pricelens.sources import html as H  # noqa: E402
from pricelens.sources import normalise as N  # noqa: E402
from pricelens.sources import products as P  # noqa: E402
from pricelens.sources.sitemap import url_hierarchy  # noqa: E402
from pricelens.streaming.refresh_stream import land, stream_refresh  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session(f"local[{cpus}]", max(8, 2 * cpus), app_name="pricelens-bench",
                        driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
    spark.sparkContext.setLogLevel("ERROR")
    # Local-scale sizing: inputs here are a few MB, so let AQE keep partitions down to 256 KB
    # (default 1 MB) -- otherwise every stage, including the partitioned writers, collapses
    # into one serial task.  On a cluster the defaults apply.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256k")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    run_dir = uuid.uuid4().hex          # every output of this run lives under bench/<run_dir>
    root = work_path(spark, "bench", run_dir, "products")
    out = work_path(spark, "bench", run_dir, "out")
    times: dict[str, float] = {}
    # untimed warm-up: JVM start, first codegen, file listing of the inputs
    for name in ("lineitem", "part", "events", "pages"):
        panels.table(spark, sf_dir, name).limit(1).collect()
    run(panels.panel_b(spark, sf_dir))

    def timed(name, fn):
        t0 = time.perf_counter()
        fn()
        times[name] = round(time.perf_counter() - t0, 3)

    timed("ingest_weekly", lambda: P.write_products(panels.panel_b(spark, sf_dir), root))
    products = P.read_products(spark, root)
    dates = P.snapshot_dates(spark, root, 2)      # directory listing, no job
    timed("price_changes", lambda: run(ops.price_changes(products, dates)))
    pc = ops.price_changes(products, dates)
    timed("list_price_increases", lambda: run(ops.list_price_increases(pc)))
    timed("list_price_decreases", lambda: run(ops.list_price_decreases(pc)))
    timed("discounts", lambda: run(ops.discounts(pc)))
    timed("avg_deals_30d", lambda: run(ops.avg_deals_30d(products, latest=dates[0])))

    def four_histories():
        reports = {"list_price_increases": ops.list_price_increases(pc),
                   "list_price_decreases": ops.list_price_decreases(pc),
                   "discounts": ops.discounts(pc),
                   "avg_deals_30d": ops.avg_deals_30d(products, latest=dates[0])}
        run(ops.dashboard_feed(reports, products))

    timed("dashboard_feed", four_histories)
    timed("refresh_all", lambda: refresh(spark, root, out, csv=True, products=products))
    daily = panels.panel_a(spark, sf_dir)
    timed("daily_price_changes", lambda: run(ops.price_changes(daily)))
    timed("daily_avg_deals_30d", lambda: run(ops.avg_deals_30d(daily)))

    daily_root = work_path(spark, "bench", run_dir, "daily")
    P.write_products(panels.panel_a(spark, sf_dir, pick="first"), daily_root)
    timed("upsert_daily", lambda: P.upsert_products(daily, daily_root))
    landing = work_path(spark, "bench", run_dir, "landing")
    land(panels.panel_a(spark, sf_dir, pick="first").withColumn("ingest_seq", F.lit(1).cast("long")), landing)
    land(daily.withColumn("ingest_seq", F.lit(2).cast("long")), landing)
    timed("stream_refresh", lambda: stream_refresh(
        spark, landing, work_path(spark, "bench", run_dir, "streamed"),
        work_path(spark, "bench", run_dir, "ckpt")))

    def catalog_a():
        docs = N.parse_json(compose.catalog_a_docs(spark, sf_dir), "json", N.CATALOG_A_PRODUCT)
        sims = N.simulated_prices(N.parse_json(compose.simulation_docs(spark, sf_dir), "json",
                                               N.SIMULATION_A))
        run(N.apply_simulation(N.catalog_a_rows(docs, "store_a"), sims))

    timed("normalise_catalog_a", catalog_a)
    timed("normalise_catalog_b", lambda: run(N.normalise(
        compose.catalog_b_docs(spark, sf_dir), "catalog_b", "store_b", json_col="json")))
    pages = panels.table(spark, sf_dir, "pages")
    timed("url_hierarchy", lambda: run(url_hierarchy(
        pages.select(F.col("page_id").alias("url_index"), "url"), "pages")))
    timed("html_links", lambda: run(H.page_links(pages)))
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_query_sec", "value": total, "unit": "sec",
                      "queries": times, "sf": sf, "settings": {k: spark.conf.get(k) for k in (
                          "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.minPartitionSize")}}))
    P._delete_path(spark, work_path(spark, "bench", run_dir))   # this run's scratch only
    spark.stop()


if __name__ == "__main__":
    main()
