"""Command line for the weekly jobs (run with spark-submit or ``python -m pricelens``).

  refresh ROOT OUT [--k 20] [--no-csv]
      recompute price_changes, the four reports, histories and the feed
  ingest FORMAT PATH ROOT --store S --date YYYY-MM-DD [--sim PATH] [--quarantine PATH]
      normalise landed payloads (catalog_a | catalog_b) and upsert them;
      maincatid: first segment of the category path (catalog_a), the top
      category id (catalog_b); malformed lines go to the quarantine folder
  categories FORMAT PATH ROOT --store S --base-url U [--multiline] [--seq N] [--quarantine PATH]
      load landed category trees (tree_a | tree_b) into the stored categories
      table; of an id in several documents the one landed last counts
  sitemap PATH ROOT --store S
      load the category hierarchy of sitemap files into the stored table
  stream LANDING ROOT CHECKPOINT [--out OUT] [--completed]
      upsert every snapshot landed since the last run, then refresh OUT;
      with --completed only those whose completion marker has arrived
"""

from __future__ import annotations

import argparse
import uuid

from pyspark.sql import functions as F

from pricelens.functions import stamp_date
from pricelens.plans.refresh import refresh
from pricelens.session import get_session, work_path
from pricelens.sources import categories as C
from pricelens.sources import normalise as N
from pricelens.sources import products as P
from pricelens.sources.sitemap import read_sitemap, url_hierarchy
from pricelens.streaming.refresh_stream import stream_completed, stream_refresh


def _quarantined(spark, bad, path: str) -> int:
    """Write malformed lines out (Spark cannot query only the raw text of a JSON scan) and count them."""
    bad.write.mode("append").parquet(path)
    n = spark.read.parquet(path).count()
    if n:
        print(f"quarantined {n} malformed payload lines in {path}")
    return n


def _ingest(spark, a: argparse.Namespace) -> list:
    """Normalise landed payloads of one category and date, and upsert them; malformed lines go to quarantine."""
    schema, rows_of = N.NORMALISERS[a.format]
    docs, bad = N.read_landed(spark, a.path, schema)
    docs = docs.select("doc")
    held = a.quarantine or work_path(spark, "quarantine", f"{a.format}-{a.date}-{uuid.uuid4().hex}")
    if a.format == "catalog_a":
        sims, partial = None, False
        if a.sim:
            sim_docs, sim_bad = N.read_landed(spark, a.sim, N.SIMULATION_A)
            partial = _quarantined(spark, sim_bad, f"{held.rstrip('/')}-simulation") > 0
            sims = N.simulated_prices(sim_docs)
        rows = N.apply_simulation(N.catalog_a_rows(docs, a.store), sims, partial)
    else:
        rows = rows_of(docs, a.store)
    rows = P.with_maincatid(stamp_date(rows, a.date).withColumn("category_path", F.lit(a.category))).drop("category_path")
    if a.seq is not None:
        rows = rows.withColumn(P.SEQ, F.lit(a.seq).cast("long"))
    written = P.upsert_products(rows, a.root)
    _quarantined(spark, bad, held)
    return written


def _load_trees(spark, a: argparse.Namespace) -> list:
    """Normalise landed category trees and upsert them into the stored table; malformed documents go to quarantine."""
    schema, rows_of = N.NORMALISERS[a.format]
    docs, bad = N.read_landed(spark, a.path, schema, multiline=a.multiline)
    rows = rows_of(docs, a.store, base_url=a.base_url)
    if a.seq is not None:
        rows = rows.withColumn(P.SEQ, F.lit(a.seq).cast("long"))
    written = C.upsert_categories(rows, a.root)
    _quarantined(spark, bad, a.quarantine or work_path(spark, "quarantine", f"{a.format}-{uuid.uuid4().hex}"))
    return written


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="pricelens")
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("refresh")
    r.add_argument("root")
    r.add_argument("out")
    r.add_argument("--k", type=int, default=20)
    r.add_argument("--no-csv", action="store_true")
    i = sub.add_parser("ingest")
    i.add_argument("format", choices=["catalog_a", "catalog_b"])
    i.add_argument("path")
    i.add_argument("root")
    i.add_argument("--store", required=True)
    i.add_argument("--date", required=True)
    i.add_argument("--category", required=True, help="path of the scraped category; its first segment is the partition")
    i.add_argument("--seq", type=int, help="ingest_seq of these rows; default: their time of arrival")
    i.add_argument("--sim")
    i.add_argument("--quarantine")
    c = sub.add_parser("categories")
    c.add_argument("format", choices=["tree_a", "tree_b"])
    c.add_argument("path")
    c.add_argument("root")
    c.add_argument("--store", required=True)
    c.add_argument("--base-url", default="")
    c.add_argument("--multiline", action="store_true", help="a file is one document, not one a line")
    c.add_argument("--seq", type=int, help="ingest_seq of these rows; default: their time of arrival")
    c.add_argument("--quarantine")
    m = sub.add_parser("sitemap")
    m.add_argument("path")
    m.add_argument("root")
    m.add_argument("--store", required=True)
    s = sub.add_parser("stream")
    s.add_argument("--completed", action="store_true", help="LANDING holds snapshots and their completion markers")
    s.add_argument("landing")
    s.add_argument("root")
    s.add_argument("checkpoint")
    s.add_argument("--out")
    a = ap.parse_args(argv)
    spark = get_session()
    if a.cmd == "refresh":
        res = refresh(spark, a.root, a.out, k=a.k, csv=not a.no_csv)
        print({name: df.count() for name, df in res.items()})
    elif a.cmd == "ingest":
        print(f"wrote {len(_ingest(spark, a))} partitions")
    elif a.cmd == "categories":
        print(f"wrote {len(_load_trees(spark, a))} buckets")
    elif a.cmd == "sitemap":
        print(f"wrote {len(C.upsert_categories(url_hierarchy(read_sitemap(spark, a.path), a.store), a.root))} buckets")
    else:
        (stream_completed if a.completed else stream_refresh)(spark, a.landing, a.root, a.checkpoint)
        if a.out:
            refresh(spark, a.root, a.out)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
