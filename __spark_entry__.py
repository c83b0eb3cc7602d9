"""

``queries()`` maps a name to ``(spark, sf_dir) -> DataFrame``; every query
reads the benchmark tables under ``sf_dir`` (or panels Spark derives from
them) in full.  ``oracle_sql()`` gives the DuckDB SQL for the same result.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import oracle as O  # noqa: E402
from pricelens import operators as ops  # noqa: E402
from pricelens.plans import compose, panels  # noqa: E402
from pricelens.plans.refresh import refresh  # noqa: E402
from pricelens.session import configure, work_path  # noqa: E402
from pricelens.sources import html as H  # noqa: E402
from pricelens.sources import normalise as N  # noqa: E402
from pricelens.sources import products as P  # noqa: E402
from pricelens.functions import stamp_date, url_path  # noqa: E402
from pricelens.sources import categories as C  # noqa: E402
from pricelens.sources.reports_io import read_report_csv, write_csv  # noqa: E402
from pricelens.sources.sitemap import read_sitemap, url_hierarchy  # noqa: E402
from pricelens.streaming import refresh_stream as R  # noqa: E402
from pricelens.streaming.refresh_stream import land, stream_refresh  # noqa: E402

try:  # the training-data operators and their pipeline are an optional part
    import corpus_pipeline  # noqa: E402
    from pricelens.llm import queries as llm_queries  # noqa: E402
except ImportError:
    corpus_pipeline = llm_queries = None

SMOKE_DIR = "/root/testdata/sf0.001"

PANELS = {"daily": panels.panel_a, "weekly": panels.panel_b}
PANEL_SQL = {"daily": O.PANEL_A, "weekly": O.PANEL_B}
REPORTS = ["list_price_increases", "list_price_decreases", "discounts", "avg_deals_30d"]
HISTORY_NAMES = {"list_price_increases": "history_increases",
                 "list_price_decreases": "history_decreases",
                 "discounts": "history_discounts",
                 "avg_deals_30d": "history_deals"}


def _products(spark: SparkSession, sf_dir: str, panel: str) -> DataFrame:
    configure(spark)
    return PANELS[panel](spark, sf_dir)


def _report(products: DataFrame, name: str) -> DataFrame:
    if name == "avg_deals_30d":
        return ops.avg_deals_30d(products)
    pc = ops.price_changes(products)
    return getattr(ops, name)(pc)


def _all_reports(products: DataFrame) -> dict[str, DataFrame]:
    pc = ops.price_changes(products)
    return {
        "list_price_increases": ops.list_price_increases(pc),
        "list_price_decreases": ops.list_price_decreases(pc),
        "discounts": ops.discounts(pc),
        "avg_deals_30d": ops.avg_deals_30d(products),
    }


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: 30-day deals report on the daily panel at sf0.001."""
    return ops.avg_deals_30d(_products(spark, SMOKE_DIR, "daily"))


def _panel_queries(panel: str, suffix: str) -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

    def add(name, fn):
        q[name + suffix] = fn

    add("latest_two_dates", lambda s, d: ops.distinct_dates(_products(s, d, panel))
        .orderBy(F.col("scrape_date").desc()).limit(2))
    add("price_changes", lambda s, d: ops.price_changes(_products(s, d, panel)))
    add("avg_price_30d", lambda s, d: ops.avg_price_30d(_products(s, d, panel)))
    for rep in REPORTS:
        add(rep, lambda s, d, rep=rep: _report(_products(s, d, panel), rep))
        add(HISTORY_NAMES[rep], lambda s, d, rep=rep: ops.history(
            _report(_products(s, d, panel), rep), _products(s, d, panel)))
    add("report_stores", lambda s, d: ops.report_stores(_report(_products(s, d, panel), "discounts")))
    add("dashboard_feed", lambda s, d: ops.dashboard_feed(
        _all_reports(_products(s, d, panel)), _products(s, d, panel)))
    return q


def _panel_oracles(panel: str, suffix: str) -> dict[str, str]:
    p = PANEL_SQL[panel]
    o = {
        "latest_two_dates": O.latest_two_dates_sql(p),
        "price_changes": O.price_changes_sql(p),
        "avg_price_30d": O.avg_price_30d_sql(p),
        "dashboard_feed": O.feed_sql(p),
        "report_stores": O.report_stores_sql(p, "discounts"),
    }
    for rep in REPORTS:
        o[rep] = O.report_sql(p, rep)
        o[HISTORY_NAMES[rep]] = O.history_sql(p, rep)
    return {k + suffix: v for k, v in o.items()}


def _scratch(spark: SparkSession, name: str) -> str:
    import uuid
    return work_path(spark, "queries", f"{name}-{uuid.uuid4().hex}")


def _stored_weekly(s: SparkSession, d: str) -> DataFrame:
    root = _scratch(s, "products")
    P.write_products(_products(s, d, "weekly"), root)
    return P.read_products(s, root)


def _stored_upsert_daily(s: SparkSession, d: str) -> DataFrame:
    """Morning snapshot written first, then the day's last values upserted over it."""
    root = _scratch(s, "products")
    P.write_products(panels.panel_a(s, d, pick="first"), root)
    P.upsert_products(_products(s, d, "daily"), root)
    return P.read_products(s, root)


def _backfill(s: SparkSession, d: str) -> DataFrame:
    old = (_products(s, d, "weekly").drop("maincatid")
           .withColumnRenamed("pricewithoutdiscount", "priceWithoutDiscount")
           .withColumn("product_id", F.col("product_id").cast("long")))
    return P.backfill_frame(old)


def _report_csv(s: SparkSession, d: str) -> DataFrame:
    path = _scratch(s, "csv")
    write_csv(_report(_products(s, d, "weekly"), "discounts"), path, single_file=True)
    return read_report_csv(s, path, "discounts")


def _materialised_changes(s: SparkSession, d: str) -> DataFrame:
    return P.materialise(ops.price_changes(_products(s, d, "weekly")), _scratch(s, "pc"))


def _stream(s: SparkSession, d: str) -> DataFrame:
    """Two landed batches (morning, then evening values) streamed into the table."""
    landing, root, ckpt = _scratch(s, "landing"), _scratch(s, "products"), _scratch(s, "ckpt")
    land(panels.panel_a(s, d, pick="first").withColumn("ingest_seq", F.lit(1).cast("long")), landing)
    land(_products(s, d, "daily").withColumn("ingest_seq", F.lit(2).cast("long")), landing)
    stream_refresh(s, landing, root, ckpt)
    return ops.price_changes(P.read_products(s, root))


def _bucketed_changes(s: SparkSession, d: str) -> DataFrame:
    """Weekly panel stored in a product_id-bucketed catalog table, then price_changes on it."""
    import uuid
    name = f"products_bucketed_{uuid.uuid4().hex[:12]}"
    P.create_bucketed_table(s, name, _scratch(s, "bucketed"), 4)
    P.write_bucketed(_products(s, d, "weekly"), name)
    return ops.price_changes(P.read_bucketed(s, name))


def _refresh_feed(s: SparkSession, d: str) -> DataFrame:
    root = _scratch(s, "products")
    P.write_products(_products(s, d, "weekly"), root)
    return refresh(s, root, _scratch(s, "out"), csv=False)["feed"]


def _catalog_a(s, d, sim=False):
    configure(s)
    docs = N.parse_json(compose.catalog_a_docs(s, d), "json", N.CATALOG_A_PRODUCT)
    rows = N.catalog_a_rows(docs, "store_a")
    if not sim:
        return N.apply_simulation(rows, None)
    sims = N.simulated_prices(N.parse_json(compose.simulation_docs(s, d), "json", N.SIMULATION_A))
    return N.apply_simulation(rows, sims)


def _catalog_b(s, d):
    configure(s)
    return N.normalise(compose.catalog_b_docs(s, d), "catalog_b", "store_b", json_col="json")


def _tree(s, d, fmt, store, base):
    configure(s)
    field = "children" if fmt == "tree_a" else "subcategories"
    return N.normalise(compose.tree_docs(s, d, field), fmt, store, json_col="json", base_url=base)


def _categories(s, d):
    both = _tree(s, d, "tree_a", "store_a", compose.BASE_A).unionByName(
        _tree(s, d, "tree_b", "store_b", compose.BASE_B))
    return ops.dedup_latest(both, ["id", "store"], ["level", "path"])


def _gated_stream(s: SparkSession, d: str) -> DataFrame:
    """The table after each of two runs: of two landed snapshots the second has no succeeded marker at first."""
    landing, root, ckpt, states = (_scratch(s, x) for x in ("landing", "products", "ckpt", "states"))
    for seq, pick in ((1, "first"), (2, "last")):
        batch = panels.panel_a(s, d, pick=pick).withColumn("ingest_seq", F.lit(seq).cast("long"))
        R.land_snapshot(batch, landing, pick)
    R.mark(s, landing, "first")
    R.mark(s, landing, "last", R.FAILED)
    R.stream_completed(s, landing, root, ckpt)
    before = P.materialise(P.read_products(s, root), states)
    R.mark(s, landing, "last")
    R.stream_completed(s, landing, root, ckpt)
    return before.withColumn("run", F.lit(1)).unionByName(P.read_products(s, root).withColumn("run", F.lit(2)))


def _stored_categories(s: SparkSession, d: str) -> DataFrame:
    """Both trees, a later load that renames some categories, and one that arrives last but is older."""
    root = _scratch(s, "categories")
    trees = _categories(s, d)
    even = F.col("id").cast("long") % 2 == 0
    renamed = trees.where(even & (F.col("store") == "store_a")).withColumn("name", F.concat("name", F.lit(" v2")))
    for seq, batch in ((10, trees), (20, renamed), (5, trees.withColumn("name", F.lit("old")))):
        C.upsert_categories(batch.withColumn("ingest_seq", F.lit(seq).cast("long")), root, buckets=8)
    return C.read_categories(s, root)


def _select_stored(s: SparkSession, d: str) -> DataFrame:
    """Leaves under one region, from the stored table, resumed at the first leaf of a nation in it."""
    stored = P.materialise(_stored_categories(s, d), _scratch(s, "stored"))
    leaf = stored.where("store = 'store_a' AND level = 3 AND path LIKE '/3/112/%'").agg(F.min("path")).first()[0]
    return ops.select_categories(stored, "store_a", {"name": "ASIA", "level": 1}, start_from=leaf)


def _landed_files(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Catalogue pages in two loads and a load of broken lines: documents and quarantine."""
    configure(s)
    path, docs = _scratch(s, "landed"), compose.catalog_b_docs(s, d)
    half = F.crc32("json") % 2
    for part, load in ((1, docs.where(half == 0)), (2, docs.where(half == 1)), (3, compose.broken_docs(s, d))):
        compose.land_documents(load, path, part)
    return N.read_landed(s, [f"{path}/{k:04d}" for k in (1, 2, 3)], N.CATALOG_B_PAGE)


def _landed_trees(s: SparkSession, d: str) -> DataFrame:
    configure(s)
    path = _scratch(s, "trees")
    compose.tree_files(s, d, "children").write.partitionBy("doc").text(path)
    schema, rows = N.NORMALISERS["tree_a"]
    docs, _ = N.read_landed(s, path, schema, multiline=True)
    return rows(docs, "store_a", base_url=compose.BASE_A)


def _landed_override(s: SparkSession, d: str) -> DataFrame:
    """Catalogue A with simulations from two loads: the later one has only every other product."""
    configure(s)
    path = _scratch(s, "simulations")
    compose.land_documents(compose.superseded_simulation_docs(s, d), path, 1)
    later = compose.simulation_docs(s, d)
    sku = F.split(F.get_json_object("json", "$.items[0].id"), "-")[0].cast("long")
    compose.land_documents(later.where(sku % 2 == 0), path, 2)
    docs, _ = N.read_landed(s, [f"{path}/0001", f"{path}/0002"], N.SIMULATION_A)
    products = N.parse_json(compose.catalog_a_docs(s, d), "json", N.CATALOG_A_PRODUCT)
    return N.apply_simulation(N.catalog_a_rows(products, "store_a"), N.simulated_prices(docs))


def _dirty_ingest(s: SparkSession, d: str) -> DataFrame:
    """Text rows of one day, stamped and conformed, into a table that does not exist yet; then an empty batch."""
    root = _scratch(s, "products")
    empty = P.read_products(s, root)
    day = _products(s, d, "weekly").where("scrape_date = '2026-01-13'")
    rows = stamp_date(P.with_maincatid(compose.dirty_batch(day)).drop("scrape_date"), "2026-04-13")
    P.upsert_products(rows, root)
    P.upsert_products(empty, root)
    return P.read_products(s, root).unionByName(empty)


def _dropped_partition(s: SparkSession, d: str) -> DataFrame:
    """The catalog's view of the stored table after the folders of its first day are gone."""
    import uuid
    root, name = _scratch(s, "products"), f"products_{uuid.uuid4().hex[:12]}"
    written = P.write_products(_products(s, d, "weekly"), root)
    P.register_table(s, name, root)
    first = min(k[0] for k in written)
    P._delete_partitions(s, root, {k for k in written if k[0] == first})
    P.refresh_table(s, name)
    return s.table(name)


def _backfill_by_category(s: SparkSession, d: str) -> DataFrame:
    """An old table whose catid is a path, a category id or unknown, written by top-level category."""
    root, k = _scratch(s, "products"), F.col("product_id").cast("long")
    new = _products(s, d, "weekly")
    cats = new.select(F.md5("maincatid").alias("id"), "store", F.concat(F.lit("/"), "maincatid", F.lit("/x/")).alias("path")).distinct()
    old = new.withColumn("catid", F.when(k % 10 == 9, F.lit("gone")).when(k % 4 == 0, F.col("catid")).otherwise(F.md5("maincatid")))
    P.backfill(old.drop("maincatid"), root, cats)
    return P.read_products(s, root)


def _broken_changes(s: SparkSession, d: str) -> DataFrame:
    products = _products(s, d, "weekly")
    return ops.change_violations(compose.broken_changes(ops.price_changes(products)), ops.latest_date(products))


def _sitemap_urls(s: SparkSession, d: str) -> DataFrame:
    path = _scratch(s, "sitemaps")
    configure(s)
    compose.sitemap_files(s, d).select("xml").write.text(path)
    return read_sitemap(s, path).select("url")


def _pages(s, d):
    configure(s)
    return panels.table(s, d, "pages")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    q["products_upsert"] = lambda s, d: _products(s, d, "daily")
    q["products_weekly"] = lambda s, d: _products(s, d, "weekly")
    q.update(_panel_queries("daily", ""))
    q.update(_panel_queries("weekly", "_weekly"))
    for rep in REPORTS:
        q[f"violations_{rep}"] = lambda s, d, rep=rep: ops.report_violations(
            _report(_products(s, d, "weekly"), rep), rep)
    q["store_union"] = lambda s, d: _products(s, d, "daily").unionByName(_products(s, d, "weekly"))
    q["stored_products_weekly"] = _stored_weekly
    q["stored_upsert_daily"] = _stored_upsert_daily
    q["backfill_projection"] = _backfill
    q["discounts_csv_weekly"] = _report_csv
    q["price_changes_materialised_weekly"] = _materialised_changes
    q["stream_refresh"] = _stream
    q["refresh_feed_weekly"] = _refresh_feed
    q["price_changes_bucketed_weekly"] = _bucketed_changes
    q["catalog_a"] = lambda s, d: _catalog_a(s, d, sim=False)
    q["price_override"] = lambda s, d: _catalog_a(s, d, sim=True)
    q["catalog_b"] = _catalog_b
    q["price_fold"] = lambda s, d: _catalog_b(s, d).select(
        "product_id", "price", "pricewithoutdiscount", "list_price")
    q["category_tree_a"] = lambda s, d: _tree(s, d, "tree_a", "store_a", compose.BASE_A)
    q["category_tree_b"] = lambda s, d: _tree(s, d, "tree_b", "store_b", compose.BASE_B)
    q["categories"] = _categories
    q["select_categories"] = lambda s, d: ops.select_categories(
        _categories(s, d), "store_a", {"name": "ASIA"}, start_from="/no/such/path/")
    q["url_hierarchy"] = lambda s, d: url_hierarchy(
        _pages(s, d).select(F.col("page_id").alias("url_index"), "url"), "pages")
    q["html_links"] = lambda s, d: H.page_links(_pages(s, d))
    q["stream_completed"] = _gated_stream
    q["stored_categories"] = _stored_categories
    q["select_categories_stored"] = _select_stored
    q["landed_catalog_b"] = lambda s, d: N.catalog_b_rows(_landed_files(s, d)[0].select("doc"), "store_b")
    q["landed_quarantine"] = lambda s, d: _landed_files(s, d)[1].select(
        F.element_at(F.split("file", "/"), -2).alias("load"), "raw", "partial.totalCount")
    q["landed_category_tree_a"] = _landed_trees
    q["price_override_landed"] = _landed_override
    q["ingest_dirty"] = _dirty_ingest
    q["catalog_refresh_dropped"] = _dropped_partition
    q["backfill_by_category"] = _backfill_by_category
    q["violations_broken_report"] = lambda s, d: ops.report_violations(
        compose.broken_report(_report(_products(s, d, "weekly"), "discounts")), "discounts")
    q["violations_broken_changes"] = _broken_changes
    q["dashboard_feed_labels_weekly"] = lambda s, d: ops.dashboard_feed(
        _all_reports(_products(s, d, "weekly")), _products(s, d, "weekly"), labels=True)
    q["product_tiles"] = lambda s, d: H.product_tiles(compose.listing_pages(s, d), "https://shop.example.com")
    q["sitemap_urls"] = _sitemap_urls
    q["url_paths"] = lambda s, d: compose.relative_urls(s, d).select("url_index", url_path("url").alias("path"))
    if llm_queries is not None:
        q.update(llm_queries.queries())
        q["pipeline"] = corpus_pipeline.run
    return q


def oracle_sql() -> dict[str, str]:
    o: dict[str, str] = {
        "products_upsert": O.products_sql(O.PANEL_A),
        "products_weekly": O.products_sql(O.PANEL_B),
    }
    o.update(_panel_oracles("daily", ""))
    o.update(_panel_oracles("weekly", "_weekly"))
    for rep in REPORTS:
        o[f"violations_{rep}"] = O.violations_sql(O.PANEL_B, rep)
    o["store_union"] = O.store_union_sql()
    o["stored_products_weekly"] = O.products_sql(O.PANEL_B)
    o["stored_upsert_daily"] = O.products_sql(O.PANEL_A)
    o["backfill_projection"] = O.products_sql(O.PANEL_B)
    o["discounts_csv_weekly"] = O.report_sql(O.PANEL_B, "discounts")
    o["price_changes_materialised_weekly"] = O.price_changes_sql(O.PANEL_B)
    o["stream_refresh"] = O.price_changes_sql(O.PANEL_A)
    o["refresh_feed_weekly"] = O.feed_sql(O.PANEL_B)
    o["price_changes_bucketed_weekly"] = O.price_changes_sql(O.PANEL_B)
    o["catalog_a"] = O.catalog_a_sql()
    o["price_override"] = O.price_override_sql()
    o["catalog_b"] = O.catalog_b_sql()
    o["price_fold"] = O.price_fold_sql()
    o["category_tree_a"] = O.tree_sql("store_a", "names")
    o["category_tree_b"] = O.tree_sql("store_b", "ids")
    o["categories"] = O.categories_sql()
    o["select_categories"] = O.select_categories_sql("store_a", "ASIA")
    o["url_hierarchy"] = O.url_hierarchy_sql("pages")
    o["html_links"] = O.html_links_sql()
    o["stream_completed"] = O.gated_stream_sql()
    o["stored_categories"] = O.stored_categories_sql()
    o["select_categories_stored"] = O.select_stored_sql()
    o["landed_catalog_b"] = O.catalog_b_sql()
    o["landed_quarantine"] = O.quarantine_sql()
    o["landed_category_tree_a"] = O.tree_sql("store_a", "names")
    o["price_override_landed"] = O.landed_override_sql()
    o["ingest_dirty"] = O.dirty_ingest_sql()
    o["catalog_refresh_dropped"] = O.dropped_partition_sql()
    o["backfill_by_category"] = O.backfill_by_category_sql()
    o["violations_broken_report"] = O.broken_report_sql()
    o["violations_broken_changes"] = O.broken_changes_sql()
    o["dashboard_feed_labels_weekly"] = O.feed_labels_sql(O.PANEL_B)
    o["product_tiles"] = O.product_tiles_sql()
    o["sitemap_urls"] = O.sitemap_urls_sql()
    o["url_paths"] = O.url_paths_sql()
    if llm_queries is not None:
        o.update(llm_queries.oracle_sql())
        if corpus_pipeline.ORACLE_SQL:
            o["pipeline"] = corpus_pipeline.ORACLE_SQL
    return o
