"""Completion gate, stored categories, pruned history, landed files, checks in one pass, URLs and labels."""

import datetime as dt
import json
import os
import random
from urllib.parse import urlparse

import pytest
from conftest import SF001
from pyspark.sql import functions as F

from pricelens import __main__ as cli
from pricelens import operators as ops
from pricelens.functions import fixed, url_path
from pricelens.operators.history import pruned
from pricelens.operators.joins import materialise_small
from pricelens.plans import panels
from pricelens.plans.ordinal import with_ordinal
from pricelens.schemas import CATALOG_B_PAGE, PRODUCTS_STORED, SIMULATION_A
from pricelens.sources import categories as C
from pricelens.sources import normalise as N
from pricelens.sources import products as P
from pricelens.sources.sitemap import read_sitemap, sitemap_locations
from pricelens.streaming import refresh_stream as R


# --- T1 ------------------------------------------------------------------------------

def row(pid, price, day=13, store="s1"):
    return (pid, store, dt.date(2026, 4, day), "n", "b", "mc", "c", "sc", "/m1/", "img", price, price, price, True, "l", "m1")


def test_gate_waits_for_the_marker(spark, tmp_root):
    landing, root, ckpt = (os.path.join(tmp_root, x) for x in ("landing", "products", "ckpt"))
    runs = []

    def run():
        R.stream_completed(spark, landing, root, ckpt, on_batch=lambda s, epoch: runs.append(epoch))
        return sorted((r.product_id, r.price) for r in P.read_products(spark, root).collect())

    assert run() == []                                              # nothing landed, no folder at all
    R.land_snapshot(spark.createDataFrame([row("a", 1.0)], PRODUCTS_STORED), landing, "mon")
    R.land_snapshot(spark.createDataFrame([row("a", 2.0, 14), row("b", 2.0, 14)], PRODUCTS_STORED), landing, "tue")
    assert run() == [] and not runs                                 # landed, but no marker
    R.mark(spark, landing, "mon", R.FAILED)
    R.mark(spark, landing, "wed")                                   # marker before its folder
    R.mark(spark, landing, "tue", n_rows=3)                         # half landed
    assert run() == [] and not runs
    R.land_snapshot(spark.createDataFrame([row("c", 2.0, 14)], PRODUCTS_STORED), landing, "tue")
    assert run() == [("a", 2.0), ("b", 2.0), ("c", 2.0)]            # the marker was kept for a further look
    assert len(runs) == 1
    assert run() == [("a", 2.0), ("b", 2.0), ("c", 2.0)]
    R.mark(spark, landing, "mon")
    R.land_snapshot(spark.createDataFrame([row("d", 3.0, 15)], PRODUCTS_STORED), landing, "wed")
    assert run() == [("a", 1.0), ("a", 2.0), ("b", 2.0), ("c", 2.0), ("d", 3.0)]


def test_gated_snapshot_folder_is_pruned(spark, tmp_root):
    landing = os.path.join(tmp_root, "landing")
    for name in ("x", "y"):
        R.land_snapshot(spark.createDataFrame([row(name, 1.0)], PRODUCTS_STORED), landing, name)
    held = R.landed_snapshots(spark, landing, ["y"])
    assert [r.product_id for r in held.collect()] == ["y"]
    assert "snapshot" in held._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1].split("]")[0]
    assert R.landed_snapshots(spark, landing, []).count() == 0


# --- S16 -----------------------------------------------------------------------------

CATEGORY = "id string, store string, name string, parent_id string, path string, level int, link string, ingest_seq long"


def cats(spark, *rows):
    return spark.createDataFrame([(i, s, n, None, f"/{i}/", 1, "l", q) for i, s, n, q in rows], CATEGORY)


def names(spark, root):
    return {(r.id, r.store): r.name for r in C.read_categories(spark, root).collect()}


def test_stored_categories_keep_the_latest_document(spark, tmp_root):
    root = os.path.join(tmp_root, "categories")
    assert C.read_categories(spark, root).count() == 0
    C.upsert_categories(cats(spark, ("1", "s", "one", 5), ("2", "s", "two", 5), ("1", "t", "uno", 5), ("1", "s", "dup", 4)), root, 4)
    assert names(spark, root) == {("1", "s"): "one", ("2", "s"): "two", ("1", "t"): "uno"}
    C.upsert_categories(cats(spark, ("1", "s", "late but old", 3), ("2", "s", "TWO", 6), ("3", "s", "three", 6)), root)
    assert names(spark, root) == {("1", "s"): "one", ("2", "s"): "TWO", ("1", "t"): "uno", ("3", "s"): "three"}
    assert C.upsert_categories(cats(spark).limit(0), root) == []
    C.upsert_categories(cats(spark, ("2", "s", "unstamped", 0)).drop("ingest_seq"), root)          # its time of arrival wins
    assert names(spark, root)["2", "s"] == "unstamped"
    assert os.listdir(root).count("of=4") == 1                                                     # the first write fixes the layout


def test_a_small_load_rewrites_touched_buckets_only(spark, tmp_root):
    root = os.path.join(tmp_root, "categories")
    C.upsert_categories(cats(spark, *[(str(i), "s", f"n{i}", 1) for i in range(200)]), root, 16)

    def files():
        return {os.path.join(d, f) for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")}

    before = files()
    touched = C.upsert_categories(cats(spark, ("7", "s", "seven", 2)), root)
    assert len(touched) == 1 and len(before - files()) == 1 and len(files()) == len(before)
    assert names(spark, root)["7", "s"] == "seven" and len(names(spark, root)) == 200


def test_categories_without_a_required_column_raise(spark, tmp_root):
    root = os.path.join(tmp_root, "categories")
    for bad in (("1", "s", None, 1), (None, "s", "n", 1), ("1", None, "n", 1)):
        with pytest.raises(ValueError):
            C.upsert_categories(cats(spark, ("5", "s", "fine", 1), bad), root)
    assert C.read_categories(spark, root).count() == 0


# --- J4 / R6 / R7 / R9 ------------------------------------------------------------------

def scan_rows(df):
    """Rows that the Parquet scans of an executed query gave."""
    df.collect()

    def walk(node):
        if "Adaptive" in node.nodeName():
            return walk(node.executedPlan())
        if node.nodeName().startswith("Scan parquet"):
            return node.metrics().apply("numOutputRows").value()
        return sum(walk(node.children().apply(i)) for i in range(node.children().size()))

    return walk(df._jdf.queryExecution().executedPlan())


def test_history_scan_is_pruned(spark, tmp_root):
    root = os.path.join(tmp_root, "products")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    small = {"parquet.block.size": "4000", "parquet.block.size.row.check.min": "5", "parquet.page.size": "500",
             "parquet.page.size.row.check.min": "5", "parquet.block.size.row.check.max": "20"}
    for k, v in small.items():
        conf.set(k, v)
    try:
        rows = [row(f"p{i:04d}", 1.0, day, s) for i in range(2000) for day in (13, 14) for s in ("s1", "s2")]
        P.write_products(spark.createDataFrame(rows, PRODUCTS_STORED).repartition(3), root)
    finally:
        for k in small:
            conf.unset(k)
    products = P.read_products(spark, root)
    report = spark.createDataFrame([("p0700", "s1"), ("p0701", "s1")], "product_id string, store string")
    keys = materialise_small(report)
    scan = pruned(products, keys)
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "(store#" in plan.split("PartitionFilters")[1].split("]")[0] and "p0700" in plan.split("PushedFilters")[1].split("]")[0]
    assert scan_rows(products) == 8000 and scan_rows(scan) < 2000      # one store, and few of its row groups
    got = [(r.product_id, r.store, r.scrape_date.day) for r in ops.history(report, products).collect()]
    assert got == [("p0700", "s1", 13), ("p0700", "s1", 14), ("p0701", "s1", 13), ("p0701", "s1", 14)]
    # more ids than literals: the stores still prune, the join does the rest
    assert pruned(products, keys, max_literals=1).count() == 4000
    assert ops.history(report.limit(0), products).count() == 0


# --- S14 / S15 / U2 / N2 -----------------------------------------------------------------

def test_landed_files_arrival_and_quarantine(spark, tmp_root):
    def write(name, text):
        with open(os.path.join(tmp_root, name), "w") as f:
            f.write(text)

    page = {"totalCount": 1, "products": [{"id": 5}]}
    write("a.json", json.dumps(page) + "\n{broken\n" + json.dumps(page) + "\n")
    write("b.json", json.dumps([page, page]) + "\n")                                 # an array of documents
    docs, bad = N.read_landed(spark, tmp_root, CATALOG_B_PAGE)
    assert len(docs.collect()) == 4 and [os.path.basename(r.file) for r in bad.collect()] == ["a.json"]
    assert [r.raw for r in bad.collect()] == ["{broken"]
    # arrival follows the file time, then the place in the file
    sim = os.path.join(tmp_root, "sim")
    os.makedirs(sim)
    for name, price, when in (("z.json", 100, 1_700_000_000), ("a.json", 200, 1_700_000_500)):
        with open(os.path.join(sim, name), "w") as f:
            for p in (price + 1, price):
                items = [{"id": "k", "price": p, "listPrice": p, "availability": "available"}]
                f.write(json.dumps({"items": items}) + "\n")
        os.utime(os.path.join(sim, name), (when, when))
    docs, _ = N.read_landed(spark, sim, SIMULATION_A)
    assert [(r.sku, r.sim_price) for r in N.simulated_prices(docs).collect()] == [("k", 2.0)]


def test_last_item_of_a_document_counts(spark):
    doc = {"items": [{"id": "k", "price": p, "listPrice": p, "availability": "available"} for p in (300, 100)]}
    docs = N.parse_json(spark.createDataFrame([(json.dumps(doc), 1)], "j string, seq long"), "j", SIMULATION_A)
    assert N.simulated_prices(docs).first().sim_price == 1.0


def test_tree_command_loads_multi_line_files(spark, tmp_root):
    landed, root = os.path.join(tmp_root, "trees"), os.path.join(tmp_root, "categories")
    os.makedirs(landed)
    for name, title, when in (("1.json", "Old", 1_700_000_000), ("2.json", "New", 1_700_000_900)):
        tree = [{"id": "1", "name": title, "children": [{"id": "2", "name": "Mid", "children": [{"id": "3", "name": "Leaf"}]}]}]
        with open(os.path.join(landed, name), "w") as f:
            json.dump(tree, f, indent=2)
        os.utime(os.path.join(landed, name), (when, when))
    with open(os.path.join(landed, "3.json"), "w") as f:
        f.write('[{"id": "1", ')
    held = os.path.join(tmp_root, "held")
    assert cli.main(["categories", "tree_a", landed, root, "--store", "s", "--base-url", "https://x", "--multiline",
                     "--quarantine", held]) == 0
    got = {r.id: (r.name, r.path, r.link) for r in C.read_categories(spark, root).collect()}
    assert got == {"1": ("New", "/1/", "https://x/New"), "2": ("Mid", "/1/2/", "https://x/New/Mid"),
                   "3": ("Leaf", "/1/2/3/", "https://x/New/Mid/Leaf")}
    assert [os.path.basename(r.file) for r in spark.read.parquet(held).collect()] == ["3.json"]


# --- S17 / F12 ---------------------------------------------------------------------------

def test_every_location_of_a_sitemap(spark, tmp_root):
    text = ('<?xml version="1.0"?><sitemapindex><!-- <loc>x</loc>\n<loc>y</loc> --><sitemap><loc>https://m/1.xml</loc></sitemap>'
            '<sitemap><loc lang="a">\n https://m/2.xml?a=1&amp;b=2 </loc ></sitemap><image:loc>https://i/1.png</image:loc>'
            '<loc><![CDATA[https://m/3.xml?a=1&b=2]]></loc><loc></loc></sitemapindex>')
    df = spark.createDataFrame([(1, text), (2, None), (3, "no xml")], "k int, value string")
    got = [(r.k, r.pos, r.url) for r in sitemap_locations(df).orderBy("pos").collect()]
    assert got == [(1, 0, "https://m/1.xml"), (1, 1, "https://m/2.xml?a=1&b=2"), (1, 2, "https://m/3.xml?a=1&b=2"), (1, 3, "")]
    for name in ("b.xml", "a.xml"):
        with open(os.path.join(tmp_root, name), "w") as f:
            f.write(f"<urlset><url><loc>https://s/{name}/1</loc></url>\n<url><loc>https://s/{name}/2</loc></url></urlset>")
    got = [(r.url_index, r.url) for r in read_sitemap(spark, tmp_root).orderBy("url_index").collect()]
    assert got == [(0, "https://s/a.xml/1"), (1, "https://s/a.xml/2"), (2, "https://s/b.xml/1"), (3, "https://s/b.xml/2")]


def test_url_paths_equal_a_url_parser(spark):
    urls = ["https://h.com/a/b", "//h.com/a/b", "/a/b", "a/b", "https://h.com", "https://h.com?x=/y", "mailto:x@y", "/a;p/b;q;r?x#y",
            "", "http://h/a b/ü", "x:", "#f", "?q", "HTTP://h:80//a//b", "https://u:p@h/%20;x"]
    rows = spark.createDataFrame([(u,) for u in urls], "u string").select("u", url_path("u").alias("p")).collect()
    assert {r.u: r.p for r in rows} == {u: urlparse(u).path for u in urls}
    assert spark.createDataFrame([(None,)], "u string").select(url_path("u").alias("p")).first().p == ""


# --- F15, N8 -------------------------------------------------------------------------------

def test_fixed_decimals_round_the_exact_value(spark):
    rng = random.Random(1)
    xs = [round(rng.uniform(0, 5000), rng.choice([0, 1, 2, 3, 4])) for _ in range(3000)]
    xs += [rng.randrange(0, 100_000) / rng.choice([2, 4, 8, 16, 20, 40, 200, 400]) for _ in range(3000)]
    xs += [0.0, 0.15, 0.25, 0.35, 2.675, 1.005, 0.5, 1.5, -2.25, -0.04, 1e9 + 0.125]
    df = spark.createDataFrame([(x,) for x in xs], "x double").select("x", fixed("x", 1).alias("a"), fixed("x", 2).alias("b"), fixed("x", 0).alias("c"))
    assert all((r.a, r.b, r.c) == ("%.1f" % r.x, "%.2f" % r.x, "%.0f" % r.x) for r in df.collect())


def test_ordinal_plan_does_not_grow_with_partitions(spark):
    def plan(parts):
        with_sizes = with_ordinal(spark.range(0, 400, numPartitions=parts).withColumn("k", F.col("id") % 97), ["k", "id"], "n", 5)
        assert [r.n for r in with_sizes.orderBy("k", "id").collect()] == list(range(5, 405))
        return len(with_sizes._jdf.queryExecution().analyzed().toString().splitlines())

    assert plan(2) == plan(40)


# --- V1 / A8 -------------------------------------------------------------------------------

def test_each_rule_of_a_report_fires(spark):
    columns = "store string, product_id string, rank int, prev_price double, current_price double, pct_decrease double"
    sound = [("s", f"p{i}", i, 10.0, 5.0, 50.0 - i) for i in range(1, 6)]
    assert ops.report_violations(spark.createDataFrame(sound, columns), "discounts").count() == 0
    assert ops.report_violations(spark.createDataFrame([], columns), "discounts").count() == 0

    def rules(*rows):
        return sorted((r.store, r.product_id, r.rank, r.rule) for r in
                      ops.report_violations(spark.createDataFrame(list(rows), columns), "discounts", k=5)
                      .fillna("-", ["product_id"]).fillna(-1, ["rank"]).collect())

    assert rules(*sound[:4], ("s", "p5", 6, 10.0, 5.0, 1.0)) == [("s", "-", -1, "rank_gap"), ("s", "p5", 6, "rank_out_of_range")]
    assert rules(("s", "p", 1, 10.0, 5.0, 0.0)) == [("s", "p", 1, "non_positive_pct")]
    assert rules(("s", "p", 1, 10.0, 5.0, None)) == [("s", "p", 1, "non_positive_pct")]
    assert rules(("s", "p", 1, None, 5.0, 1.0)) == [("s", "p", 1, "missing_before"), ("s", "p", 1, "wrong_direction")]
    assert rules(("s", "p", 1, 4.0, 5.0, 1.0)) == [("s", "p", 1, "wrong_direction")]
    assert rules(("s", "p", 1, 9.0, 5.0, 1.0), ("s", "q", 2, 9.0, 5.0, 2.0)) == [("s", "-", 2, "rank_order")]
    assert rules(("s", "p", 1, 9.0, 5.0, 1.0), ("s", "q", 1, 9.0, 5.0, 1.0)) == [("s", "-", -1, "rank_gap")]


def test_sound_changes_have_no_violation(spark):
    panel = panels.panel_a(spark, SF001)
    assert ops.change_violations(ops.price_changes(panel), ops.latest_date(panel)).count() == 0


def test_two_category_filters(spark):
    rows = [("1", "s", "Top", None, "/1/", 1, "l"), ("2", "s", "Top", "1", "/1/2/", 2, "l"), ("3", "s", "Leaf", "2", "/1/2/3/", 3, "l"),
            ("9", "s", "Leaf", "2", "/2/2/9/", 3, "l")]
    df = spark.createDataFrame(rows, "id string, store string, name string, parent_id string, path string, level int, link string")
    assert [r.path for r in ops.select_categories(df, "s", {"name": "Top", "level": 1}).collect()] == ["/1/2/3/"]
    assert [r.path for r in ops.select_categories(df, "s", {"name": "Top", "level": 2}).collect()] == ["/2/2/9/"]
    assert ops.select_categories(df, "s", {"name": "Top", "level": 3}).count() == 0
