"""Partitioned table: overwrite-by-partition, upsert by key, empty batch, backfill, CSV."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens import operators as ops
from pricelens.schemas import PRODUCTS_STORED
from pricelens.sources import products as P
from pricelens.sources.reports_io import read_report_csv, write_csv

D = dt.date(2026, 4, 13)


def row(pid, price, d=D, store="s1", maincatid="m1", catid="/m1/x/"):
    return (pid, store, d, "n", "b", "mc", "c", "sc", catid, "img", price, price, price, True, "l", maincatid)


def test_overwrite_replaces_partition(spark, tmp_root):
    root = os.path.join(tmp_root, "products")
    P.write_products(spark.createDataFrame([row("p1", 1.0), row("p2", 2.0)], PRODUCTS_STORED), root)
    P.write_products(spark.createDataFrame([row("p3", 3.0), row("p4", 4.0)], PRODUCTS_STORED), root)
    got = sorted(r.product_id for r in P.read_products(spark, root).collect())
    assert got == ["p3", "p4"]
    part = os.path.join(root, "scrape_date=2026-04-13", "store=s1", "maincatid=m1")
    assert os.path.isdir(part)
    files = [f for f in os.listdir(part) if f.endswith(".parquet")]
    assert len(files) == 1


def test_other_partitions_untouched(spark, tmp_root):
    root = os.path.join(tmp_root, "products")
    P.write_products(spark.createDataFrame([row("p1", 1.0), row("p2", 2.0, store="s2")], PRODUCTS_STORED), root)
    P.write_products(spark.createDataFrame([row("p3", 3.0)], PRODUCTS_STORED), root)
    assert sorted(r.product_id for r in P.read_products(spark, root).collect()) == ["p2", "p3"]


def test_empty_batch_is_noop(spark, tmp_root):
    root = os.path.join(tmp_root, "products")
    P.write_products(spark.createDataFrame([row("p1", 1.0)], PRODUCTS_STORED), root)
    P.write_products(P.empty_products(spark), root)
    assert P.read_products(spark, root).count() == 1
    assert P.upsert_products(P.empty_products(spark), root) == []


def test_upsert_last_write_wins(spark, tmp_root):
    root = os.path.join(tmp_root, "products")
    P.write_products(spark.createDataFrame([row("p1", 1.0), row("p2", 2.0)], PRODUCTS_STORED), root)
    batch = spark.createDataFrame([row("p1", 10.0), row("p1", 11.0), row("p5", 5.0)], PRODUCTS_STORED)
    batch = batch.withColumn("seq", F.when(F.col("price") == 11.0, 2).otherwise(1))
    P.upsert_products(batch, root, order=["seq"])
    got = {r.product_id: r.price for r in P.read_products(spark, root).collect()}
    assert got == {"p1": 11.0, "p2": 2.0, "p5": 5.0}


def test_upsert_moves_between_maincats(spark, tmp_root):
    root = os.path.join(tmp_root, "products")
    P.write_products(spark.createDataFrame([row("p1", 1.0)], PRODUCTS_STORED), root)
    P.upsert_products(spark.createDataFrame([row("p1", 2.0, maincatid="m2")], PRODUCTS_STORED), root)
    rows = P.read_products(spark, root).collect()
    assert [(r.product_id, r.price, r.maincatid) for r in rows] == [("p1", 2.0, "m2")]
    assert not os.path.exists(os.path.join(root, "scrape_date=2026-04-13", "store=s1", "maincatid=m1"))


def test_conform_is_lenient_except_date(spark):
    df = spark.createDataFrame([("7", "s", "2026-04-13", "abc", "x")],
                               "product_id string, store string, scrape_date string, price string, "
                               "is_available string")
    r = P.conform(df).collect()[0]
    assert r.price is None and r.is_available is None and r.scrape_date == D and r.list_price is None


def test_backfill_derives_maincatid(spark):
    old = spark.createDataFrame(
        [(1, "a", D, 1.0, "/top/x/"), (2, "b", D, 2.0, "55")],
        "product_id long, store string, scrape_date date, priceWithoutDiscount double, catid string")
    cats = spark.createDataFrame([("55", "b", "n", None, "/9/55/", 2, "l")],
                                 "id string, store string, name string, parent_id string, path string, "
                                 "level int, link string")
    got = {r.product_id: (r.maincatid, r.pricewithoutdiscount) for r in P.backfill_frame(old, cats).collect()}
    assert got == {"1": ("top", 1.0), "2": ("9", 2.0)}


def test_csv_roundtrip(spark, tmp_root, seed):
    rep = ops.discounts(ops.price_changes(seed))
    path = os.path.join(tmp_root, "csv")
    write_csv(rep, path, single_file=True)
    back = read_report_csv(spark, path, "discounts")
    assert back.schema == rep.schema or back.columns == rep.columns
    assert back.exceptAll(rep).count() == 0 and rep.exceptAll(back).count() == 0


def test_materialise(spark, tmp_root, seed):
    pc = P.materialise(ops.price_changes(seed), os.path.join(tmp_root, "pc"))
    assert pc.count() == 10


def test_snapshot_dates_from_layout(spark, tmp_root):
    root = os.path.join(tmp_root, "products")
    d2 = dt.date(2026, 4, 20)
    P.write_products(spark.createDataFrame([row("p1", 1.0), row("p1", 2.0, d=d2)], PRODUCTS_STORED), root)
    assert P.snapshot_dates(spark, root) == [d2, D]
    assert P.snapshot_dates(spark, root, 1) == [d2]
    assert P.snapshot_dates(spark, os.path.join(tmp_root, "missing")) == []
    assert ops.latest_dates(P.read_products(spark, root), 2) == [d2, D]


def test_write_keeps_key_unique(spark, tmp_root):
    root = os.path.join(tmp_root, "products")
    dup = [row("p1", 1.0, maincatid="m1"), row("p1", 1.0, maincatid="m2"), row("p2", 2.0)]
    P.write_products(spark.createDataFrame(dup, PRODUCTS_STORED), root)
    got = sorted((r.product_id, r.maincatid) for r in P.read_products(spark, root).collect())
    assert got == [("p1", "m2"), ("p2", "m1")]


def test_unique_by_key_equals_dedup_latest(spark):
    from pricelens.operators.upsert import dedup_latest, unique_by_key
    rows = [("a", 1, 1.0), ("a", 2, 5.0), ("b", 1, 2.0), (None, 1, 3.0), (None, 2, 4.0), ("c", 7, 7.0)]
    df = spark.createDataFrame(rows, "k string, seq int, v double")
    want = sorted(dedup_latest(df, ["k"], ["seq"]).collect(), key=str)
    assert sorted(unique_by_key(df, ["k"], ["seq"]).collect(), key=str) == want
    assert sorted(r.v for r in want) == [2.0, 4.0, 5.0, 7.0]


def test_key_is_unique_across_categories(spark, tmp_root):
    """The same product written under two categories in two calls is stored once, by the later call."""
    root = tmp_root + "/products"
    P.write_products(spark.createDataFrame([row("p1", 1.0, maincatid="m1"), row("p2", 5.0, maincatid="m1")], PRODUCTS_STORED), root)
    P.write_products(spark.createDataFrame([row("p1", 2.0, maincatid="m2")], PRODUCTS_STORED), root)
    got = {(r.product_id, r.price, r.maincatid) for r in P.read_products(spark, root).collect()}
    assert got == {("p1", 2.0, "m2"), ("p2", 5.0, "m1")}


@pytest.mark.parametrize("calls,backwards", [(1, True), (2, False), (8, True)])
def test_upsert_does_not_depend_on_the_split(spark, tmp_root, calls, backwards):
    """Rows with ``ingest_seq`` give one table, however they are split into calls and ordered."""
    root = tmp_root + "/products"
    schema = T.StructType([*PRODUCTS_STORED.fields, T.StructField("ingest_seq", T.LongType())])
    rows = [(*row(f"p{k % 3}", float(k), maincatid=f"m{k % 2}"), 10 - k if k % 3 else 7) for k in range(8)]
    rows = rows[::-1] if backwards else rows
    step = 8 // calls
    for a in range(0, 8, step):
        P.upsert_products(spark.createDataFrame(rows[a:a + step], schema), root)
    got = {(r.product_id, r.price, r.maincatid) for r in P.read_products(spark, root).collect()}
    # p0 ties on ingest_seq 7 between 0, 3 and 6: the greater columns win
    assert got == {("p0", 6.0, "m0"), ("p1", 1.0, "m1"), ("p2", 2.0, "m0")}


def test_null_partition_keys_are_rejected(spark, tmp_root):
    root = tmp_root + "/products"
    for bad in (row("p1", 1.0, d=None), row("p1", 1.0, store=None)):
        with pytest.raises(ValueError, match="must not be NULL"):
            P.write_products(spark.createDataFrame([bad], PRODUCTS_STORED), root)
    assert P.read_products(spark, root).count() == 0 and P.snapshot_dates(spark, root) == []
