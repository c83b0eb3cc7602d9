"""Streaming refresh equals the batch result; driver contract is well-formed."""

import os

from conftest import SF001
from pyspark.sql import functions as F

import __spark_entry__ as E
from pricelens import operators as ops
from pricelens.plans import panels
from pricelens.sources import products as P
from pricelens.streaming.refresh_stream import land, stream_refresh


def test_stream_equals_batch(spark, tmp_root):
    landing, root, ckpt = (os.path.join(tmp_root, x) for x in ("landing", "products", "ckpt"))
    morning = panels.panel_a(spark, SF001, pick="first").withColumn("ingest_seq", F.lit(1).cast("long"))
    evening = panels.panel_a(spark, SF001).withColumn("ingest_seq", F.lit(2).cast("long"))
    land(morning, landing)
    stream_refresh(spark, landing, root, ckpt)
    land(evening, landing)
    stream_refresh(spark, landing, root, ckpt)          # resumes after the committed batch
    stream_refresh(spark, landing, root, ckpt)          # nothing new: no change
    got = ops.price_changes(P.read_products(spark, root))
    want = ops.price_changes(panels.panel_a(spark, SF001))
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_stream_in_several_micro_batches(spark, tmp_root):
    landing, root, ckpt = (os.path.join(tmp_root, x) for x in ("landing", "products", "ckpt"))
    land(panels.panel_a(spark, SF001).withColumn("ingest_seq", F.lit(2).cast("long")), landing)
    land(panels.panel_a(spark, SF001, pick="first").withColumn("ingest_seq", F.lit(1).cast("long")), landing)
    batches = []
    stream_refresh(spark, landing, root, ckpt, on_batch=lambda s, epoch: batches.append(epoch),
                   max_files_per_trigger=1)
    assert len(batches) >= 2
    # the morning file landed last, but its rows have the smaller ingest_seq
    got = P.read_products(spark, root)
    evening = P.conform(panels.panel_a(spark, SF001))
    keep = ["product_id", "store", "scrape_date", "price"]
    assert got.select(*keep).exceptAll(evening.select(*keep)).count() == 0
    assert got.count() == evening.count()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["name", "product_id", "brand", "store", "link", "image", "current_price",
                          "avg_price_30d", "pct_discount", "rank"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 40
