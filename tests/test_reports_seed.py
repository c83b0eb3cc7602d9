"""The seed of conftest: every report against hand-derived results."""

import pytest
from conftest import EDGE, LATEST, PREV, SEED_SCHEMA, seed_rows

from pricelens import operators as ops


def winners(df, pct):
    return {(r["store"], r["product_id"], r[pct], r["rank"]) for r in df.collect()}


def test_price_changes(seed):
    pc = ops.price_changes(seed)
    rows = pc.collect()
    assert sorted(r.product_id for r in rows) == [
        "beans", "bread", "brush", "milk", "oil", "rice", "salt", "soap", "tea", "towel"]
    assert {r.scrape_date for r in rows} == {LATEST}
    assert all(r.prev_list_price is not None and r.prev_price is not None for r in rows)


def test_price_changes_lag_equals_join(seed):
    a = ops.price_changes(seed, method="lag")
    b = ops.price_changes(seed, method="join")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_increases(seed):
    got = winners(ops.list_price_increases(ops.price_changes(seed)), "pct_increase")
    assert got == {("north", "milk", 25.0, 1), ("north", "bread", 10.0, 2),
                   ("south", "soap", 150.0, 1), ("south", "brush", 20.0, 2)}


def test_decreases(seed):
    got = winners(ops.list_price_decreases(ops.price_changes(seed)), "pct_decrease")
    assert got == {("north", "rice", 25.0, 1), ("north", "beans", 10.0, 2), ("south", "towel", 25.0, 1)}


def test_discounts(seed):
    got = winners(ops.discounts(ops.price_changes(seed)), "pct_decrease")
    assert got == {("north", "tea", 75.0, 1), ("north", "salt", 30.0, 2), ("south", "towel", 40.0, 1)}


def test_avg_deals(seed):
    rows = ops.avg_deals_30d(seed).collect()
    got = {(r.store, r.product_id, r.avg_price_30d, r.current_price, r.pct_discount, r["rank"]) for r in rows}
    assert got == {
        ("north", "lamp", 300.0, 60.0, 80.0, 1), ("north", "tea", 64.0, 16.0, 75.0, 2),
        ("north", "chair", 250.0, 150.0, 40.0, 3), ("north", "salt", 10.0, 7.0, 30.0, 4),
        ("south", "desk", 800.0, 200.0, 75.0, 1), ("south", "towel", 110.0, 66.0, 40.0, 2),
    }


def test_report_columns(seed):
    pc = ops.price_changes(seed)
    assert ops.list_price_increases(pc).columns[-6:] == [
        "scrape_date", "prev_list_price", "current_list_price", "price_increase", "pct_increase", "rank"]
    assert "image" in ops.discounts(pc).columns and "prev_price" in ops.discounts(pc).columns


@pytest.mark.parametrize("name,n", [("list_price_increases", 8), ("list_price_decreases", 6),
                                     ("discounts", 6), ("avg_deals_30d", 12)])
def test_histories(seed, name, n):
    pc = ops.price_changes(seed)
    rep = ops.avg_deals_30d(seed) if name == "avg_deals_30d" else getattr(ops, name)(pc)
    assert ops.history(rep, seed).count() == n


def test_histories_single_scan(seed):
    pc = ops.price_changes(seed)
    reps = {"list_price_increases": ops.list_price_increases(pc), "discounts": ops.discounts(pc)}
    h = ops.histories(reps, seed)
    counts = {r["report"]: r["count"] for r in h.groupBy("report").count().collect()}
    assert counts == {"list_price_increases": 8, "discounts": 6}


def test_thirty_one_days_is_outside(spark):
    import datetime as dt
    rows = seed_rows([("OLD", "store_a", "o", "b", "l", "i", True, EDGE - dt.timedelta(days=1), 500.0, 500.0),
                      ("OLD", "store_a", "o", "b", "l", "i", True, LATEST, 100.0, 100.0)])
    df = spark.createDataFrame(rows, SEED_SCHEMA)
    assert "OLD" not in {r.product_id for r in ops.avg_deals_30d(df).collect()}


def test_rank_cut_with_ties(spark):
    prev = PREV
    rows = []
    for i in range(25):
        pid = f"T{i:02d}"
        rows += [(pid, "s", "n", "b", "l", "i", True, prev, 100.0, 100.0),
                 (pid, "s", "n", "b", "l", "i", True, LATEST, 130.0, 100.0)]
    df = spark.createDataFrame(rows, SEED_SCHEMA)
    rep = ops.list_price_increases(ops.price_changes(df)).collect()
    assert [r["rank"] for r in rep] == list(range(1, 21))
    assert [r.product_id for r in rep] == [f"T{i:02d}" for i in range(20)]


def test_missing_previous_and_unavailable(spark):
    prev = PREV
    rows = [("A", "s", "n", "b", "l", "i", True, LATEST, 200.0, 200.0),                      # only latest
            ("B", "s", "n", "b", "l", "i", True, prev, 100.0, 100.0),
            ("B", "s", "n", "b", "l", "i", None, LATEST, 200.0, 200.0),                      # NULL availability
            ("C", "s", "n", "b", "l", "i", True, prev, 0.0, 100.0),
            ("C", "s", "n", "b", "l", "i", True, LATEST, 200.0, 200.0),                      # zero prev list
            ("D", "s", "n", "b", "l", "i", True, prev, None, 100.0),
            ("D", "s", "n", "b", "l", "i", True, LATEST, 200.0, 200.0)]                      # NULL prev list
    df = spark.createDataFrame(rows, SEED_SCHEMA)
    assert ops.price_changes(df).count() == 0
    assert ops.price_changes(df, method="lag").count() == 0


def test_empty_report_history_is_typed(seed):
    pc = ops.price_changes(seed).where("false")
    h = ops.history(ops.discounts(pc), seed)
    assert h.count() == 0 and h.columns == ["product_id", "store", "scrape_date", "list_price", "price"]


def test_violations(seed, spark):
    pc = ops.price_changes(seed)
    for name in ["list_price_increases", "list_price_decreases", "discounts"]:
        assert ops.report_violations(getattr(ops, name)(pc), name).count() == 0
    assert ops.report_violations(ops.avg_deals_30d(seed), "avg_deals_30d").count() == 0
    from pyspark.sql import functions as F
    bad = ops.list_price_increases(pc).withColumn("rank", F.col("rank") * 2)
    rules = {r.rule for r in ops.report_violations(bad, "list_price_increases").collect()}
    assert "rank_gap" in rules


def test_feed(seed):
    pc = ops.price_changes(seed)
    reps = {"list_price_increases": ops.list_price_increases(pc),
            "list_price_decreases": ops.list_price_decreases(pc),
            "discounts": ops.discounts(pc), "avg_deals_30d": ops.avg_deals_30d(seed)}
    feed = ops.dashboard_feed(reps, seed)
    assert feed.count() == 8 + 6 + 6 + 12
    tabs = {r.tab for r in feed.collect()}
    assert tabs == {"list_increase", "list_decrease", "price_decrease", "best_deals"}


def test_report_stores_and_labels(seed):
    pc = ops.price_changes(seed)
    assert [r.store for r in ops.report_stores(ops.discounts(pc)).collect()] == ["north", "south"]
    entries = ops.with_labels(ops.report_entries({"list_price_increases": ops.list_price_increases(pc)}))
    labels = {r.product_id: r.label for r in entries.collect()}
    assert labels["milk"] == "▲ 25.0%  ($40.00 → $50.00)"


def test_stamp_date_and_maincatid(spark):
    import datetime as dt

    from pricelens.functions import stamp_date
    from pricelens.sources.products import with_maincatid
    df = spark.createDataFrame([("/12/34/56/",)], "category_path string")
    r = with_maincatid(stamp_date(df, "2026-04-13")).collect()[0]
    assert r.maincatid == "12" and r.scrape_date == dt.date(2026, 4, 13)


def test_single_snapshot_gives_typed_empty_changes(spark):
    rows = [r for r in seed_rows() if r[7] == LATEST]
    df = spark.createDataFrame(rows, SEED_SCHEMA)
    for method in ("join", "lag"):
        pc = ops.price_changes(df, method=method)
        assert pc.count() == 0 and "price_pct_change" in pc.columns
    assert ops.list_price_increases(ops.price_changes(df)).count() == 0
