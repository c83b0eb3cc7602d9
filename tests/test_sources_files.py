"""File sources: landed JSON (with a malformed line), sitemap XML, catalog partition refresh."""

import json
import os

from pricelens.schemas import CATALOG_B_PAGE, PRODUCTS_STORED
from pricelens.sources import normalise as N
from pricelens.sources import products as P
from pricelens.sources.sitemap import read_sitemap, url_hierarchy


def test_landed_json_pages(spark, tmp_root):
    path = os.path.join(tmp_root, "landing")
    os.makedirs(path)
    page = {"totalCount": 1, "products": [{"id": 5, "productData": {"name": "x", "availability": "true"},
                                            "priceData": {"prices": [{"id": "PRICE",
                                                                      "value": {"centUnitAmount": 3.5}}]}}]}
    with open(os.path.join(path, "p1.json"), "w") as f:
        f.write(json.dumps(page) + "\n")
        f.write("{not json\n")
    docs = N.read_json(spark, path, CATALOG_B_PAGE).selectExpr("struct(*) AS doc")
    rows = N.catalog_b_rows(docs, "sb").collect()
    assert [(r.product_id, r.price, r.is_available) for r in rows] == [("5", 3.5, True)]


def test_sitemap_xml(spark, tmp_root):
    path = os.path.join(tmp_root, "sitemap.xml")
    with open(path, "w") as f:
        f.write('<?xml version="1.0"?><urlset>'
                "<url><loc> https://s.example/vinos-y-licores/vinos/ </loc></url>"
                "<url><loc>https://s.example/vinos-y-licores/cervezas</loc></url>"
                "<url><loc>https://s.example/frutas</loc></url></urlset>")
    urls = read_sitemap(spark, path)
    assert [r.url for r in urls.orderBy("url_index").collect()] == [
        "https://s.example/vinos-y-licores/vinos/", "https://s.example/vinos-y-licores/cervezas",
        "https://s.example/frutas"]
    got = sorted((r.id, r.name, r.parent_id, r.path, r.level) for r in url_hierarchy(urls, "s").collect())
    assert got == [(1001, "Vinos Y Licores", 0, "/vinos-y-licores/", 1),
                   (1002, "Vinos", 1001, "/vinos-y-licores/vinos/", 2),
                   (1003, "Cervezas", 1001, "/vinos-y-licores/cervezas/", 2),
                   (1004, "Frutas", 0, "/frutas/", 1)]


def test_catalog_table_refresh(spark, tmp_root):
    import datetime as dt
    root = os.path.join(tmp_root, "products")
    r = ("p1", "s1", dt.date(2026, 4, 13), "n", "b", "mc", "c", "sc", "/m/", "i", 1.0, 1.0, 1.0, True, "l", "m")
    P.write_products(spark.createDataFrame([r], PRODUCTS_STORED), root)
    P.register_table(spark, "products_tbl", root)
    assert spark.table("products_tbl").count() == 1
    r2 = ("p2",) + r[1:2] + (dt.date(2026, 4, 14),) + r[3:]
    P.write_products(spark.createDataFrame([r2], PRODUCTS_STORED), root)
    P.refresh_table(spark, "products_tbl")
    assert spark.table("products_tbl").count() == 2
    import shutil
    shutil.rmtree(os.path.join(root, "scrape_date=2026-04-13"))
    P.refresh_table(spark, "products_tbl")
    assert [r.product_id for r in spark.table("products_tbl").collect()] == ["p2"]
    spark.sql("DROP TABLE products_tbl")


def test_landed_json_quarantine(spark, tmp_root):
    path = os.path.join(tmp_root, "landing_q")
    os.makedirs(path)
    good_page = {"totalCount": 1, "products": [{"id": 7, "productData": {"name": "y", "availability": "1"}}]}
    with open(os.path.join(path, "p1.json"), "w") as f:
        f.write(json.dumps(good_page) + "\n")
        f.write('{"totalCount": 2, "products": [broken\n')
    good, bad = N.read_json_checked(spark, path, CATALOG_B_PAGE)
    rows = N.catalog_b_rows(good.selectExpr("struct(*) AS doc"), "sb").collect()
    assert [(r.product_id, r.is_available) for r in rows] == [("7", True)]
    quarantined = bad.collect()
    assert len(quarantined) == 1 and quarantined[0].raw.startswith('{"totalCount": 2')
    assert quarantined[0].file.endswith("p1.json")


def test_cli_ingest_and_refresh(spark, tmp_root, capsys):
    from pricelens.__main__ import main
    landing = os.path.join(tmp_root, "cat_b")
    os.makedirs(landing)

    def page(price, offer):
        return {"totalCount": 1, "products": [{
            "id": 9, "productData": {"name": "p9", "brand": {"name": "B"}, "url": "/p/9", "availability": "true"},
            "categories": [{"id": 31, "name": "Top"}],
            "priceData": {"prices": [{"id": "PRICE", "value": {"centUnitAmount": price}},
                                     {"id": "OFFER_PRICE", "value": {"centUnitAmount": offer}}]}}]}
    root, out = os.path.join(tmp_root, "products"), os.path.join(tmp_root, "out")
    for day, (price, offer) in (("2026-04-06", (10.0, 10.0)), ("2026-04-13", (12.0, 9.0))):
        path = os.path.join(landing, day)
        os.makedirs(path)
        with open(os.path.join(path, "page.json"), "w") as f:
            f.write(json.dumps(page(price, offer)) + "\n")
            f.write("{truncated\n")
        q = os.path.join(tmp_root, "quarantine", day)
        assert main(["ingest", "catalog_b", path, root, "--store", "sb", "--date", day, "--category", "/31/7/",
                     "--quarantine", q]) == 0
        assert spark.read.parquet(q).count() == 1
        assert {r.maincatid for r in P.read_products(spark, root).collect()} == {"31"}
    assert main(["refresh", root, out, "--no-csv"]) == 0
    printed = capsys.readouterr().out
    assert "'price_changes': 1" in printed and "'list_price_increases': 1" in printed
    assert "'discounts': 1" in printed


def test_broken_simulation_line_leaves_products_available(spark):
    rows = spark.createDataFrame([("1", 5.0, 5.0, 6.0, True), ("2", 7.0, 7.0, 8.0, True), ("3", 7.0, 7.0, 8.0, False)],
                                 "sku string, price double, pricewithoutdiscount double, list_price double, is_available boolean")
    sim = spark.createDataFrame([("1", 4.0, 6.0)], "sku string, sim_price double, sim_list_price double")
    whole = sorted((r.price, r.is_available) for r in N.apply_simulation(rows, sim).collect())
    partial = sorted((r.price, r.is_available) for r in N.apply_simulation(rows, sim, partial=True).collect())
    assert whole == [(4.0, True), (7.0, False), (7.0, False)]
    assert partial == [(4.0, True), (7.0, False), (7.0, True)]
