"""Nested payload normalisers on hand-written documents (edge cases)."""

import json

from pricelens.schemas import CATALOG_A_PRODUCT, CATALOG_B_PAGE, SIMULATION_A
from pricelens.sources import normalise as N


def docs(spark, items, schema):
    df = spark.createDataFrame([(json.dumps(x),) for x in items], "json string")
    return N.parse_json(df, "json", schema)


A_FULL = {"productId": "10", "productName": "Leche", "brand": "B",
          "categories": ["/a/b/c/", "/a/b/", "/a/"], "categoriesIds": ["/1/2/3/"], "link": "/leche/p",
          "items": [{"itemId": "sku1", "images": [{"imageUrl": "http://i/1.jpg"}],
                     "sellers": [{"commertialOffer": {"Price": 9.5, "PriceWithoutDiscount": 10.0,
                                                      "ListPrice": 12.0, "IsAvailable": True}}]}]}
A_BARE = {"productId": "11", "productName": "Pan", "categories": ["/a/"], "items": [{"itemId": "sku2"}]}


def test_catalog_a_fields_and_missing_parts(spark):
    rows = {r.product_id: r for r in N.apply_simulation(
        N.catalog_a_rows(docs(spark, [A_FULL, A_BARE], CATALOG_A_PRODUCT), "sa"), None).collect()}
    a = rows["10"]
    assert (a.maincat, a.cat, a.subcat, a.catid, a.image) == ("/a/b/c/", "/a/b/", "/a/", "/1/2/3/", "http://i/1.jpg")
    assert (a.price, a.pricewithoutdiscount, a.list_price, a.is_available) == (9.5, 10.0, 12.0, True)
    b = rows["11"]
    assert b.cat is None and b.image is None and b.price is None and b.is_available is None


def test_simulation_override(spark):
    rows = N.catalog_a_rows(docs(spark, [A_FULL, A_BARE], CATALOG_A_PRODUCT), "sa")
    sim = N.simulated_prices(docs(spark, [{"items": [
        {"id": "sku1", "price": 850, "listPrice": 1100, "availability": "available"},
        {"id": "sku2", "price": None, "listPrice": 500, "availability": "available"}]}], SIMULATION_A))
    got = {r.product_id: (r.price, r.pricewithoutdiscount, r.list_price, r.is_available)
           for r in N.apply_simulation(rows, sim).collect()}
    assert got["10"] == (8.5, 8.5, 11.0, True)
    assert got["11"] == (None, None, None, False)          # not in simulation -> unavailable


def test_empty_simulation_marks_all_unavailable(spark):
    rows = N.catalog_a_rows(docs(spark, [A_FULL], CATALOG_A_PRODUCT), "sa")
    sim = N.simulated_prices(docs(spark, [{"items": []}], SIMULATION_A))
    r = N.apply_simulation(rows, sim).collect()[0]
    assert r.is_available is False and r.price == 9.5


def _b(pid, prices, availability="true", categories=None, media=None):
    return {"id": pid, "productData": {"name": f"p{pid}", "brand": {"name": "B"}, "url": f"/p/{pid}",
                                        "availability": availability},
            "categories": categories if categories is not None else [{"id": 1, "name": "A"}],
            "media": media, "priceData": {"prices": prices}}


def price(kind, amount):
    return {"id": kind, "value": {"centUnitAmount": amount}}


def test_catalog_b_price_fold_order(spark):
    page = {"totalCount": 4, "products": [
        _b(1, [price("PRICE", 10.0), price("OFFER_PRICE", 8.0)]),
        _b(2, [price("OFFER_PRICE", 8.0), price("PRICE", 10.0)], availability="1"),
        _b(3, [], availability="no"),
        _b(4, None, availability=None, categories=[], media=[{"url": "http://m/4"}]),
    ]}
    got = {r.product_id: r for r in N.catalog_b_rows(docs(spark, [page], CATALOG_B_PAGE), "sb").collect()}
    assert (got["1"].price, got["1"].pricewithoutdiscount, got["1"].list_price) == (8.0, 10.0, 10.0)
    assert (got["2"].price, got["2"].list_price, got["2"].is_available) == (10.0, 10.0, True)
    assert got["3"].price is None and got["3"].is_available is False
    assert got["4"].maincat is None and got["4"].catid is None and got["4"].image == "http://m/4"
    assert got["1"].catid == "1" and got["1"].maincat == "A"


def test_tree_rows(spark):
    tree = [{"id": "1", "name": "Main Cat", "children": [
        {"id": "2", "name": "Sub Cat", "children": [{"id": "3", "name": "Leaf"}]},
        {"id": "4", "name": "Empty", "children": []}]}]
    df = spark.createDataFrame([(json.dumps(tree),)], "json string")
    rows = {r.id: r for r in N.normalise(df, "tree_a", "sa", json_col="json", base_url="https://x").collect()}
    assert rows["1"].path == "/1/" and rows["1"].parent_id is None and rows["1"].level == 1
    assert rows["2"].link == "https://x/Main-Cat/Sub-Cat" and rows["2"].parent_id == "1"
    assert rows["3"].path == "/1/2/3/" and rows["3"].level == 3
    assert rows["4"].level == 2
    tree_b = [{"id": "1", "name": "M", "subcategories": [{"id": "2", "name": "S", "subcategories": []}]}]
    df = spark.createDataFrame([(json.dumps(tree_b),)], "json string")
    rows = {r.id: r for r in N.normalise(df, "tree_b", "sb", json_col="json", base_url="https://y/").collect()}
    assert rows["2"].link == "https://y/1/2/"


def test_category_upsert_latest_document_wins(spark):
    old = [{"id": "1", "name": "Old Name", "children": []}]
    new = [{"id": "1", "name": "New Name", "children": [{"id": "2", "name": "Kid", "children": []}]}]
    df = spark.createDataFrame([(1, json.dumps(old)), (2, json.dumps(new))], "seq long, json string")
    rows = {r.id: r for r in N.normalise(df, "tree_a", "sa", json_col="json", base_url="https://x").collect()}
    assert rows["1"].name == "New Name" and rows["1"].link == "https://x/New-Name"
    assert rows["2"].parent_id == "1" and len(rows) == 2
