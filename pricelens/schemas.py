"""Declared schemas (no inference anywhere)."""

from pyspark.sql import types as T

S, D, B, DT, I = T.StringType(), T.DoubleType(), T.BooleanType(), T.DateType(), T.IntegerType()

# Snapshot panel, one row per (product_id, store, scrape_date).
PRODUCTS = T.StructType([
    T.StructField("product_id", S), T.StructField("store", S), T.StructField("scrape_date", DT),
    T.StructField("name", S), T.StructField("brand", S), T.StructField("maincat", S),
    T.StructField("cat", S), T.StructField("subcat", S), T.StructField("catid", S),
    T.StructField("image", S), T.StructField("price", D), T.StructField("pricewithoutdiscount", D),
    T.StructField("list_price", D), T.StructField("is_available", B), T.StructField("link", S),
])
PRODUCT_COLUMNS = [f.name for f in PRODUCTS.fields]
PRODUCT_KEY = ["product_id", "store", "scrape_date"]
# Partition layout of the stored table (directory order).
PARTITION_COLUMNS = ["scrape_date", "store", "maincatid"]
PRODUCTS_STORED = T.StructType(PRODUCTS.fields + [T.StructField("maincatid", S)])

# The ten columns every analysis reads.
ANALYSIS_COLUMNS = ["product_id", "store", "name", "brand", "link", "image",
                    "is_available", "scrape_date", "list_price", "price"]

CATEGORIES = T.StructType([
    T.StructField("id", S), T.StructField("store", S), T.StructField("name", S, False),
    T.StructField("parent_id", S), T.StructField("path", S), T.StructField("level", I),
    T.StructField("link", S),
])
CATEGORY_KEY = ["id", "store"]

HISTORY_COLUMNS = ["product_id", "store", "scrape_date", "list_price", "price"]

# Report outputs (column order of the published CSV headers).
INCREASES_COLUMNS = ["name", "product_id", "brand", "store", "link", "image", "scrape_date",
                     "prev_list_price", "current_list_price", "price_increase", "pct_increase", "rank"]
DECREASES_COLUMNS = ["name", "product_id", "brand", "is_available", "store", "link", "image",
                     "scrape_date", "prev_list_price", "current_list_price", "price_decrease",
                     "pct_decrease", "rank"]
DISCOUNTS_COLUMNS = ["name", "product_id", "brand", "store", "link", "image", "scrape_date",
                     "prev_price", "current_price", "price_decrease", "pct_decrease", "rank"]
DEALS_COLUMNS = ["name", "product_id", "brand", "store", "link", "image", "current_price",
                 "avg_price_30d", "pct_discount", "rank"]

REPORT_SCHEMAS = {
    "list_price_increases": T.StructType([
        *(T.StructField(c, S) for c in ["name", "product_id", "brand", "store", "link", "image"]),
        T.StructField("scrape_date", DT),
        *(T.StructField(c, D) for c in ["prev_list_price", "current_list_price",
                                         "price_increase", "pct_increase"]),
        T.StructField("rank", I)]),
    "list_price_decreases": T.StructType([
        *(T.StructField(c, S) for c in ["name", "product_id", "brand"]),
        T.StructField("is_available", B),
        *(T.StructField(c, S) for c in ["store", "link", "image"]),
        T.StructField("scrape_date", DT),
        *(T.StructField(c, D) for c in ["prev_list_price", "current_list_price",
                                         "price_decrease", "pct_decrease"]),
        T.StructField("rank", I)]),
    "discounts": T.StructType([
        *(T.StructField(c, S) for c in ["name", "product_id", "brand", "store", "link", "image"]),
        T.StructField("scrape_date", DT),
        *(T.StructField(c, D) for c in ["prev_price", "current_price", "price_decrease",
                                         "pct_decrease"]),
        T.StructField("rank", I)]),
    "avg_deals_30d": T.StructType([
        *(T.StructField(c, S) for c in ["name", "product_id", "brand", "store", "link", "image"]),
        *(T.StructField(c, D) for c in ["current_price", "avg_price_30d", "pct_discount"]),
        T.StructField("rank", I)]),
}

HISTORY = T.StructType([
    T.StructField("product_id", S), T.StructField("store", S), T.StructField("scrape_date", DT),
    T.StructField("list_price", D), T.StructField("price", D),
])

# --- raw landed payloads -------------------------------------------------

_OFFER = T.StructType([
    T.StructField("Price", D), T.StructField("PriceWithoutDiscount", D),
    T.StructField("ListPrice", D), T.StructField("IsAvailable", B),
])
CATALOG_A_PRODUCT = T.StructType([
    T.StructField("productId", S), T.StructField("productName", S), T.StructField("brand", S),
    T.StructField("categories", T.ArrayType(S)), T.StructField("categoriesIds", T.ArrayType(S)),
    T.StructField("link", S),
    T.StructField("items", T.ArrayType(T.StructType([
        T.StructField("itemId", S),
        T.StructField("images", T.ArrayType(T.StructType([T.StructField("imageUrl", S)]))),
        T.StructField("sellers", T.ArrayType(T.StructType([
            T.StructField("commertialOffer", _OFFER)]))),
    ]))),
])
SIMULATION_A = T.StructType([
    T.StructField("items", T.ArrayType(T.StructType([
        T.StructField("id", S), T.StructField("price", D), T.StructField("listPrice", D),
        T.StructField("availability", S),
    ]))),
])
CATALOG_B_PRODUCT = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("productData", T.StructType([
        T.StructField("name", S), T.StructField("brand", T.StructType([T.StructField("name", S)])),
        T.StructField("url", S), T.StructField("availability", S),
    ])),
    T.StructField("categories", T.ArrayType(T.StructType([
        T.StructField("id", T.LongType()), T.StructField("name", S)]))),
    T.StructField("media", T.ArrayType(T.StructType([T.StructField("url", S)]))),
    T.StructField("priceData", T.StructType([
        T.StructField("prices", T.ArrayType(T.StructType([
            T.StructField("id", S),
            T.StructField("value", T.StructType([T.StructField("centUnitAmount", D)])),
        ]))),
    ])),
])
CATALOG_B_PAGE = T.StructType([
    T.StructField("totalCount", T.LongType()),
    T.StructField("products", T.ArrayType(CATALOG_B_PRODUCT)),
])


def tree_schema(child_field: str) -> T.StructType:
    """Three-level category tree node; children under ``child_field``."""
    leaf = T.StructType([T.StructField("id", S), T.StructField("name", S)])
    mid = T.StructType([T.StructField("id", S), T.StructField("name", S),
                        T.StructField(child_field, T.ArrayType(leaf))])
    return T.StructType([T.StructField("id", S), T.StructField("name", S),
                         T.StructField(child_field, T.ArrayType(mid))])


TREE_A = tree_schema("children")
TREE_B = tree_schema("subcategories")
