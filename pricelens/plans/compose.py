"""Raw store payloads composed by Spark from the benchmark tables.

The normalisers need landed JSON documents; these builders write such
documents (``to_json`` of nested structs) from ``part``, ``supplier``,
``nation`` and ``region`` so the normaliser jobs run over data that
grows with the tables.  Page documents group a fixed number of products
(PAGE_SIZE), so no document grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.plans.panels import table

# Fixed values of the composed payloads.
PAGE_SIZE = 24
BASE_A = "https://shop-a.example.com"
BASE_B = "https://shop-b.example.com/c/"


def _part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type",
                                               "p_size", "p_retailprice")


def _cents(x):
    return F.floor(x + 0.5) / 100


def catalog_a_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One catalogue-A product document per part (column ``json``)."""
    p = _part(spark, sf_dir)
    k = F.col("p_partkey").cast("string")
    size = F.col("p_size").cast("string")
    leaf = F.concat(F.lit("/"), F.col("p_type"), F.lit("/"), F.col("p_brand"), F.lit("/"), size, F.lit("/"))
    mid = F.concat(F.lit("/"), F.col("p_type"), F.lit("/"), F.col("p_brand"), F.lit("/"))
    top = F.concat(F.lit("/"), F.col("p_type"), F.lit("/"))
    cats = F.when(F.col("p_size") >= 5, F.array(leaf, mid, top)).otherwise(F.array(mid, top))
    image = F.struct(F.concat(F.lit("https://img-a.example.com/"), k, F.lit(".jpg")).alias("imageUrl"))
    images = F.when(F.col("p_size") % 2 == 0, F.array(image)).otherwise(F.array().cast("array<struct<imageUrl:string>>"))
    offer = F.struct(
        _cents(F.col("p_retailprice") * 90).alias("Price"),
        F.col("p_retailprice").alias("PriceWithoutDiscount"),
        F.col("p_retailprice").alias("ListPrice"),
        (F.col("p_size") > 3).alias("IsAvailable"))
    item = F.struct(F.concat(k, F.lit("-1")).alias("itemId"), images.alias("images"),
                    F.array(F.struct(offer.alias("commertialOffer"))).alias("sellers"))
    doc = F.struct(k.alias("productId"), F.col("p_name").alias("productName"),
                   F.col("p_brand").alias("brand"), cats.alias("categories"),
                   F.array(size, F.col("p_type")).alias("categoriesIds"),
                   F.concat(F.lit(BASE_A + "/p/"), k).alias("link"),
                   F.array(item).alias("items"))
    return p.select(F.to_json(doc).alias("json"))


def simulation_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One simulation document per part; amounts in hundredths, some unavailable or unpriced."""
    p = _part(spark, sf_dir)
    k = F.col("p_partkey").cast("string")
    item = F.struct(
        F.concat(k, F.lit("-1")).alias("id"),
        F.when(F.col("p_size") <= 45, F.floor(F.col("p_retailprice") * 95 + 0.5)).alias("price"),
        F.floor(F.col("p_retailprice") * 100 + 0.5).alias("listPrice"),
        F.when(F.col("p_size") % 3 == 0, F.lit("unavailable")).otherwise(F.lit("available")).alias("availability"))
    return p.select(F.to_json(F.struct(F.array(item).alias("items"))).alias("json"))


def catalog_b_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue-B pages of PAGE_SIZE products each (``{totalCount, products}``)."""
    p = _part(spark, sf_dir)
    k = F.col("p_partkey")
    retail = F.col("p_retailprice")
    offer = _cents(retail * 80)

    def entry(kind, amount):
        return F.struct(F.lit(kind).alias("id"), F.struct(amount.alias("centUnitAmount")).alias("value"))

    prices = (F.when(F.col("p_size") % 3 == 0, F.array(entry("PRICE", retail), entry("OFFER_PRICE", offer)))
              .when(F.col("p_size") % 3 == 1, F.array(entry("OFFER_PRICE", offer), entry("PRICE", retail)))
              .otherwise(F.array(entry("PRICE", retail))))
    avail = (F.when(F.col("p_size") % 4 == 0, F.lit("true")).when(F.col("p_size") % 4 == 1, F.lit("TRUE"))
             .when(F.col("p_size") % 4 == 2, F.lit("1")).otherwise(F.lit("no")))
    media = F.when(F.col("p_size") % 2 == 1,
                   F.array(F.struct(F.concat(F.lit("https://img-b.example.com/"), k.cast("string"),
                                             F.lit(".png")).alias("url"))))
    cats = F.array(
        F.struct(F.col("p_size").cast("long").alias("id"), F.col("p_type").alias("name")),
        F.struct((F.col("p_size") + 100).cast("long").alias("id"), F.col("p_brand").alias("name")),
        F.struct((F.col("p_size") + 200).cast("long").alias("id"),
                 F.concat(F.lit("size "), F.col("p_size").cast("string")).alias("name")))
    product = F.struct(
        k.alias("id"),
        F.struct(F.col("p_name").alias("name"), F.struct(F.col("p_brand").alias("name")).alias("brand"),
                 F.concat(F.lit("https://shop-b.example.com/p/"), k.cast("string")).alias("url"),
                 avail.alias("availability")).alias("productData"),
        cats.alias("categories"), media.alias("media"),
        F.struct(prices.alias("prices")).alias("priceData"))
    pages = (p.select(F.floor(k / PAGE_SIZE).alias("page"), product.alias("product"))
             .groupBy("page").agg(F.collect_list("product").alias("products")))
    return pages.select(F.to_json(F.struct(F.size("products").cast("long").alias("totalCount"),
                                           "products")).alias("json"))


def tree_docs(spark: SparkSession, sf_dir: str, child_field: str) -> DataFrame:
    """One 3-level tree document per supplier: region > nation > supplier."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    j = s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    leaf = F.struct((F.col("s_suppkey") + 10000).cast("string").alias("id"), F.col("s_name").alias("name"))
    mid = F.struct((F.col("n_nationkey") + 100).cast("string").alias("id"), F.col("n_name").alias("name"),
                   F.array(leaf).alias(child_field))
    top = F.struct((F.col("r_regionkey") + 1).cast("string").alias("id"), F.col("r_name").alias("name"),
                   F.array(mid).alias(child_field))
    return j.select(F.col("s_suppkey").alias("seq"), F.to_json(F.array(top)).alias("json"))


# --- landed files ----------------------------------------------------------------------

def land_documents(docs: DataFrame, path: str, part: int) -> None:
    """Write documents (column ``json``), one a line, as the ``part``-th load under ``path``."""
    docs.select("json").write.mode("append").text(f"{path}/{part:04d}")


def broken_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents cut off in the middle, one per nation (column ``json``)."""
    return table(spark, sf_dir, "nation").select(F.concat(F.lit('{"totalCount": 1, "products": [{"name": "'), "n_name").alias("json"))


def superseded_simulation_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An earlier simulation of every part: twice the later price, all available."""
    p = _part(spark, sf_dir)
    item = F.struct(
        F.concat(F.col("p_partkey").cast("string"), F.lit("-1")).alias("id"),
        F.floor(F.col("p_retailprice") * 190 + 0.5).alias("price"),
        F.floor(F.col("p_retailprice") * 200 + 0.5).alias("listPrice"), F.lit("available").alias("availability"))
    return p.select(F.to_json(F.struct(F.array(item).alias("items"))).alias("json"))


#: Suppliers of one landed tree file at most.
TREE_FILE = 200


def tree_files(spark: SparkSession, sf_dir: str, child_field: str) -> DataFrame:
    """Category trees as indented arrays that span many lines: one document a nation and block of suppliers.

    Columns ``doc`` (names the document) and ``json``; a document holds at most TREE_FILE suppliers.
    """
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    leaf = F.struct((F.col("s_suppkey") + 10000).cast("string").alias("id"), F.col("s_name").alias("name"))
    grouped = (s.groupBy("s_nationkey", F.floor(F.col("s_suppkey") / TREE_FILE).alias("block"))
               .agg(F.collect_list(leaf).alias(child_field))
               .join(n, F.col("s_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey")))
    mid = F.struct((F.col("n_nationkey") + 100).cast("string").alias("id"), F.col("n_name").alias("name"), F.col(child_field))
    top = F.struct((F.col("r_regionkey") + 1).cast("string").alias("id"), F.col("r_name").alias("name"),
                   F.array(mid).alias(child_field))
    return grouped.select(F.concat_ws("-", "n_nationkey", "block").alias("doc"),
                          F.to_json(F.array(top), {"pretty": "true"}).alias("json"))


# --- sitemaps and listing pages -----------------------------------------------------------

#: Locations of one composed sitemap.
SITEMAP_SIZE = 40


def _xml(x):
    return F.replace(F.replace(x, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def sitemap_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sitemaps of SITEMAP_SIZE page URLs each and, for each of them, an index that names it (column ``xml``).

    Locations stand plain, between blanks and line ends, or in CDATA; comments hold locations that are not listed.
    """
    u = table(spark, sf_dir, "pages").where("url IS NOT NULL").select("page_id", "url")
    k = F.col("page_id")
    loc = (F.when(k % 5 == 0, F.concat(F.lit("<loc><![CDATA["), "url", F.lit("]]></loc>")))
           .when(k % 5 == 1, F.concat(F.lit("<loc>\n  "), _xml(F.col("url")), F.lit("\n</loc >")))
           .when(k % 5 == 2, F.concat(F.lit("<loc a=\"b\">"), _xml(F.col("url")), F.lit("</loc><!-- <loc>no</loc> -->")))
           .otherwise(F.concat(F.lit("<loc>"), _xml(F.col("url")), F.lit("</loc>"))))
    entry = F.concat(F.lit("<url>"), loc, F.lit("<lastmod>2026-01-06</lastmod></url>"))
    docs = u.select(F.floor(k / SITEMAP_SIZE).alias("map"), entry.alias("entry")).groupBy("map").agg(F.collect_list("entry").alias("entries"))
    head = '<?xml version="1.0" encoding="UTF-8"?>'
    maps = docs.select(F.concat(F.lit(head + "<urlset>"), F.array_join("entries", "\n"), F.lit("</urlset>")).alias("xml"))
    index = docs.select(F.concat(F.lit(head + "<sitemapindex><sitemap><loc>https://maps.example.com/"), F.col("map").cast("string"),
                                 F.lit(".xml</loc></sitemap></sitemapindex>")).alias("xml"))
    return maps.unionByName(index)


def relative_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page URLs as (url_index, url): absolute, protocol-relative, from the root, and without a leading slash."""
    p = table(spark, sf_dir, "pages").where("url IS NOT NULL").select("page_id", "url")
    bare = F.substring_index(F.col("url"), "://", -1)
    slash = F.instr(bare, "/")
    tail = F.when(slash > 0, F.substring(bare, slash, F.length(bare))).otherwise(F.lit(""))
    form = (F.when(F.col("page_id") % 4 == 0, F.col("url")).when(F.col("page_id") % 4 == 1, F.concat(F.lit("//"), bare))
            .when(F.col("page_id") % 4 == 2, tail).otherwise(F.ltrim(tail, F.lit("/"))))
    return p.select(F.col("page_id").alias("url_index"), form.alias("url"))


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing pages of PAGE_SIZE product tiles each, as (page_id, html).

    Tiles differ in quotes, extra classes and nesting, some lack a part,
    and between them stand parts that belong to no tile.
    """
    p = _part(spark, sf_dir)
    k, size = F.col("p_partkey"), F.col("p_size")
    key = k.cast("string")
    opening = (F.when(size % 3 == 0, F.concat(F.lit("<div class=\"product\" data-pid=\""), key, F.lit("\">")))
               .when(size % 3 == 1, F.concat(F.lit("<DIV data-pid='"), key, F.lit("' class='wide product  tile'>")))
               .otherwise(F.lit("<div id=\"x\" class=\"product\">")))
    name = F.concat(F.lit("<span>"), _xml(F.col("p_name")), F.lit("</span> &amp; "), _xml(F.col("p_brand")))
    link = F.when(size % 7 != 0, F.concat(F.lit("<a title=\"t\" class='product-tile--link' href='/p/"), key, F.lit("?a=1&amp;b=2'>\n "),
                                          name, F.lit(" </a>"))).otherwise(F.lit("<a class=\"product-tile--links\" href=\"/no\">no</a>"))
    price = F.when(size % 5 != 0, F.concat(F.lit("<div><span class=\"cart-price\"> $"), F.col("p_retailprice").cast("string"),
                                           F.lit(" </span></div>"))).otherwise(F.lit("<div><span class=\"price\">$0</span></div>"))
    image = F.when(size % 4 != 0, F.concat(F.lit("<img src=\"/i/"), key, F.lit(".jpg\" class=\"tile-image big\"/>"))).otherwise(F.lit(""))
    between = F.lit("<p><a class=\"product-tile--link\" href=\"/between\">between</a><span class=\"cart-price\">$1</span></p>\n")
    tile = F.concat(opening, F.lit("<div class=\"inner\">"), link, F.lit("</div>"), price, image, F.lit("</div>"), between)
    pages = (p.select(F.floor(k / PAGE_SIZE).alias("page_id"), F.struct(k, tile.alias("tile")).alias("t"))
             .groupBy("page_id").agg(F.array_sort(F.collect_list("t")).alias("ts")))
    return pages.select("page_id", F.concat(F.lit("<html><body><div class=\"product-grid\">"), F.array_join("ts.tile", ""),
                                            F.lit("</div></body></html>")).alias("html"))


# --- dirty and broken tables ----------------------------------------------------------------

def dirty_batch(products: DataFrame) -> DataFrame:
    """Product rows as a scraper lands them: text in every column, some of it no number, a scraped category path."""
    k = F.col("product_id").cast("long")
    money = (F.when(k % 11 == 0, F.lit("n/a")).when(k % 11 == 1, F.concat(F.lit(" "), F.col("price").cast("string"), F.lit(" ")))
             .when(k % 11 == 2, F.lit("")).otherwise(F.col("price").cast("string")))
    return products.select(
        "product_id", "store", F.col("scrape_date").cast("string").alias("scrape_date"), "name", "brand", "maincat", "cat", "subcat",
        "catid", "image", money.alias("price"), F.col("pricewithoutdiscount").cast("string").alias("pricewithoutdiscount"),
        F.when(k % 13 == 0, F.lit("-")).otherwise(F.col("list_price").cast("string")).alias("list_price"),
        F.when(k % 5 == 0, F.lit("maybe")).otherwise(F.col("is_available").cast("string")).alias("is_available"), "link",
        F.concat(F.lit("//"), F.col("maincatid"), F.lit("/x/")).alias("category_path"))


def broken_report(report: DataFrame) -> DataFrame:
    """A discounts report in which every rule is broken, depending on the rank."""
    r = F.col("rank")
    return report.where(r != 9).withColumns({
        "pct_decrease": F.when(r == 2, 0.0).when(r == 3, F.lit(None)).when(r == 4, 99999.0).otherwise(F.col("pct_decrease")),
        "prev_price": F.when(r == 5, F.lit(None)).otherwise(F.col("prev_price")),
        "current_price": F.when(r == 6, F.col("prev_price") + 1).otherwise(F.col("current_price")),
        "rank": F.when(r == 7, 8).when(r == 20, 25).otherwise(r)})


def broken_changes(changes: DataFrame) -> DataFrame:
    """``price_changes`` rows of which some break each rule, depending on the product."""
    k = F.col("product_id").cast("long") % 20
    out = changes.withColumns({
        "scrape_date": F.when(k == 1, F.date_sub("scrape_date", 7)).otherwise(F.col("scrape_date")),
        "is_available": F.when(k == 2, F.lit(None)).when(k == 3, False).otherwise(F.col("is_available")),
        "prev_price": F.when(k == 4, 0.0).when(k == 5, F.lit(None)).when(k == 6, F.col("price")).otherwise(F.col("prev_price")),
        "prev_list_price": F.when(k == 6, F.col("list_price")).otherwise(F.col("prev_list_price"))})
    return out.unionByName(out.where(k == 7))
