"""Raw store payloads -> product / category rows (N1-N7), plus a registry.

Payloads are landed as JSON (one document per line) and parsed with a
declared schema; every field access is NULL-safe (``get`` on arrays,
struct fields propagate NULL), so a missing part nulls that field of that
row instead of failing the batch.  All of it is projection, ``explode``
and one left join: no Python per row.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.functions import fold_prices, lenient_bool
from pricelens.operators.upsert import dedup_latest
from pricelens.schemas import (
    CATALOG_A_PRODUCT, CATALOG_B_PAGE, CATEGORIES, SIMULATION_A, TREE_A, TREE_B,
)


# --- S14 / S15: landed JSON sources -----------------------------------------------

CORRUPT = "_corrupt_record"


def read_json(spark: SparkSession, path: str, schema, multiline: bool = False) -> DataFrame:
    """Landed payload files with a declared schema; malformed lines become NULL rows."""
    return (spark.read.schema(schema).option("multiLine", multiline)
            .option("mode", "PERMISSIVE").json(path))


def read_json_checked(spark: SparkSession, path: str, schema,
                      multiline: bool = False) -> tuple[DataFrame, DataFrame]:
    """Landed payloads split into (documents, quarantine).

    Lines that fail to parse do not stop the batch and do not vanish: they
    go to the quarantine frame (file, raw text, fields parsed before the
    error), the counterpart of
    skip-and-log in a scraping loop.  The raw text is kept whole.  Write
    the quarantine frame out before counting it: Spark refuses a raw JSON
    scan that needs only the corrupt-record column (e.g. a bare count).
    """
    with_bad = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    raw = (spark.read.schema(with_bad).option("multiLine", multiline).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", CORRUPT).json(path)
           .withColumn("_file", F.input_file_name()))
    good = raw.where(F.col(CORRUPT).isNull()).drop(CORRUPT, "_file")
    # the fields parsed before the error are kept next to the raw text
    bad = raw.where(F.col(CORRUPT).isNotNull()).select(
        F.col("_file").alias("file"), F.col(CORRUPT).alias("raw"),
        F.struct(*[F.col(f.name) for f in schema.fields]).alias("partial"))
    return good, bad


ARRIVAL = "arrival"


def with_arrival(files: DataFrame) -> DataFrame:
    """Adds ``arrival``, which orders the documents of a file scan: by file time, file name, place in the file."""
    meta = F.col("_metadata")
    return files.withColumn(ARRIVAL, F.struct(
        meta["file_modification_time"].alias("time"), meta["file_path"].alias("file"),
        meta["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("row")))


def read_landed(spark: SparkSession, path: str | list[str], schema, multiline: bool = False) -> tuple[DataFrame, DataFrame]:
    """All landed files of a payload format -> (documents ``doc`` with their ``arrival``, quarantine).

    A file holds one document a line, or with ``multiline`` one document
    (or one array of documents) in all.  Documents that do not parse go to
    the quarantine frame (file, raw text, fields parsed before the
    error).  ``schema`` is a document's; for
    an array schema (category trees) the elements of each top-level array
    are read, and ``doc`` is an array again.  The parsed rows are not
    cached: write the quarantine frame before counting it.
    """
    many = isinstance(schema, T.ArrayType)
    fields = (schema.elementType if many else schema).fields
    with_bad = T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])
    raw = with_arrival(spark.read.schema(with_bad).option("multiLine", multiline).option("mode", "PERMISSIVE")
                       .option("columnNameOfCorruptRecord", CORRUPT).json(path))
    doc = F.struct(*[F.col(f.name) for f in fields])
    good = raw.where(F.col(CORRUPT).isNull()).select((F.array(doc) if many else doc).alias("doc"), ARRIVAL)
    bad = raw.where(F.col(CORRUPT).isNotNull()).select(
        F.col(ARRIVAL)["file"].alias("file"), F.col(CORRUPT).alias("raw"), doc.alias("partial"))
    return good, bad


def parse_json(df: DataFrame, col: str, schema) -> DataFrame:
    """Parse a string column holding one payload document per row."""
    return df.withColumn("doc", F.from_json(F.col(col), schema)).drop(col)


# --- N1-N3: catalogue A ------------------------------------------------------------

def catalog_a_rows(products: DataFrame, store: str) -> DataFrame:
    """Catalogue-A product documents (column ``doc``) -> product rows.

    ``categories[0]`` is the most specific path; positions are kept as the
    source defines them (maincat, cat, subcat = elements 0, 1, 2).
    Carries ``sku`` for the simulation join and any context columns
    (``scrape_date``, ``maincatid``) present next to ``doc``.
    """
    d = F.col("doc")
    item = F.get(d["items"], 0)
    offer = F.get(item["sellers"], 0)["commertialOffer"]
    ctx = [c for c in products.columns if c != "doc"]
    return products.select(
        *ctx,
        d["productId"].alias("product_id"),
        F.lit(store).alias("store"),
        d["productName"].alias("name"),
        d["brand"].alias("brand"),
        F.get(d["categories"], 0).alias("maincat"),
        F.get(d["categories"], 1).alias("cat"),
        F.get(d["categories"], 2).alias("subcat"),
        F.get(d["categoriesIds"], 0).alias("catid"),
        F.get(item["images"], 0)["imageUrl"].alias("image"),
        offer["Price"].alias("price"),
        offer["PriceWithoutDiscount"].alias("pricewithoutdiscount"),
        offer["ListPrice"].alias("list_price"),
        offer["IsAvailable"].alias("is_available"),
        d["link"].alias("link"),
        item["itemId"].alias("sku"),
    )


def simulated_prices(sim_docs: DataFrame) -> DataFrame:
    """Simulation documents -> (sku, sim_price, sim_list_price) in currency units.

    Only available items with a price; amounts arrive in hundredths.
    Of a SKU repeated across documents the last document counts: the one
    with the greatest ``arrival`` (see ``read_landed``) or ``seq``, if there
    is such a column, and inside a document the last item.  Without either
    the greatest prices do, so the result is still fixed.
    """
    order = [c for c in (ARRIVAL, "seq") if c in sim_docs.columns][:1]
    items = sim_docs.select(*order, F.posexplode(F.col("doc")["items"]).alias("at", "it"))
    ok = items.where((F.col("it")["availability"] == "available") & F.col("it")["price"].isNotNull())
    rows = ok.select(F.col("it")["id"].alias("sku"),
                     (F.col("it")["price"] / 100).alias("sim_price"),
                     (F.col("it")["listPrice"] / 100).alias("sim_list_price"), *order, "at")
    by = [*order, "at"] if order else ["sim_price", "sim_list_price"]
    return dedup_latest(rows, ["sku"], by).select("sku", "sim_price", "sim_list_price")


def apply_simulation(rows: DataFrame, sim: DataFrame | None, partial: bool = False) -> DataFrame:
    """Override catalogue prices with simulated ones (left join on SKU).

    * simulation given and SKU found: price = pricewithoutdiscount =
      simulated price, list_price = simulated list price, available;
    * simulation given, SKU absent: catalogue prices, NOT available; with
      ``partial`` (some of its documents could not be read) the row stays as it is;
    * no simulation at all (``sim is None``): rows unchanged.
    """
    if sim is None:
        return rows.drop("sku")
    marked = sim.withColumn("_hit", F.lit(True))
    j = rows.join(marked, "sku", "left")
    found = F.coalesce(F.col("_hit"), F.lit(False))
    return (j.withColumns({
        "price": F.when(found, F.col("sim_price")).otherwise(F.col("price")),
        "pricewithoutdiscount": F.when(found, F.col("sim_price")).otherwise(F.col("pricewithoutdiscount")),
        "list_price": F.when(found, F.col("sim_list_price")).otherwise(F.col("list_price")),
        "is_available": found | F.col("is_available") if partial else found,
    }).drop("sku", "sim_price", "sim_list_price", "_hit"))


# --- N4-N5: catalogue B ----------------------------------------------------------------

def catalog_b_rows(pages: DataFrame, store: str) -> DataFrame:
    """Catalogue-B page documents ``{totalCount, products[]}`` -> product rows."""
    ctx = [c for c in pages.columns if c != "doc"]
    prods = pages.select(*ctx, F.explode(F.col("doc")["products"]).alias("p"))
    p = F.col("p")
    folded = fold_prices(p["priceData"]["prices"])
    return prods.select(
        *ctx,
        p["id"].cast("string").alias("product_id"),
        F.lit(store).alias("store"),
        p["productData"]["name"].alias("name"),
        p["productData"]["brand"]["name"].alias("brand"),
        F.get(p["categories"], 0)["name"].alias("maincat"),
        F.get(p["categories"], 1)["name"].alias("cat"),
        F.get(p["categories"], 2)["name"].alias("subcat"),
        F.get(p["categories"], 0)["id"].cast("string").alias("catid"),
        F.get(p["media"], 0)["url"].alias("image"),
        folded["price"].alias("price"),
        folded["pricewithoutdiscount"].alias("pricewithoutdiscount"),
        folded["list_price"].alias("list_price"),
        lenient_bool(p["productData"]["availability"]).alias("is_available"),
        p["productData"]["url"].alias("link"),
    )


# --- N6-N7: category trees -----------------------------------------------------------

def _dash(c):
    return F.replace(c, F.lit(" "), F.lit("-"))


def category_rows(trees: DataFrame, store: str, base_url: str, child_field: str,
                  link_style: str) -> DataFrame:
    """Tree documents (``doc`` = array of level-1 nodes) -> category rows, 3 levels.

    ``link_style`` "names": base/Main-Name/Sub-Name/...; "ids": base + id/id/.../.
    When an id occurs several times the row from the latest document wins
    (``arrival`` or ``seq`` column, else document order is irrelevant because
    repeated nodes carry identical fields).
    """
    seq = next((F.col(c) for c in (ARRIVAL, "seq") if c in trees.columns), F.lit(0))
    l1 = trees.select(seq.alias("seq"), F.explode(F.col("doc")).alias("m"))
    l2 = l1.select("seq", "m", F.explode_outer(F.col("m")[child_field]).alias("s"))
    l3 = l2.select("seq", "m", "s", F.explode_outer(F.col("s")[child_field]).alias("t"))
    m_id, m_nm = F.col("m")["id"], F.col("m")["name"]
    s_id, s_nm = F.col("s")["id"], F.col("s")["name"]
    t_id, t_nm = F.col("t")["id"], F.col("t")["name"]

    def link(*parts):
        if link_style == "names":
            return F.concat_ws("/", F.lit(base_url), *[_dash(n) for _, n in parts])
        return F.concat(F.lit(base_url), *[F.concat(i, F.lit("/")) for i, _ in parts])

    def path(*ids):
        return F.concat(F.lit("/"), *[F.concat(i, F.lit("/")) for i in ids])

    def rows(df, nid, name, parent, p, level, lk):
        return df.select("seq", nid.alias("id"), F.lit(store).alias("store"), name.alias("name"),
                         parent.cast("string").alias("parent_id"), p.alias("path"),
                         F.lit(level).cast("int").alias("level"), lk.alias("link"))

    lvl1 = rows(l1, m_id, m_nm, F.lit(None), path(m_id), 1, link((m_id, m_nm)))
    lvl2 = rows(l2.where(F.col("s").isNotNull()), s_id, s_nm, m_id, path(m_id, s_id), 2,
                link((m_id, m_nm), (s_id, s_nm)))
    lvl3 = rows(l3.where(F.col("t").isNotNull()), t_id, t_nm, s_id, path(m_id, s_id, t_id), 3,
                link((m_id, m_nm), (s_id, s_nm), (t_id, t_nm)))
    allrows = reduce(DataFrame.unionByName, [lvl1, lvl2, lvl3]).where(F.col("id").isNotNull())
    return dedup_latest(allrows, ["id", "store"], ["seq", "level", "path"]).select(*CATEGORIES.fieldNames())


def tree_a_rows(trees: DataFrame, store: str, base_url: str) -> DataFrame:
    return category_rows(trees, store, base_url, "children", "names")


def tree_b_rows(trees: DataFrame, store: str, base_url: str) -> DataFrame:
    return category_rows(trees, store, base_url, "subcategories", "ids")


# --- R10: registry -------------------------------------------------------------------

NORMALISERS: dict[str, tuple] = {
    # payload format -> (document schema, an array for documents that are lists of records; rows function)
    "catalog_a": (CATALOG_A_PRODUCT, lambda docs, store, **kw: apply_simulation(
        catalog_a_rows(docs, store), kw.get("sim"))),
    "catalog_b": (CATALOG_B_PAGE, lambda docs, store, **kw: catalog_b_rows(docs, store)),
    "tree_a": (T.ArrayType(TREE_A), lambda docs, store, **kw: tree_a_rows(docs, store, kw.get("base_url", ""))),
    "tree_b": (T.ArrayType(TREE_B), lambda docs, store, **kw: tree_b_rows(docs, store, kw.get("base_url", ""))),
}


def register(fmt: str, schema, fn: Callable) -> None:
    """Add a payload format: ``fn(docs, store, **kw) -> DataFrame`` on documents (column ``doc``) of ``schema``."""
    NORMALISERS[fmt] = (schema, fn)


def normalise(docs: DataFrame, fmt: str, store: str, json_col: str | None = None, **kw) -> DataFrame:
    """Parse (if ``json_col`` names a string column) and normalise documents of ``fmt``."""
    schema, fn = NORMALISERS[fmt]
    if json_col is not None:
        docs = parse_json(docs, json_col, schema)
    return fn(docs, store, **kw)
