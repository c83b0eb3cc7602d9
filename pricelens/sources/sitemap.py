"""Sitemap URLs -> category hierarchy."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.functions import slug_to_name, unescaped, url_path
from pricelens.plans.ordinal import with_ordinal

# Ids are handed out from 1001 upwards, roots have parent 0.
FIRST_ID = 1001
ROOT_PARENT = 0


#: A ``loc`` element of any parent; its text may be a CDATA section.
_LOC = r"(?s)<loc(?:\s[^>]*)?>(.*?)</loc\s*>"
_COMMENT = r"(?s)<!--.*?-->"
_CDATA = r"(?s)<!\[CDATA\[(.*?)\]\]>"


def sitemap_locations(files: DataFrame, text_col: str = "value") -> DataFrame:
    """Every ``<loc>`` of whole sitemap or sitemap-index documents: the other columns, ``pos`` (from 0), ``url``.

    Elements are found whatever tag they stand in; comments are left out,
    blanks around the text too, entities are replaced.  An empty element
    gives ''; a document that is NULL or has no element gives no row.
    """
    text = F.regexp_replace(F.col(text_col), _COMMENT, "")
    found = files.select(*[c for c in files.columns if c != text_col],
                         F.posexplode(F.regexp_extract_all(text, F.lit(_LOC), 1)).alias("pos", "raw"))
    whole = F.regexp_extract(F.trim(F.col("raw")), _CDATA, 1)
    plain = unescaped(F.regexp_replace("raw", "<[^>]*>", ""))
    url = F.regexp_replace(F.when(F.col("raw").rlike(_CDATA), whole).otherwise(plain), r"^\s+|\s+$", "")
    return found.withColumn("url", url).drop("raw")


def read_sitemap(spark: SparkSession, path: str) -> DataFrame:
    """All locations of the XML files under ``path`` -> (url_index, url), by file name and place in the file.

    Sitemap files hold at most 50,000 locations and 50 MB by their
    protocol, so a file is read as one text.
    """
    files = spark.read.text(path, wholetext=True).withColumn("_file", F.input_file_name())
    return with_ordinal(sitemap_locations(files), ["_file", "pos"], "url_index", 0).select("url_index", "url")


def url_hierarchy(urls: DataFrame, store: str, order_col: str = "url_index") -> DataFrame:
    """Every path prefix of every URL becomes a category (id, store, name, parent_id, path, level).

    A prefix gets its id in first-seen order: by the first URL (``order_col``)
    that contains it, then by depth.  Steps: explode prefixes; one grouped
    ``min`` per prefix (partial aggregation, so a prefix shared by a third
    of all URLs is reduced in every map task); consecutive ids by global
    order (``with_ordinal``); parent by an equi-join on the parent prefix.
    """
    parts = urls.select(order_col, F.split(
        F.regexp_replace(url_path(F.col("url")), r"^/+|/+$", ""), "/").alias("parts"))
    pre = parts.select(order_col, "parts", F.posexplode("parts").alias("i", "part"))
    pre = pre.select(
        order_col, "part", (F.col("i") + 1).alias("level"),
        F.concat(F.lit("/"), F.array_join(F.slice("parts", 1, F.col("i") + 1), "/")).alias("full_path"),
    )
    first = (pre.groupBy("full_path")
             .agg(F.min(F.struct(F.col(order_col).alias("first"), "level", "part")).alias("m"))
             .select("full_path", "m.first", "m.level", "m.part"))
    ided = with_ordinal(first, ["first", "level"], "id", FIRST_ID)
    parent_key = F.when(F.col("level") > 1, F.regexp_replace("full_path", r"/[^/]*$", ""))
    child = ided.withColumn("_parent_path", parent_key)
    parents = ided.select(F.col("full_path").alias("_parent_path"), F.col("id").alias("_pid"))
    return (child.join(parents, "_parent_path", "left")
            .select(F.col("id").cast("long").alias("id"), F.lit(store).alias("store"),
                    slug_to_name(F.col("part")).alias("name"),
                    F.coalesce(F.col("_pid"), F.lit(ROOT_PARENT)).cast("long").alias("parent_id"),
                    F.concat(F.col("full_path"), F.lit("/")).alias("path"),
                    F.col("level").cast("int").alias("level")))
