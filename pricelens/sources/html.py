"""Raw HTML pages -> links and product tiles (S18, N9), distributed per page.

Extraction is ``regexp_extract_all`` / ``regexp_extract`` on the page
column, so every page is processed inside the JVM by the task that holds
it; the whole text of every page is scanned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.functions import unescaped

ANCHOR = r'<a\s[^>]*?href="([^"]*)"[^>]*>([^<]*)</a>'

def _has_class(token: str) -> str:
    """Look-ahead inside a tag: its class attribute, in either quotes, holds the whole token."""
    return (rf'(?=[^>]*\sclass\s*=\s*(?:"(?:[^"]*\s)?{token}(?:\s[^"]*)?"'
            rf"|'(?:[^']*\s)?{token}(?:\s[^']*)?'))")


def _tag(name: str, token: str) -> str:
    return rf"(?is)<{name}(?=\s){_has_class(token)}[^>]*>"


TILE = rf"(?is)<div(?=\s){_has_class('product')}"
LINK, PRICE, IMAGE = _tag("a", "product-tile--link"), _tag("span", "cart-price"), _tag("img", "tile-image")


def page_links(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """All ``<a href>`` anchors: (page_id, pos, href, text) with 1-based position."""
    found = pages.select(
        id_col,
        F.regexp_extract_all(F.col(html_col), F.lit(ANCHOR), 1).alias("hrefs"),
        F.regexp_extract_all(F.col(html_col), F.lit(ANCHOR), 2).alias("texts"))
    z = found.select(id_col, F.posexplode(F.arrays_zip("hrefs", "texts")).alias("i", "a"))
    return z.select(id_col, (F.col("i") + 1).cast("int").alias("pos"),
                    F.col("a")["hrefs"].alias("href"), F.trim(F.col("a")["texts"]).alias("text"))


def _attribute(tag, name: str):
    """Value of an attribute of a tag in either quotes; NULL if it has none."""
    pattern = rf"""(?is)\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)')"""
    value = F.concat(F.regexp_extract(tag, pattern, 1), F.regexp_extract(tag, pattern, 2))
    return F.when(tag.rlike(pattern), unescaped(value))


def _inner_text(tile, opening: str, name: str):
    """Whole text of the first such element without the tags in it; NULL if it is missing or blank."""
    inner = F.regexp_extract(tile, rf"{opening}(.*?)</{name}\s*>", 1)
    text = F.trim(F.regexp_replace(unescaped(F.regexp_replace(inner, "<[^>]*>", "")), r"\s+", " "))
    return F.when(text != "", text)


def _own_part(piece):
    """A tile's text up to its own closing tag, counting the ``div`` tags opened and closed inside it."""
    tokens = F.split(piece, r"(?i)(?=<div[\s>])|(?=</div\s*>)")
    start = F.struct(F.lit(1).alias("depth"), F.lit("").alias("text"))

    def step(acc, token):
        change = F.when(token.rlike(r"(?i)^<div[\s>]"), 1).when(token.rlike(r"(?i)^</div"), -1).otherwise(0)
        depth = F.when(acc["depth"] > 0, acc["depth"] + change).otherwise(0)
        return F.struct(depth.alias("depth"), F.when(depth > 0, F.concat(acc["text"], token)).otherwise(acc["text"]).alias("text"))

    return F.aggregate(tokens, start, step)["text"]


def product_tiles(pages: DataFrame, base_url: str, id_col: str = "page_id",
                  html_col: str = "html") -> DataFrame:
    """Product tiles ``<div class="product" data-pid=..>``: pid, name, url, price, image.

    A tile reaches from its opening tag to its own closing tag or to the
    next tile's opening.  A missing tag, attribute or blank text gives
    NULL for that field only.  Attributes may stand in either quotes.
    """
    pieces = pages.select(id_col, F.posexplode(F.split(F.col(html_col), TILE)).alias("i", "t"))
    tiles = pieces.where(F.col("i") > 0).withColumn("t", _own_part(F.col("t")))
    t = F.col("t")
    link, image = F.regexp_extract(t, LINK, 0), F.regexp_extract(t, IMAGE, 0)
    return tiles.select(
        id_col, F.col("i").cast("int").alias("tile"),
        _attribute(F.regexp_extract(t, "^[^>]*>", 0), "data-pid").alias("pid"),
        _inner_text(t, LINK, "a").alias("name"),
        F.concat(F.lit(base_url), _attribute(link, "href")).alias("url"),
        _inner_text(t, PRICE, "span").alias("price"),
        _attribute(image, "src").alias("image"),
    )
