"""String helpers for paths, URLs, names and display formatting."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricelens.functions.numeric import fixed

# Fixed value: image shown when a product has no usable image URL
# (a grey 72x72 square with the text "No img", as an inline SVG data URL).
NO_IMAGE = (
    "data:image/svg+xml,%3Csvg xmlns='http://www.w3.org/2000/svg' width='72' height='72'%3E"
    "%3Crect width='72' height='72' fill='%23e0e0e0'/%3E"
    "%3Ctext x='50%25' y='55%25' dominant-baseline='middle' text-anchor='middle' "
    "fill='%23999' font-size='10'%3ENo img%3C/text%3E%3C/svg%3E"
)


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def path_segments(path) -> Column:
    """'/a/b/c/' -> ['a','b','c'] (slashes trimmed at both ends first)."""
    return F.split(F.regexp_replace(_col(path), r"^/+|/+$", ""), "/")


def first_segment(path) -> Column:
    return F.get(path_segments(path), 0)


def last_segment(path) -> Column:
    segs = path_segments(path)
    return F.get(segs, F.size(segs) - 1)


#: Scheme and authority, both optional, then the path up to query or fragment.
_URL = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)"


def url_path(url) -> Column:
    """Path component of an absolute, protocol-relative (``//host/a``) or relative (``/a``) URL.

    Parameters of the last segment (``;x``) do not belong to it; '' when
    the URL is NULL or has no path.
    """
    path = F.regexp_extract(_col(url), _URL, 1)
    return F.coalesce(F.regexp_replace(path, ";[^/]*$", ""), F.lit(""))


def slug_to_name(slug) -> Column:
    """'vinos-y-licores' -> 'Vinos Y Licores'."""
    return F.initcap(F.replace(_col(slug), F.lit("-"), F.lit(" ")))


def lenient_bool(x) -> Column:
    """True only for 'true' / '1' (any case); NULL and anything else -> false."""
    return F.coalesce(F.lower(_col(x)).isin("true", "1"), F.lit(False))


#: Entities that are replaced, the ampersand last (fixed values).
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&#x27;": "'", "&apos;": "'", "&nbsp;": " ", "&amp;": "&"}


def unescaped(x) -> Column:
    """Text with the common XML and HTML entities replaced by their signs."""
    out = _col(x)
    for entity, sign in ENTITIES.items():
        out = F.replace(out, F.lit(entity), F.lit(sign))
    return out


def escape_html(x) -> Column:
    return F.replace(F.replace(_col(x), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def image_or_placeholder(x) -> Column:
    c = _col(x)
    return F.when(c.startswith("http"), c).otherwise(F.lit(NO_IMAGE))


def link_or_hash(x) -> Column:
    return F.coalesce(_col(x), F.lit("#"))


def stamp_date(df, scrape_date=None):
    """add the snapshot date as a column (a job parameter; today when not given)."""
    d = F.current_date() if scrape_date is None else F.lit(scrape_date).cast("date")
    return df.withColumn("scrape_date", d)


def format_pct(x) -> Column:
    return fixed(x, 1)


def format_money(x) -> Column:
    return fixed(x, 2)


def change_label(is_increase, pct, before, after) -> Column:
    """Display text of a report row: '<arrow> 12.3%  ($10.00 -> $11.23)'.

    Formatting only; the arrow is an up triangle for increases, a down
    triangle otherwise.
    """
    arrow = F.when(_col(is_increase), F.lit("\u25b2")).otherwise(F.lit("\u25bc"))
    return F.format_string("%s %s%%  ($%s \u2192 $%s)", arrow, format_pct(pct), format_money(before), format_money(after))
