"""Column-level helpers built only from ``pyspark.sql.functions`` (JVM-side)."""

from pricelens.functions.numeric import exact_avg, fixed, pct_change, round2
from pricelens.functions.text import (
    change_label, stamp_date, escape_html, first_segment, format_money, format_pct, image_or_placeholder,
    last_segment, lenient_bool, link_or_hash, path_segments, slug_to_name, unescaped, url_path,
)
from pricelens.functions.nested import fold_prices, safe_get

__all__ = [
    "exact_avg", "fixed", "pct_change", "round2", "change_label", "stamp_date", "escape_html", "first_segment", "format_money",
    "format_pct", "image_or_placeholder", "last_segment", "lenient_bool", "link_or_hash",
    "path_segments", "slug_to_name", "unescaped", "url_path", "fold_prices", "safe_get",
]
