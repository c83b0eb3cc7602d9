"""Snapshot dates of a panel.

The latest dates are resolved to Python literals *before* the main plan is
built: a literal ``IN``/range filter on ``scrape_date`` is a static
partition filter (only the needed snapshot directories are listed and
read), while ``IN (SELECT ... LIMIT 2)`` scans every snapshot.  The
collect is bounded by ``n`` rows.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_dates(products: DataFrame) -> DataFrame:
    """``SELECT DISTINCT scrape_date`` (partial aggregation per task)."""
    return products.select("scrape_date").distinct()


def latest_dates(products: DataFrame, n: int = 2) -> list[_dt.date]:
    """The ``n`` most recent snapshot dates, newest first (<= n rows to the driver)."""
    rows = (distinct_dates(products).where(F.col("scrape_date").isNotNull())
            .orderBy(F.col("scrape_date").desc()).limit(n).collect())
    return [r[0] for r in rows]


def latest_date(products: DataFrame) -> _dt.date | None:
    """Global ``MAX(scrape_date)``."""
    return products.agg(F.max("scrape_date")).first()[0]
