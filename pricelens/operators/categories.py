"""Choose which category paths to process (level-3 leaves of a store)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.functions import first_segment

LEAF_LEVEL = 3


def select_categories(categories: DataFrame, store: str, category_filter: dict | None = None,
                      start_from: str | None = None) -> DataFrame:
    """Level-3 paths of ``store`` ordered by path.

    * ``category_filter`` (column -> value, all ANDed) picks parent
      categories; only leaves whose path starts with ``/{parent id}/``
      are kept.  Written as a semi join on the path's first segment; no
      matching parent gives an empty result.
    * ``start_from`` resumes at that path (paths are sorted); an unknown
      value keeps every path.
    """
    leaves = categories.where((F.col("level") == LEAF_LEVEL) & (F.col("store") == store))
    if category_filter:
        conds = [F.col(k) == F.lit(v) for k, v in category_filter.items()]
        parents = (categories.where((F.col("store") == store) & reduce(lambda a, b: a & b, conds))
                   .select(F.col("id").alias("_parent")).distinct())
        leaves = leaves.join(parents, first_segment("path") == F.col("_parent"), "left_semi")
    if start_from is not None:
        # bounded existence probe: at most one row reaches the driver
        if leaves.where(F.col("path") == start_from).limit(1).count() > 0:
            leaves = leaves.where(F.col("path") >= start_from)
    return leaves.select("path").orderBy("path")
