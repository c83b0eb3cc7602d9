"""Top-k rows per group.

``row_number() <= k`` right after the window lets Catalyst insert a
partial ``WindowGroupLimit`` *before* the shuffle: every map task keeps
at most k rows per group, so a group holding a third of all rows still
ships only k rows per task to the single reducer that owns it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k_per_group(df: DataFrame, group: str | list[str], order: list[Column], k: int = 20,
                    tie_break: list[str] | None = None, rank_col: str = "rank") -> DataFrame:
    """Keep the first ``k`` rows of each group by ``order``; adds an INT ``rank``.

    ``tie_break`` columns (ascending) make the cut deterministic when
    ordering values tie.
    """
    groups = [group] if isinstance(group, str) else list(group)
    keys = list(order) + [F.col(c).asc() for c in (tie_break or [])]
    w = Window.partitionBy(*groups).orderBy(*keys)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)
