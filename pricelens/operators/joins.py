"""Joins with a side whose size is checked before it is broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.session import checkpoint_dir

# Largest key set we ship to every executor (rows); beyond it the join
# falls back to a shuffle join chosen by the planner / AQE.
BROADCAST_MAX_ROWS = 1_000_000


def materialise_small(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared checkpoint folder (reliable, not local).

    Used for small derived sides (top-k reports, their key sets) that are
    read several times: the size check, the broadcast and the final join
    then reuse the written rows instead of recomputing the report.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def small_enough(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> bool:
    """True when ``df`` (already written) has at most ``max_rows`` rows; a plain count, no row moves."""
    return df.count() <= max_rows


def join_checked(big: DataFrame, small: DataFrame, on, how: str = "inner",
                 max_rows: int = BROADCAST_MAX_ROWS, materialised: bool = False) -> DataFrame:
    """``big JOIN small``; ``small`` is broadcast only after its row count is checked.

    ``small`` is first materialised (unless the caller already did), so
    the check costs a scan of the written rows, not a recomputation.
    """
    if not materialised:
        small = materialise_small(small)
    if small_enough(small, max_rows):
        small = F.broadcast(small)
    return big.join(small, on, how)
