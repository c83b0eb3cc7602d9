"""Keyed deduplication: keep the last-written row per primary key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.operators.joins import materialise_small


def dedup_latest(df: DataFrame, key: list[str], order: list[str] | None = None) -> DataFrame:
    """One row per ``key``: the row with the greatest ``order`` tuple wins.

    Without ``order`` the greatest tuple of all non-key columns wins, which
    is arbitrary but deterministic (identical duplicates collapse).

    Written as ``max_by`` in a grouped aggregate rather than a
    ``row_number`` window: the aggregate runs partially in every map task,
    so a key repeated across a third of the input collapses to one row per
    task before the shuffle.  ``order`` should be unique within a key.
    """
    value_cols = [c for c in df.columns if c not in key]
    if not order:
        packed = df.groupBy(*key).agg(F.max(F.struct(*value_cols)).alias("_row"))
        return packed.select(*key, "_row.*").select(*df.columns)
    packed = (df.groupBy(*key)
              .agg(F.max_by(F.struct(*value_cols), F.struct(*order)).alias("_row")))
    return packed.select(*key, "_row.*").select(*df.columns)


def unique_by_key(df: DataFrame, key: list[str], order: list[str] | None = None) -> DataFrame:
    """``dedup_latest`` in which only rows of repeated keys are aggregated.

    A grouped count of the narrow key columns finds the repeated keys, which
    are written out; without any, ``df`` itself is the result.  Else the
    other rows pass an anti join on them.  The planner picks the joins by
    size.  ``df`` should be a stored table, as it is read up to three times.
    Key equality is null-safe, as grouping is.
    """
    dups = materialise_small(df.groupBy(*key).count().where(F.col("count") > 1).select(*[F.col(k).alias(f"_dk_{k}") for k in key]))
    if dups.isEmpty():
        return df
    match = F.lit(True)
    for k in key:
        match = match & F.col(k).eqNullSafe(F.col(f"_dk_{k}"))
    once = df.join(dups, match, "left_anti")
    repeated = df.join(dups, match, "left_semi")
    return once.unionByName(dedup_latest(repeated, key, order))
