"""Consecutive 1..n numbering in a global order, without one-partition windows over the rows.

``row_number()`` over an un-partitioned window moves every row into a
single task.  Instead: sort globally (range-partitioned, parallel),
checkpoint so partition contents are fixed, count rows per partition,
and add each partition's offset to the row's position inside its
partition, which ``monotonically_increasing_id`` encodes in its low 33
bits.  The offsets are a frame of one row per partition that is joined
by partition number, so the plan has the same size whatever the number
of partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelens.session import checkpoint_dir

_LOW_BITS = (1 << 33) - 1


def with_ordinal(df: DataFrame, order: list[Column | str], col: str = "ordinal",
                 start: int = 1) -> DataFrame:
    """Add ``col`` = start, start+1, ... following ``order`` (which should be unique)."""
    checkpoint_dir(df.sparkSession)
    ranked = df.orderBy(*order).checkpoint(eager=True)
    pos = ranked.withColumns({"_pid": F.spark_partition_id(),
                              "_pos": F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW_BITS))})
    # one row per non-empty partition: its running sum is one small task
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pos.groupBy("_pid").count().select(
        "_pid", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    return (pos.join(F.broadcast(offsets), "_pid")
            .withColumn(col, F.col("_offset") + F.col("_pos") + F.lit(start))
            .drop("_pid", "_pos", "_offset"))
