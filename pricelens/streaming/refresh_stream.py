"""Refresh when completed snapshots land.

Landed snapshot files (append-only, new names) are read as a file stream
with the declared schema; each micro-batch is upserted into the
partitioned table by key (a retried or late batch replaces the same
rows, so no watermark is needed), after which the derived tables can be
rebuilt.  The row with the greatest ``ingest_seq`` stays, whether rows
of a key arrive in one micro-batch or in several, and in whatever order.
``availableNow`` processes what has landed and stops, which is
how a weekly trigger runs it; the checkpoint folder makes it resume
exactly after the last committed batch.

``stream_completed`` adds the gate of a scraping run that writes for
hours: the stream is that of completion markers, which are written last,
and a snapshot's folder is read only when a marker says that it
succeeded.  A folder without a marker, or with a failed one, stays out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.schemas import PRODUCTS_STORED
from pricelens.sources.products import table_exists, upsert_products

LANDED = T.StructType(PRODUCTS_STORED.fields + [T.StructField("ingest_seq", T.LongType())])

#: A completion marker: how the run that wrote a snapshot ended and, if known, how many rows it landed.
MARKER = T.StructType([T.StructField("snapshot", T.StringType()), T.StructField("status", T.StringType()),
                       T.StructField("n_rows", T.LongType())])
SUCCEEDED, FAILED = "succeeded", "failed"


def land(batch: DataFrame, landing: str) -> None:
    """Append one snapshot batch to the landing folder (new files only)."""
    batch.write.mode("append").parquet(landing)


def _upsert_stream(stream: DataFrame, checkpoint: str, apply: Callable[[DataFrame, int], None]) -> None:
    q = (stream.writeStream.foreachBatch(apply)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def stream_refresh(spark: SparkSession, landing: str, root: str, checkpoint: str,
                   on_batch: Callable[[SparkSession, int], None] | None = None,
                   max_files_per_trigger: int | None = None) -> None:
    """Upsert everything landed since the last run into ``root``; then call ``on_batch``."""
    reader = spark.readStream.schema(LANDED)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def apply(batch: DataFrame, epoch: int) -> None:
        upsert_products(batch, root)
        if on_batch is not None:
            on_batch(batch.sparkSession, epoch)

    _upsert_stream(reader.parquet(landing), checkpoint, apply)


# --- completion gate ------------------------------------------------------------------

def land_snapshot(batch: DataFrame, landing: str, snapshot: str) -> None:
    """Append a part of a snapshot to its own folder; nothing reads it before ``mark``."""
    (batch.withColumn("snapshot", F.lit(snapshot))
     .write.mode("append").option("partitionOverwriteMode", "static").partitionBy("snapshot").parquet(f"{landing}/snapshots"))


def mark(spark: SparkSession, landing: str, snapshot: str, status: str = SUCCEEDED, n_rows: int | None = None) -> None:
    """Write a snapshot's completion marker, a new file of one JSON line."""
    row = spark.createDataFrame([(snapshot, status, n_rows)], MARKER)
    row.coalesce(1).write.mode("append").json(f"{landing}/markers")


def landed_snapshots(spark: SparkSession, landing: str, snapshots: list[str]) -> DataFrame:
    """Rows of the named snapshots' folders, which the literal names prune; typed and empty if none has landed."""
    schema = T.StructType([*LANDED.fields, T.StructField("snapshot", T.StringType())])
    if not snapshots or not table_exists(spark, f"{landing}/snapshots"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{landing}/snapshots").where(F.col("snapshot").isin(snapshots))


def stream_completed(spark: SparkSession, landing: str, root: str, checkpoint: str,
                     on_batch: Callable[[SparkSession, int], None] | None = None,
                     max_files_per_trigger: int | None = None) -> None:
    """Upsert the snapshots whose completion markers arrived since the last run; then call ``on_batch``.

    A snapshot of which a marker of this micro-batch says ``succeeded`` is
    upserted whole.  If the marker also says how many rows were landed and
    the folder holds fewer, or there is no folder yet, the snapshot stays
    out and its marker is written again, so that the next run looks once
    more.  Other markers are passed over.  A micro-batch that is repeated
    after a failure gives the same table.  Only marker rows (one a
    snapshot) reach the driver.
    """
    (spark.createDataFrame([], MARKER).write.mode("append").json(f"{landing}/markers"))      # the stream needs the folder
    reader = spark.readStream.schema(MARKER)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def apply(markers: DataFrame, epoch: int) -> None:
        session = markers.sparkSession
        done = markers.where((F.col("status") == SUCCEEDED) & F.col("snapshot").isNotNull())
        wanted = {r.snapshot: r.n_rows for r in done.groupBy("snapshot").agg(F.max("n_rows").alias("n_rows")).collect()}
        held = landed_snapshots(session, landing, sorted(wanted))
        counts = {r["snapshot"]: r["count"] for r in held.groupBy("snapshot").count().collect()}
        whole = sorted(s for s, n in wanted.items() if counts.get(s, 0) >= max(n or 0, 1) or n == 0)
        if whole:
            upsert_products(held.where(F.col("snapshot").isin(whole)).drop("snapshot"), root)
        for snapshot in sorted(set(wanted) - set(whole)):
            mark(session, landing, snapshot, SUCCEEDED, wanted[snapshot])
        if on_batch is not None and whole:
            on_batch(session, epoch)

    _upsert_stream(reader.json(f"{landing}/markers"), checkpoint, apply)
