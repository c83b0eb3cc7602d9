"""The stored ``categories`` table, unique by (id, store): keyed loads that rewrite only touched buckets.

Layout: ``root/of=<buckets>/bucket=<b>/part-*.parquet`` with ``b`` the hash
of the key modulo the number of buckets, which is fixed by the first write
and read from the layout afterwards.  Categories have no column to
partition by (a load touches one store, but any id in it), so the hash
gives even buckets and bounds what a small load has to rewrite.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.operators.upsert import dedup_latest
from pricelens.schemas import CATEGORIES, CATEGORY_KEY
from pricelens.session import work_path
from pricelens.sources.products import SEQ, _delete_path, materialise, table_exists

#: Buckets of a new table; at 100 million categories about 20 MB each.
BUCKETS = 512
_REQUIRED = [*CATEGORY_KEY, "name"]
_STORED = T.StructType([*CATEGORIES.fields, T.StructField(SEQ, T.LongType())])


def _buckets_of(spark: SparkSession, root: str) -> int | None:
    """Number of buckets of the table, from its one ``of=<n>`` folder; None before the first write."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return None
    found = [st.getPath().getName() for st in fs.listStatus(path)]
    return next((int(n[3:]) for n in found if n.startswith("of=")), None)


def _scan(spark: SparkSession, root: str) -> DataFrame:
    schema = T.StructType([*_STORED.fields, T.StructField("of", T.IntegerType()), T.StructField("bucket", T.IntegerType())])
    return spark.read.schema(schema).option("basePath", root).parquet(root)


def read_categories(spark: SparkSession, root: str) -> DataFrame:
    """The table; typed and empty before the first write."""
    if not table_exists(spark, root):
        return spark.createDataFrame([], CATEGORIES)
    return _scan(spark, root).select(*CATEGORIES.fieldNames())


def upsert_categories(batch: DataFrame, root: str, buckets: int = BUCKETS) -> list[int]:
    """Insert or replace categories by (id, store).  Returns the buckets written.

    Of rows with one key, stored or incoming, the greatest ``ingest_seq``
    stays, then the greater columns; a batch without that column is
    stamped with its time of arrival, so a later call wins.  A row without
    id, store or name raises before anything is written; an empty batch
    changes nothing.  The merge is staged, so the plan that overwrites
    buckets never reads the files it replaces; after a failure the same
    call gives the same table.
    """
    spark = batch.sparkSession
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    n = _buckets_of(spark, root) or buckets
    seq = F.col(SEQ).cast("long") if SEQ in batch.columns else F.lit(time.time_ns() // 1000).cast("long")
    rows = batch.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) if f.name in batch.columns
                          else F.lit(None).cast(f.dataType).alias(f.name) for f in CATEGORIES.fields], seq.alias(SEQ))
    folder = work_path(spark, "staging", f"categories-{uuid.uuid4().hex}")
    try:
        placed = rows.withColumns({"of": F.lit(n), "bucket": F.pmod(F.xxhash64(*CATEGORY_KEY), F.lit(n)).cast("int")})
        staged = materialise(placed, f"{folder}/batch")
        missing = staged.where(" OR ".join(f"{c} IS NULL" for c in _REQUIRED)).limit(1).count()
        if missing:
            raise ValueError(f"categories need {', '.join(_REQUIRED)}")
        touched = sorted(r.bucket for r in staged.select("bucket").distinct().collect())      # at most n numbers
        if not touched:
            return []
        both = staged
        if table_exists(spark, root):
            both = both.unionByName(_scan(spark, root).where(F.col("bucket").isin(touched)).select(*staged.columns))
        order = [SEQ, *[c for c in CATEGORIES.fieldNames() if c not in CATEGORY_KEY]]
        merged = materialise(dedup_latest(both, [*CATEGORY_KEY, "of", "bucket"], order), f"{folder}/merged")
        (merged.hint("rebalance", "bucket").sortWithinPartitions("of", "bucket", *CATEGORY_KEY)
         .write.mode("overwrite").partitionBy("of", "bucket").parquet(root))
        return touched
    finally:
        _delete_path(spark, folder)
