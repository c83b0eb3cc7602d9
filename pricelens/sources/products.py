"""The partitioned ``products`` table: scan, conform, write, upsert, backfill.

Layout: ``root/scrape_date=YYYY-MM-DD/store=<s>/maincatid=<m>/part-*.parquet``.
Partition values live only in the path (``partitionBy`` drops them from
the files), so a date filter with literals prunes whole directories.
"""

from __future__ import annotations

import time
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.functions import first_segment
from pricelens.operators.upsert import dedup_latest, unique_by_key
from pricelens.schemas import (
    PARTITION_COLUMNS, PRODUCT_COLUMNS, PRODUCT_KEY, PRODUCTS, PRODUCTS_STORED,
)
from pricelens.session import work_path

#: Stored with every row: which write wins a key.
SEQ = "ingest_seq"


# --- S1 / S3: scan and empty table -------------------------------------------

def _stored(spark: SparkSession, root: str) -> DataFrame:
    """The table with its stored ``ingest_seq`` (NULL in files written before it was kept)."""
    schema = T.StructType([*PRODUCTS_STORED.fields, T.StructField(SEQ, T.LongType())])
    return (spark.read.schema(schema).option("basePath", root).parquet(root)
            .select(*PRODUCT_COLUMNS, "maincatid", SEQ))


def read_products(spark: SparkSession, root: str) -> DataFrame:
    """Scan the partitioned table with the declared schema (no inference); typed and empty before the first write."""
    if not table_exists(spark, root):
        return empty_products(spark).select(*PRODUCT_COLUMNS, "maincatid")
    return _stored(spark, root).drop(SEQ)


def empty_products(spark: SparkSession) -> DataFrame:
    """A typed, empty products frame (the table before the first write)."""
    return spark.createDataFrame([], PRODUCTS_STORED)


def table_exists(spark: SparkSession, root: str) -> bool:
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(path)


# --- S7: conform ---------------------------------------------------------------

def conform(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Cast incoming rows to the declared schema.

    Strings, doubles and booleans are lenient (``try_cast``: a bad value
    becomes NULL); ``scrape_date`` is strict and fails the job on garbage.
    Missing columns become typed NULLs; ``maincatid`` and the ``keep``
    columns are passed through if present.
    """
    cols = []
    for f in PRODUCTS.fields:
        if f.name not in df.columns:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif f.name == "scrape_date":
            cols.append(F.col(f.name).cast(T.DateType()).alias(f.name))
        else:
            cols.append(F.col(f.name).try_cast(f.dataType).alias(f.name))
    if "maincatid" in df.columns:
        cols.append(F.col("maincatid").try_cast("string").alias("maincatid"))
    cols += [F.col(c) for c in (keep or []) if c in df.columns]
    return df.select(*cols)


def with_maincatid(df: DataFrame, path_col: str = "category_path") -> DataFrame:
    """The top-level category id = first segment of the scraped category path."""
    return df.withColumn("maincatid", first_segment(path_col))


# --- S4 / S5 / S8: keyed writes --------------------------------------------------

def write_products(df: DataFrame, root: str, order: list[str] | None = None) -> list[tuple]:
    """Replace exactly the (scrape_date, store, maincatid) partitions present in ``df``.

    Rows of other partitions stay, unless they lose their key to a row of
    ``df`` (see ``_store``).  An empty ``df`` changes nothing.  Returns the
    partitions written.
    """
    return _store(df, root, order or [], replace=True)


def upsert_products(batch: DataFrame, root: str, order: list[str] | None = None) -> list[tuple]:
    """Insert-or-replace rows by (product_id, store, scrape_date).  Returns the partitions written."""
    if "maincatid" not in batch.columns:
        raise ValueError("batch needs a maincatid column (see with_maincatid)")
    return _store(batch, root, order or [], replace=False)


def _same(left: list[str], right: list[str]):
    """Null-safe equality of two column lists; Spark plans it as an ordinary equi-join."""
    out = F.lit(True)
    for a, b in zip(left, right, strict=True):
        out = out & F.col(a).eqNullSafe(F.col(b))
    return out


def _key_join(df: DataFrame, keys: DataFrame, columns: list[str], how: str) -> DataFrame:
    """Semi or anti join on null-safe ``columns``; the planner picks the join by size."""
    named = [f"_k_{c}" for c in columns]
    return df.join(keys.select(*[F.col(c).alias(n) for c, n in zip(columns, named)]), _same(columns, named), how)


def _in_partitions(spark: SparkSession, df: DataFrame, keys: set[tuple], how: str = "left_semi") -> DataFrame:
    """Rows of ``df`` in (or, ``left_anti``, outside) the listed partitions; literals prune directories."""
    if not keys:
        return df if how == "left_anti" else df.where(F.lit(False))
    columns = zip(*sorted(keys, key=str), strict=True)
    kinds = [pa.date32(), pa.string(), pa.string()]
    # an Arrow table becomes a local relation, whose size the planner knows
    listed = spark.createDataFrame(pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                            names=PARTITION_COLUMNS))
    if how == "left_semi":
        df = df.where(F.col("scrape_date").isin(sorted({k[0] for k in keys})) & F.col("store").isin(sorted({k[1] for k in keys})))
    return _key_join(df, listed, PARTITION_COLUMNS, how)


def _store(df: DataFrame, root: str, order: list[str], replace: bool) -> list[tuple]:
    """The one write path: (product_id, store, scrape_date) is unique in the whole table.

    Of rows with one key, stored or incoming, the greatest ``ingest_seq``
    stays; after it ``order`` decides inside the batch, then all columns,
    so the result depends neither on the input order nor on how rows that
    carry ``ingest_seq`` are split into calls.  A batch without that column
    is stamped with its time of arrival: a later call wins.

    1. The conformed batch is written once to a staging folder (the input
       is read once), and its partitions are observed while it is written;
       repeated keys are counted from there.
    2. Stored rows of the touched (scrape_date, store) pairs that share a
       key with the batch compete with it.  Only partitions that the batch
       or such rows lie in are written; with ``replace`` the stored rows of
       the batch's own partitions are dropped first.
    3. The merge is staged too, so the plan that overwrites the target never
       reads the files it replaces.  Overwriting several partitions and
       deleting emptied ones is not one atomic step: after a failure run
       the same call again, it gives the same table.
    """
    spark = df.sparkSession
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    rows = conform(df, keep=[*dict.fromkeys([SEQ, *order])])
    if SEQ not in rows.columns:
        rows = rows.withColumn(SEQ, F.lit(time.time_ns() // 1000).cast("long"))
    if "maincatid" not in rows.columns:
        rows = rows.withColumn("maincatid", F.lit(None).cast("string"))
    folder = work_path(spark, "staging", f"write-{uuid.uuid4().hex}")
    try:
        rows = rows.withColumn(SEQ, F.col(SEQ).cast("long"))
        seen = Observation(f"partitions-{uuid.uuid4().hex}")
        rows.observe(seen, F.collect_set(F.struct(*PARTITION_COLUMNS)).alias("keys")).write.parquet(f"{folder}/batch")
        touched = {tuple(r) for r in seen.get["keys"] or []}
        staged = spark.read.schema(rows.schema).parquet(f"{folder}/batch")
        return _merge(spark, staged, touched, root, order, replace, folder)
    finally:
        _delete_path(spark, folder)


def _merge(spark: SparkSession, staged: DataFrame, touched: set[tuple], root: str, order: list[str], replace: bool,
           folder: str) -> list[tuple]:
    if not touched:
        return []
    if any(k[0] is None or k[1] is None for k in touched):
        raise ValueError("scrape_date and store must not be NULL")
    cols = [*PRODUCT_COLUMNS, "maincatid", SEQ]
    rank = [SEQ, *[c for c in cols if c not in (*PRODUCT_KEY, SEQ)]]
    batch = unique_by_key(staged, PRODUCT_KEY, [SEQ, *order, *rank[1:]]).select(*cols)
    old = set(_listed_partitions(spark, root, sorted({k[:2] for k in touched}, key=str))) if table_exists(spark, root) else set()
    kept = old - touched if replace else old
    if not kept:
        _overwrite(batch, root)
        return sorted(touched, key=str)
    existing = _in_partitions(spark, _stored(spark, root), kept)
    rivals = materialise(_key_join(existing, staged, PRODUCT_KEY, "left_semi"), f"{folder}/rivals")
    moved = {tuple(r) for r in rivals.select(*PARTITION_COLUMNS).distinct().collect()}
    if moved:
        batch = dedup_latest(batch.unionByName(rivals), PRODUCT_KEY, rank)
    rewrite = moved | (touched & kept)
    rest = _key_join(_in_partitions(spark, _stored(spark, root), rewrite), staged, PRODUCT_KEY, "left_anti")
    merged = materialise(batch.unionByName(rest), f"{folder}/merged")
    written = {tuple(r) for r in merged.select(*PARTITION_COLUMNS).distinct().collect()}
    _overwrite(merged, root)
    _delete_partitions(spark, root, (rewrite | (touched & old)) - written)
    return sorted(written, key=str)


def _overwrite(rows: DataFrame, root: str) -> None:
    """Dynamic partition overwrite; ``rebalance`` lets AQE cut a hot partition into even files.

    Files are sorted by product_id inside their partition, so that a scan
    for some products skips row groups by their minima and maxima.
    """
    (rows.hint("rebalance", *PARTITION_COLUMNS).sortWithinPartitions(*PARTITION_COLUMNS, "product_id")
     .write.mode("overwrite").partitionBy(*PARTITION_COLUMNS).parquet(root))


def _listed_partitions(spark: SparkSession, root: str, pairs: list[tuple]) -> list[tuple]:
    """(scrape_date, store, maincatid) directories under the given pairs (one listing per pair)."""
    jvm = spark._jvm
    esc = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    unesc = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    fs = jvm.org.apache.hadoop.fs.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    out = []
    for d, s in pairs:
        store_dir = "__HIVE_DEFAULT_PARTITION__" if s is None else esc(str(s))
        path = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/scrape_date={d}/store={store_dir}")
        if not fs.exists(path):
            continue
        for st in fs.listStatus(path):
            name = st.getPath().getName()
            if st.isDirectory() and name.startswith("maincatid="):
                m = unesc(name.split("=", 1)[1])
                out.append((d, s, None if m == "__HIVE_DEFAULT_PARTITION__" else m))
    return out


def snapshot_dates(spark: SparkSession, root: str, n: int | None = None) -> list:
    """Snapshot dates present in the table, newest first, from the directory layout.

    One listing of ``root/scrape_date=*`` (a handful of entries per year)
    instead of a job over every file footer; a date directory counts only
    if it holds at least one data file.
    """
    import datetime as _dt
    jvm = spark._jvm
    base = jvm.org.apache.hadoop.fs.Path(root)
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(base):
        return []
    found = []
    for st in fs.listStatus(base):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("scrape_date=") and not name.endswith("__HIVE_DEFAULT_PARTITION__"):
            found.append((_dt.date.fromisoformat(name.split("=", 1)[1]), st.getPath()))
    out = []
    for d, path in sorted(found, reverse=True):
        files = fs.listFiles(path, True)
        while files.hasNext():
            if files.next().getPath().getName().endswith(".parquet"):
                out.append(d)
                break
        if n is not None and len(out) >= n:
            break
    return out


def _partition_dir(spark: SparkSession, root: str, key: tuple) -> str:
    """Directory of one partition, escaped exactly as Spark's writer escapes values."""
    esc = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    d, s, m = key
    vals = [str(d), "__HIVE_DEFAULT_PARTITION__" if s is None else esc(str(s)),
            "__HIVE_DEFAULT_PARTITION__" if m is None else esc(str(m))]
    return "/".join([root.rstrip("/"), *(f"{c}={v}" for c, v in zip(PARTITION_COLUMNS, vals))])


def _delete_path(spark: SparkSession, p: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(p)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(path):
        fs.delete(path, True)


def _delete_partitions(spark: SparkSession, root: str, keys: set) -> None:
    for key in keys:
        _delete_path(spark, _partition_dir(spark, root, key))


# --- S2: catalog refresh -------------------------------------------------------

def register_table(spark: SparkSession, name: str, root: str) -> None:
    """Register the folder as a partitioned catalog table and (re)discover partitions."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({PRODUCTS_STORED.toDDL()}) USING parquet "
              f"PARTITIONED BY ({', '.join(PARTITION_COLUMNS)}) LOCATION '{root}'")
    refresh_table(spark, name)


def refresh_table(spark: SparkSession, name: str) -> None:
    """Make the catalog list exactly the partitions present on storage, in one statement."""
    spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)


# --- S9: backfill export -------------------------------------------------------

def backfill_frame(old: DataFrame, categories: DataFrame | None = None) -> DataFrame:
    """Project an old-layout table to the current schema and derive ``maincatid``.

    ``priceWithoutDiscount`` is renamed, ``product_id`` cast to text.
    maincatid: the first segment of ``catid`` when it is a path; otherwise
    the first segment of the category's path (equi-join on catid = id).
    """
    df = old
    if "priceWithoutDiscount" in df.columns:
        df = df.withColumnRenamed("priceWithoutDiscount", "pricewithoutdiscount")
    df = conform(df.drop("maincatid") if "maincatid" in df.columns else df)
    from_path = F.when(F.col("catid").startswith("/"), first_segment("catid"))
    if categories is not None:
        cat = categories.select(F.col("id").alias("_cid"), F.col("store").alias("_cstore"),
                                first_segment("path").alias("_top"))
        df = (df.join(cat, (F.col("catid") == F.col("_cid")) & (F.col("store") == F.col("_cstore")), "left")
              .withColumn("maincatid", F.coalesce(from_path, F.col("_top")))
              .drop("_cid", "_cstore", "_top"))
    else:
        df = df.withColumn("maincatid", from_path)
    return df.select(*PRODUCT_COLUMNS, "maincatid")


def backfill(old: DataFrame, root: str, categories: DataFrame | None = None) -> None:
    write_products(backfill_frame(old, categories), root)


# --- S10 / S11: materialise a derived table ------------------------------------

def materialise(df: DataFrame, path: str) -> DataFrame:
    """Replace ``path`` with ``df`` and return a scan of it (cuts the lineage)."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


# --- optional layout: catalog table bucketed by product_id ------------------------------

BUCKET_COLUMN = "product_id"


def create_bucketed_table(spark: SparkSession, name: str, root: str, buckets: int) -> None:
    """S3 for a catalog table: partitioned like the path layout and bucketed by product_id.

    Bucketing co-locates every snapshot of a product in the same bucket
    number, so ``price_changes`` (join on product_id, store) and the
    30-day aggregate (group by product_id, store) read buckets in place
    instead of shuffling.  Spark does not allow a partition column
    (store) as a bucket column, hence product_id alone.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in PRODUCTS_STORED.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet "
              f"PARTITIONED BY ({', '.join(PARTITION_COLUMNS)}) "
              f"CLUSTERED BY ({BUCKET_COLUMN}) INTO {buckets} BUCKETS LOCATION '{root}'")


def write_bucketed(df: DataFrame, name: str, order: list[str] | None = None) -> None:
    """Dynamic-overwrite the partitions present in ``df`` into the bucketed table (key unique)."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    rows = unique_by_key(conform(df, keep=order), PRODUCT_KEY, order)
    table_cols = spark.table(name).columns
    rows.select(*table_cols).hint("rebalance", *PARTITION_COLUMNS).write.insertInto(name, overwrite=True)


def read_bucketed(spark: SparkSession, name: str) -> DataFrame:
    """Scan the bucketed table; joins and aggregates keyed on (product_id, store) may
    reuse its product_id bucketing (all our keys contain product_id, which has high
    cardinality, so reusing that partitioning cannot collapse work into few tasks)."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return spark.table(name).select(*PRODUCT_COLUMNS, "maincatid")
