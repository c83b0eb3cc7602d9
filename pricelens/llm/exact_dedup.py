"""Exact duplicates by skew-safe combining, with full contents compared at every stage.

1. each task deduplicates its own batches;
2. digest groups are merged per salt;
3. the salts' winners are merged globally.

A group of copies sends at most ``salts`` rows per task into stage 2 and ``salts`` rows into stage 3,
however many rows it has.  Contents travel and are compared as zstandard frames: the compression is
lossless and deterministic, so frames are equal exactly when texts are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.llm.scratch import written
from pricelens.llm.skew import SALTS, spread_join
from pricelens.llm.textbatch import LOWER, string_column


def _texts(column: pa.Array) -> Iterator[bytes]:
    data, off = string_column(column)
    low = LOWER[data].tobytes()
    bounds = off.tolist()
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        yield low[a:b]


def _salt(ids: np.ndarray, salts: int) -> np.ndarray:
    h = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((h >> np.uint64(33)) % np.uint64(salts)).astype(np.int32)


def _ids(column: pa.Array) -> np.ndarray:
    return column.fill_null(-1).to_numpy(zero_copy_only=False)


def local_groups(docs: DataFrame, salts: int, key_chars: int) -> DataFrame:
    """Stage 1: one row per (salt, content) of each batch: ``key, salt, content, keep_id, size``."""

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            salt = _salt(_ids(batch.column(0)), salts).tolist()
            groups: dict[tuple[int, bytes], list] = {}
            for i, s, text in zip(batch.column(0).to_pylist(), salt, _texts(batch.column(1)), strict=True):
                g = groups.setdefault((s, text), [None, 0])
                g[1] += 1
                if i is not None and (g[0] is None or i > g[0]):
                    g[0] = i
            rows = [(hashlib.sha256(text).hexdigest()[:key_chars], s, packer.compress(text), keep, size)
                    for (s, text), (keep, size) in groups.items()]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.binary(), pa.int64(), pa.int64()),
                                                strict=True)],
                names=["key", "salt", "content", "keep_id", "size"])

    return docs.mapInArrow(combine, "key string, salt int, content binary, keep_id long, size long")


def keyed_documents(docs: DataFrame, key_chars: int, with_content: bool) -> DataFrame:
    """``doc_id, text_sha256, key`` of every row, with its packed content if asked for."""

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            sha, packed = [], []
            for text in _texts(batch.column(1)):
                sha.append(hashlib.sha256(text).hexdigest())
                if with_content:
                    packed.append(packer.compress(text))
            columns = [batch.column(0), pa.array(sha, pa.string()), pa.array([s[:key_chars] for s in sha], pa.string())]
            names = ["doc_id", "text_sha256", "key"]
            if with_content:
                columns.append(pa.array(packed, pa.binary()))
                names.append("content")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(key, "doc_id long, text_sha256 string, key string" + ", content binary" * with_content)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS,
                key_chars: int = 64) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z; null counts as empty, and empty texts are
    copies of each other.  Of equal texts the row with the largest id stays; of repeated rows (same id
    and text) one stays.  A row without an id counts in ``group_size`` and stays only where no copy has
    an id (then one of them does; ``keep_id`` is null).  ``key_chars`` is how much of the hex SHA-256
    groups rows before contents are compared (all of it unless a test wants collisions).  Other
    columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    salted = (local_groups(rows, salts, key_chars)
              .groupBy("key", "salt", "content").agg(F.max("keep_id").alias("keep_id"), F.sum("size").alias("size")))
    groups = (salted.repartition("key").groupBy("key", "content")
              .agg(F.max("keep_id").alias("keep_id"), F.sum("size").alias("group_size")))
    per_key = groups.groupBy("key").agg(
        F.count("*").alias("contents"), F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"),
        F.when(F.count("*") > 1, F.collect_list(F.struct("content", "keep_id", "group_size"))).alias("each"))
    per_key = written(per_key, "dedup-groups")
    keyed = written(keyed_documents(rows, key_chars, False), "dedup-keys")
    own = F.coalesce(F.col("doc_id"), F.lit(-1))
    result = spread_join(keyed, per_key.filter("contents = 1").select("key", "keep_id", "group_size"), "key", own, salts)
    clashes = per_key.filter("contents > 1")
    if not clashes.isEmpty():                       # one digest, several contents
        result = result.filter(F.col("group_size").isNotNull())
        apart = clashes.select("key", F.explode("each").alias("g")).select("key", "g.*").withColumn(
            "pair", F.sha2(F.concat(F.encode("key", "utf-8"), "content"), 512))
        again = (keyed_documents(rows, key_chars, True).join(clashes.select("key"), "key", "left_semi")
                 .withColumn("pair", F.sha2(F.concat(F.encode("key", "utf-8"), "content"), 512)))
        more = spread_join(again, apart.select("pair", "keep_id", "group_size", F.col("content").alias("same")),
                           "pair", own, salts).filter(F.col("content") == F.col("same"))
        result = result.unionByName(more.select(result.columns))
    order = "row_number() over (partition by text_sha256, doc_id order by key)"
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    twins = result.withColumn("__stays", stays).withColumn("__n", F.expr(order))
    return twins.select(F.col("doc_id"), "keep_id", "group_size", (F.col("__stays") & (F.col("__n") == 1)).alias("kept"),
                        "text_sha256")
