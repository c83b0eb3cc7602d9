"""Importance resampling towards a target's distribution of hashed n-grams, counted by distinct lines.

Newlines separate words, so a text's n-grams are those of its lines and those that cross lines.  Corpus
counts therefore come from distinct lines: lines are counted (combined before the shuffle), the features
of each distinct line are counted once and multiplied by its occurrences, and the n-grams across lines,
which need only the words at the edges of lines, are added separately.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.llm.arrays import array_sum, sliced
from pricelens.llm.scratch import written
from pricelens.llm.textbatch import byte_slices
from pricelens.plans.ordinal import with_ordinal

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Bytes of lower-cased words as they are, all others as blanks, but newlines stay.
_CLEAN = bytes(b + 32 if 65 <= b <= 90 else b if b == 10 or 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
               for b in range(256))


def line_features(line: bytes, n: int, buckets: int) -> tuple[int, list[int]]:
    """Number of words of a cleaned line and the buckets of all its runs of 1 to ``n`` words."""
    words = line.split()
    out = [h % buckets for h in map(zlib.crc32, words)]
    grams = words
    for k in range(2, n + 1):
        grams = list(map(b" ".join, zip(grams, islice(words, k - 1, None))))     # noqa: B905 - the shorter one ends it
        out += [h % buckets for h in map(zlib.crc32, grams)]
    return len(words), out


def crossing_features(lines: list[bytes], n: int, buckets: int) -> list[int]:
    """Buckets of the runs of 2 to ``n`` words of a cleaned text that begin and end in different lines."""
    if n < 2 or len(lines) < 2:
        return []
    edge, words, owner = n - 1, [], []
    for k, line in enumerate(lines):
        own = line.split(None, 2 * edge)
        if len(own) > 2 * edge:                    # no run across lines reaches the middle
            own = own[:edge] + line.rsplit(None, edge)[-edge:]
        words += own
        owner += [k] * len(own)
    out = []
    for k in range(2, n + 1):
        for i in range(len(words) - k + 1):
            if owner[i] != owner[i + k - 1]:
                out.append(zlib.crc32(b" ".join(words[i:i + k])) % buckets)
    return out


def _tallied(rows: DataFrame, buckets: int, tally: Callable[[pa.RecordBatch, np.ndarray], None]) -> np.ndarray:
    """Bucket counts that each task adds up over its batches."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            tally(batch, total)
        yield sliced(total)

    got = array_sum(rows.mapInArrow(count, "part int, payload binary"), np.int64)
    return got if len(got) else np.zeros(buckets, np.int64)


def feature_counts(docs: DataFrame, text_col: str = "text", n: int = 2, buckets: int = 10_000) -> np.ndarray:
    """Occurrences of each feature bucket in all texts; null texts have none."""
    clean = F.translate(F.col(text_col), UPPER, LOWER)
    lines = docs.select(F.explode(F.split(clean, "\n")).alias("line")).groupBy("line").agg(F.count("*").alias("times"))

    def whole_lines(batch: pa.RecordBatch, total: np.ndarray) -> None:
        for i, j, data, off in byte_slices(batch.column(0)):
            raw, ends, found, sizes = data.tobytes().translate(_CLEAN), off.tolist(), [], []
            for a, b in zip(ends[:-1], ends[1:], strict=True):
                own = line_features(raw[a:b], n, buckets)[1]
                found += own
                sizes.append(len(own))
            times = np.repeat(batch.column(1).slice(i, j - i).to_numpy(zero_copy_only=False), sizes)
            np.add.at(total, np.array(found, np.int64), times)

    def between_lines(batch: pa.RecordBatch, total: np.ndarray) -> None:
        for _, _, data, off in byte_slices(batch.column(0)):
            raw, ends, found = data.tobytes().translate(_CLEAN), off.tolist(), []
            for a, b in zip(ends[:-1], ends[1:], strict=True):
                found += crossing_features(raw[a:b].split(b"\n"), n, buckets)
            total += np.bincount(np.array(found, np.int64), minlength=buckets)

    counts = _tallied(lines, buckets, whole_lines)
    if n > 1:
        counts += _tallied(docs.select(F.col(text_col).alias("text")), buckets, between_lines)
    return counts


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the smoothed target and raw shares, floored, for each bucket."""
    buckets, s_all, t_all = len(raw), int(raw.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + buckets) / ((s + 1) * (t_all + buckets))))
                     for s, t in zip(raw.tolist(), target.tolist(), strict=True)], np.int64)


def text_weights(docs: DataFrame, gains: np.ndarray, id_col: str = "doc_id", text_col: str = "text", n: int = 2) -> DataFrame:
    """``id_col, n_words, n_features, weight`` of every row: the floored mean gain of its features (0 without any).

    A line that occurs again in a slice of texts is not counted again.
    """
    buckets = len(gains)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = gains.tolist()
        for batch in batches:
            for i, j, data, off in byte_slices(batch.column(1)):
                raw, ends = data.tobytes().translate(_CLEAN), off.tolist()
                known: dict[bytes, tuple[int, int, int]] = {}
                rows = []
                for a, b in zip(ends[:-1], ends[1:], strict=True):
                    lines, words, features, total = raw[a:b].split(b"\n"), 0, 0, 0
                    for line in lines:
                        own = known.get(line)
                        if own is None:
                            size, found = line_features(line, n, buckets)
                            own = known[line] = size, len(found), sum(map(gain.__getitem__, found))
                        words, features, total = words + own[0], features + own[1], total + own[2]
                    across = crossing_features(lines, n, buckets)
                    features += len(across)
                    total += sum(map(gain.__getitem__, across))
                    rows.append((words, features, total // features if features else 0))
                columns = np.array(rows, np.int64).reshape(-1, 3).T
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), *map(pa.array, columns)],
                                                 names=["id", "n_words", "n_features", "weight"])

    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType)]
                          + [T.StructField(x, T.LongType()) for x in ("n_words", "n_features", "weight")])
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(weigh, schema).withColumnRenamed("id", id_col)


def importance_resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        target_col: str = "text", n: int = 2, buckets: int = 10_000, least_words: int = 20,
                        percent: int = 25, seed: int = 7) -> DataFrame:
    """``id_col, n_features, weight, score, rank`` of every row: a draw without replacement by Gumbel scores.

    Features are the runs of 1 to ``n`` words (A-Z lower-cased; letters, digits and bytes from 0x80), each
    in the bucket of its crc32.  ``score`` is the weight plus Gumbel noise in thousandths, which the seed and
    the id fix.  Of the N rows with ``least_words`` words or more, the floor(percent * N / 100) highest
    scores are drawn; ``rank`` numbers them from 1, ties go to the smaller id; rows not drawn have null.
    Null and empty texts have no feature, weight 0, and are never drawn; a null id hashes as an empty one and
    goes last in a tie; repeated rows count one by one; an empty table gives no row; an empty target gives
    every bucket its smoothed share.  Other columns are not read.

    Only bucket arrays of fixed size reach the driver and the tasks' closures.  Ranks come from a sorted
    table in many parts, not from one task.
    """
    gains = bucket_gains(feature_counts(docs, text_col, n, buckets), feature_counts(target, target_col, n, buckets))
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    noise = (F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double") + F.lit(0.5)) / F.lit(4294967296.0)
    gumbel = F.floor(F.lit(-1000.0) * F.log(-F.log(noise))).cast("long")
    scored = written(text_weights(docs, gains, id_col, text_col, n).withColumn("score", F.col("weight") + gumbel), "scores")
    drawn = F.col("n_words") >= least_words
    many = scored.filter(drawn).count() * percent // 100
    columns = [id_col, "n_features", "weight", "score"]
    order = [F.col("score").desc(), F.col(id_col).asc_nulls_last(), F.col("n_features")]
    ranked = with_ordinal(scored.filter(drawn).select(*columns), order, "rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= many, F.col("rank")).cast("long"))
    rest = scored.filter(~drawn).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*columns, "rank").unionByName(rest)
