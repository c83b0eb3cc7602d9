"""Token counts by a compiled finite-state tokenizer (see ``transducer``)."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.llm.textbatch import byte_slices
from pricelens.llm.transducer import TokenCounter


@lru_cache(maxsize=2)
def counter(path: str) -> TokenCounter:
    """One compiled tokenizer per worker process, kept across tasks."""
    return TokenCounter(path)


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 2048) -> DataFrame:
    """``id_col, n_bytes, n_tokens, over_limit`` of every row's whole text.

    One narrow pass without a shuffle.  Null and empty texts have no bytes and no tokens; a null id and
    repeated rows are kept as they are; other columns are not read, so their names cannot clash.  Texts
    of any length are read whole; memory holds a slice of about 1 MB of texts, or one longer text.
    """
    id_type = docs.schema[id_col].dataType

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = counter(tokenizer_path)
        for batch in batches:
            text = batch.column(1)
            n_bytes, n_tokens = np.zeros(len(text), np.int64), np.zeros(len(text), np.int64)
            for i, j, _, off in byte_slices(text):
                n_bytes[i:j] = np.diff(off)
                n_tokens[i:j] = machine.count([t or "" for t in text.slice(i, j - i).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_bytes), pa.array(n_tokens), pa.array(n_tokens > limit)],
                names=["id", "n_bytes", "n_tokens", "over_limit"])

    schema = T.StructType([T.StructField("id", id_type), T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(count, schema).withColumnRenamed("id", id_col)
