"""Training-corpus pipeline over the documents table: each stage applies one operator of ``pricelens.llm``.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and reread
as the next stage's ``docs``.  All but the last return the columns of ``documents``, for all rows that
their predecessors kept.  Null and empty texts, null ids, repeated rows and empty tables follow the
operators' rules; an empty table stays empty through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.llm import decontaminate, mixing, quality, shingle_join, token_store
from pricelens.llm.queries import table, tokenizer_path
from pricelens.llm.scratch import scratch_path, written
from pricelens.llm.shipping import prepare


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the byte-level network scores at least 0.7; null texts score as empty ones."""
    prepare(spark)
    net = quality.fit(docs, table(spark, sf_dir, "labels"))
    return docs.filter(quality.scorer(net)(F.col("text")) >= quality.THRESHOLD)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of each group of near copies, and one row of an id: that of the smallest text.

    Rows without an id are in no group; of those with equal texts one stays.  Null texts count as empty
    ones and come first; rows that differ in other columns only are told apart by these, smallest first.
    """
    prepare(spark)
    groups = written(shingle_join.shingle_components(docs), "groups")
    dropped = groups.filter("component_id <> doc_id").select("doc_id").distinct()
    kept = docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)
    own = F.when(F.col("doc_id").isNull(), F.sha2(F.coalesce("text", F.lit("")), 256))
    row = F.min(F.struct(F.coalesce("text", F.lit("")).alias("__first"), *docs.columns)).alias("__row")
    return kept.groupBy("doc_id", own.alias("__own")).agg(row).select(*(F.col(f"__row.`{c}`") for c in docs.columns))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold the question and the answer of a test item; null texts hold none."""
    prepare(spark)
    leaks = decontaminate.leak_flags(docs, table(spark, sf_dir, "benchmark"))
    return docs.filter(~leaks(F.col("text")))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents by their fitted rates, so that languages come near tempered weights; none is dropped.

    Without any labelled document there is one domain and every row stays as it is.
    """
    prepare(spark)
    labelled = table(spark, sf_dir, "labels").select("doc_id").join(
        docs.select("doc_id", F.col("lang").alias("domain")), "doc_id")
    return mixing.mixed_documents(docs, labelled)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the documents as range-coded token files and returns what the files hold, one row a document."""
    prepare(spark)
    path = scratch_path(spark, "tokens")
    token_store.write_token_files(docs, path, tokenizer_path())
    return token_store.read_token_files(spark, path)


STAGES = [("quality classifier", quality_filter),
          ("n-gram Jaccard join", near_duplicates),
          ("benchmark decontamination", benchmark_decontamination),
          ("mixing sources to target weights", source_mixing),
          ("token-ID / binary output", token_files)]

#: SQL cannot express the classifier, the components or the rates; tests/llm/test_pipeline.py compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, over the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage{k}")
    return docs
