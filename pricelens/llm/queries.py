"""Registered queries of the llm operators, over the whole given tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.llm import (
    byte_bpe, decontaminate, exact_dedup, mixing, periodic, pitman_yor, quality, resampling, scratch, secret_scan, shingle_join,
    token_counts, token_store, warc)
from pricelens.llm.shipping import prepare

TOKENIZER = "word_bpe_49k.json"
RANKS = "byte_bpe_multi_50k.tiktoken"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def language_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domains of the labelled documents: their language."""
    docs = table(spark, sf_dir, "documents")
    return table(spark, sf_dir, "labels").select("doc_id").join(docs.select("doc_id", F.col("lang").alias("domain")), "doc_id")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mixing.mixing_rates(table(spark, sf_dir, "documents"), language_labels(spark, sf_dir))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path())


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return secret_scan.scored_findings(table(spark, sf_dir, "documents"), audited=table(spark, sf_dir, "labels"))


def op4_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return shingle_join.shingle_components(table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    path = scratch.scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    return quality.quality_scores(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = decontaminate.retrieved_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.filter("leaked").drop("leaked")


def op9_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return pitman_yor.language_model_scores(table(spark, sf_dir, "documents"))


def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    path = scratch.scratch_path(spark, "tokens")
    token_store.write_token_files(table(spark, sf_dir, "documents"), path, tokenizer_path())
    return token_store.read_token_files(spark, path)


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the text that they decode to, as digests."""
    import public_tokenizers

    prepare(spark)
    coded = byte_bpe.encode_texts(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN, decoded=True)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """The documents, of which a tenth (by the crc32 of the id) repeat words from some place on."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    chosen = docs.filter((h % 10 == 0) & (F.size(words) > 0))
    others = docs.filter(~F.coalesce((h % 10 == 0) & (F.size(words) > 0), F.lit(False)))
    parts = chosen.select("doc_id", words.alias("w"), g.alias("g")).withColumns(
        {"n": F.size("w").cast("long"), "a": (F.col("g") % F.size("w")).cast("long")})
    parts = parts.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    told = F.transform("w", lambda w, i: F.when(i < F.col("a"), w).otherwise(
        F.get("w", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))))
    return parts.select("doc_id", F.array_join(told, " ").alias("text")).unionByName(others.select("doc_id", "text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document (some with planted periods), the best one by exact length / period, and digests."""
    prepare(spark)
    found = periodic.periodic_runs(with_planted_periods(table(spark, sf_dir, "documents")))

    def better(x, y):  # noqa: ANN001, ANN202
        more = x["length"] * y["period"] - y["length"] * x["period"]
        return F.when(more > 0, -1).when(more < 0, 1).when(x["start"] != y["start"], F.sign(x["start"] - y["start"]).cast("int")) \
            .otherwise(F.sign(x["period"] - y["period"]).cast("int"))

    best = F.get(F.array_sort("runs", better), F.lit(0))
    told = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(told, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return resampling.importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_mixing, op2_token_counts, op3_secret_scan, op4_shingle_join, op5_warc, op6_quality, op7_exact_dedup,
        op8_decontamination, op9_pitman_yor, op10_token_store, op11_byte_bpe, op12_periodic_runs, op13_resampling)}


_NORMAL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP5_SQL = """
WITH records AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
firsts AS (SELECT payload_digest, min(page_id) AS first_id FROM records WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_id < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id < page_id THEN first_id END AS refers_to
FROM records LEFT JOIN firsts USING (payload_digest)
"""

OP7_SQL = f"""
WITH t AS (SELECT doc_id, {_NORMAL} AS norm FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM t JOIN g USING (norm)
"""


def oracle_sql() -> dict[str, str]:
    return {"op5_warc": OP5_SQL, "op7_exact_dedup": OP7_SQL}
