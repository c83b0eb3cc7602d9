"""CSV sink and source for reports and histories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pricelens.schemas import HISTORY, REPORT_SCHEMAS


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Replace ``path`` with ``df`` as CSV with a header.

    ``single_file`` only for bounded results (a top-k report has at most
    k rows per store); histories are written by all tasks in parallel.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def read_report_csv(spark: SparkSession, path: str, report: str) -> DataFrame:
    """Read a report folder with its declared schema (no inference)."""
    schema = HISTORY if report == "history" else REPORT_SCHEMAS[report]
    return spark.read.schema(schema).option("header", True).csv(path)
