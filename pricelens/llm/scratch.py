"""Written tables that cut lineage, in the folder all executors share."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

from pricelens.session import work_path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for one run under ``spark.checkpoint.dir``."""
    return work_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete the files of tables made by ``written`` that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        for file in df.inputFiles()[:1]:
            path = spark._jvm.org.apache.hadoop.fs.Path(file.rsplit("/", 1)[0])
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release_shuffles(spark: SparkSession) -> None:
    """Files of shuffles that no plan holds any more go now, not when the driver's heap is next collected."""
    gc.collect()
    spark._jvm.System.gc()
