"""Small helpers shared by the operators: input columns, shared scratch tables, bounded lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailsync.session import scratch_path

ARROW_ROWS = 1000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound what a task holds of texts at once: Arrow batches of ``ARROW_ROWS`` rows at most.

    Spark ends a batch at 64 MB as well, but buffers of that size in the JVM and twice in Python, in
    every task, are a large part of a small executor."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)


def id_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` only, so that other columns of ``docs`` can never clash."""
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, read back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

