"""K3: records out (content + attributes, one per record), partitioned by route."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mailsync import schemas as S


def write_records(records: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """One file set per route (``route=<name>/``), so each named output is a directory."""
    (records.select("route", "attributes", "content", "emit_seq")
     .write.mode(mode).partitionBy("route").format(fmt).save(path))


def read_records(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.schema(S.RECORD_DDL).format(fmt).load(path).select("route", "attributes", "content",
                                                                           "emit_seq")
