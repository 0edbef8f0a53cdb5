"""Routing (R1-R5): one record table with a ``route`` column instead of named outputs.

Records are ``(route STRING, attributes MAP<STRING,STRING>, content STRING, emit_seq BIGINT)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailsync import constants as C
from mailsync.functions.fields import attrs_of, inherit

RECORD_COLS = ["route", "attributes", "content", "emit_seq"]


def record(route, attributes: Column, content: Column, emit_seq: int) -> list[Column]:
    r = route if isinstance(route, Column) else F.lit(route)
    return [r.alias("route"), attributes.alias("attributes"), content.cast("string").alias("content"),
            F.lit(emit_seq).cast("bigint").alias("emit_seq")]


def route_counts(records: DataFrame) -> DataFrame:
    """How many records went down each route (partial aggregation; a handful of output rows)."""
    return records.groupBy("route").agg(F.count(F.lit(1)).alias("n_records"))


def error_records(failed: DataFrame, error: Column, error_class: Column | str,
                  variant: str = "base", keep_attrs: bool = False) -> DataFrame:
    """R2: failure records with an error message and an error class (in place of JVM stack text).

    ``variant`` picks the attribute names: ``base`` (``Office365.*``), ``message`` or ``folder``
    (the delta processors' names). With ``keep_attrs`` the input attributes are kept (delta
    variants); otherwise the record carries the error attributes only.
    """
    names = {"base": (C.ATTR_ERROR, C.ATTR_STACK),
             "message": (C.ATTR_MSG_ERROR, C.ATTR_MSG_STACK),
             "folder": (C.ATTR_FOLDER_ERROR, C.ATTR_FOLDER_STACK)}[variant]
    cls = F.lit(error_class) if isinstance(error_class, str) else error_class
    extra = attrs_of({names[0]: error, names[1]: cls})
    a = inherit(F.col("attributes"), extra) if keep_attrs else extra
    content = F.col("content") if "content" in failed.columns else F.lit("")
    return failed.select(F.lit(C.ROUTE_FAILURE).alias("route"), a.alias("attributes"),
                         content.cast("string").alias("content"),
                         F.lit(C.EMIT_ITEM).cast("bigint").alias("emit_seq"))


def union_records(*parts: DataFrame) -> DataFrame:
    """Entity and token records on one route set (``unionByName``, no shuffle)."""
    out = parts[0].select(*RECORD_COLS)
    for p in parts[1:]:
        out = out.unionByName(p.select(*RECORD_COLS))
    return out


def passthrough_original(inputs: DataFrame) -> DataFrame:
    """The input record also goes to ``Original`` on success, unchanged."""
    return inputs.select(F.lit(C.ROUTE_ORIGINAL).alias("route"), "attributes", "content", "emit_seq")

