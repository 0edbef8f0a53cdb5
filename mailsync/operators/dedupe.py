"""T5: drop replayed records.

After an error the original processors refresh their token and rerun the whole load once, so records
already committed come again. Records are equal when route, emit order, attributes and content
are equal. Maps cannot be grouped on, so attributes are compared as their sorted entries.
The distinct is an aggregate with map-side partial aggregation: a record replayed many times
collapses inside each task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def record_identity(attributes: str = "attributes"):
    return F.array_sort(F.map_entries(F.col(attributes)))


def dedupe_replay(records: DataFrame) -> DataFrame:
    """Exact de-duplication of records (no hashing shortcut, so distinct records never merge).

    Every column is part of the identity, so this is a ``distinct`` with no aggregate buffer: a
    hash aggregate (partial on the map side), never a sort-based one."""
    return (records.select("route", "emit_seq", "content", record_identity().alias("_attrs"))
            .distinct()
            .select("route", F.map_from_entries("_attrs").alias("attributes"), "content", "emit_seq"))
