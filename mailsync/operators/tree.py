"""Expand parents to children (user -> folders, folder -> messages, message -> attachments).

As data this is an inner equi-join: parents without children give nothing. No side is
broadcast by hint; AQE measures both sides at run time, broadcasts one that is small, and
splits skewed partitions of a sort-merge join (a mailbox holding a third of all items).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailsync.functions.fields import inherit


def expand_children(parents: DataFrame, children: DataFrame, on: list[str],
                    parent_attrs: str | None = None, child_attrs: Column | None = None) -> DataFrame:
    """Children joined to their parent on ``on``; with ``parent_attrs`` given, the children's
    ``attributes`` are the parent's overlaid by ``child_attrs`` (P4)."""
    j = children.join(parents, on=on, how="inner")
    if parent_attrs is not None:
        extra = child_attrs if child_attrs is not None else F.create_map().cast("map<string,string>")
        j = j.withColumn("attributes", inherit(F.col(parent_attrs), extra))
    return j
