"""Connected components of an edge table by alternating large-star and small-star steps.

Each step is an aggregate by node and a join back; a node with a third of all edges is combined
before the shuffle and its rows are split by Spark's skew join. Steps are written to the shared
folder, so lineage stays short. Ends when the edges no longer change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailsync.llm.frames import written

MOST_STEPS = 60  # steps grow with the logarithm of the nodes


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    return (down.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v"))))


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` of every node ``u`` or ``v`` but the components' smallest nodes."""
    now = written(edges.select("u", "v").filter("u != v").distinct(), "edges")
    mark = F.struct(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
    before = None
    for _ in range(MOST_STEPS):
        now = written(_small_star(written(_large_star(now).distinct(), "edges")).distinct(), "edges")
        state = now.agg(mark.alias("x")).first().x
        if state == before:
            return now.select(F.col("u").alias("id"), F.col("v").alias("component"))
        before = state
    raise RuntimeError(f"components did not settle in {MOST_STEPS} steps")
