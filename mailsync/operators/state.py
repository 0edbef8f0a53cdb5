"""Incremental state: token lookup (J1), bootstrap (J2), seeding new work (J4), last token of a
chain (T1), token records (T2, T3), checkpoint upsert (T4) and bulk checkpoint admin (T6).

The checkpoint map is a table ``(key, delta, version)`` with one row per key per version
directory; readers take the latest version (see ``sources.checkpoints``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailsync import constants as C
from mailsync.functions.checks import request_token, token_changed
from mailsync.functions.fields import attrs_of, inherit
from mailsync.operators.attempts import links_of, tokens_of_links
from mailsync.session import written


def lookup_token(keys: DataFrame, ckpt: DataFrame, key: str = "key") -> DataFrame:
    """The stored token (``delta``, null when unknown) for each key.

    A plain left equi-join: the planner (with AQE's run-time sizes) picks broadcast when the
    checkpoint side turns out small and a sort-merge join otherwise, splitting skewed partitions.
    """
    c = ckpt.select(F.col("key").alias(key), "delta")
    return keys.join(c, on=key, how="left")


def bootstrap(matched: DataFrame, default_key: str) -> DataFrame:
    """When no key matched, one run with no token; otherwise nothing.

    The matched keys are reduced to a single count first (a partial aggregate), so this never
    moves the keys themselves.
    """
    n = matched.agg(F.count(F.lit(1)).alias("_n"))
    return n.filter(F.col("_n") == 0).select(F.lit(default_key).alias("key"),
                                             F.lit(None).cast("string").alias("delta"))


def seed_work(parent_keys: DataFrame, ckpt: DataFrame, key: str = "key") -> DataFrame:
    """Parent cache keys not yet in the checkpoint map become new work with ``delta = ''``."""
    known = ckpt.select(F.col("key").alias(key))
    return (parent_keys.select(key).distinct().join(known, on=key, how="left_anti")
            .select(F.col(key).alias("key"), F.lit("").alias("delta")))


def work_from(keys: DataFrame) -> DataFrame:
    """Adds the token each chain is asked with (F3: blank or null = full load = '')."""
    return keys.withColumn("request_token", request_token(F.col("delta")))


def chain_tokens(pages: DataFrame, chain: list[str]) -> DataFrame:
    """The delta link of each chain with a complete attempt (see :mod:`mailsync.operators.attempts`).

    A page whose body does not parse counts as missing. Bodies are dropped before any shuffle.
    """
    return tokens_of_links(links_of(pages, chain), chain)


def reachable_tokens(edges: DataFrame, start: DataFrame, entity: list[str]) -> DataFrame:
    """``entity..., request_token``: the tokens of ``start`` and all that follow from them over ``edges``
    (``entity..., request_token, new_delta``, one per closed chain).

    Pointer jumping: each round adds the tokens one jump ahead and doubles the jump, so k tokens in a row
    take about log2 k rounds. Ends when a round adds nothing, also where tokens run in a circle.
    """
    jump = edges.select(*entity, "request_token", "new_delta").filter("new_delta is not null and new_delta != request_token").distinct()
    reached = written(start.select(*entity, "request_token").distinct(), "reached")
    n = reached.count()
    while True:
        ahead = reached.join(jump, [*entity, "request_token"]).select(*entity, F.col("new_delta").alias("request_token"))
        reached = written(reached.union(ahead).distinct(), "reached")
        if (more := reached.count()) == n:
            return reached
        n = more
        further = jump.select(*entity, F.col("request_token").alias("new_delta"), F.col("new_delta").alias("further"))
        jump = written(jump.join(further, [*entity, "new_delta"]).select(*entity, "request_token", F.col("further").alias("new_delta")), "jumps")


def token_records(tokens: DataFrame, route: str, base_attrs: Column | None = None,
                  key: str = "key", new: str = "new_delta", old: str = "delta",
                  always: bool = False) -> DataFrame:
    """One record per changed token: ``office365_delta``, ``office365_delta_key``, and the
    link itself as content. F4 drops unchanged tokens unless ``always`` (delta variants)."""
    t = tokens if always else tokens.filter(token_changed(F.col(old), F.col(new)))
    t = t.filter(F.col(new).isNotNull())
    extra = attrs_of({C.ATTR_DELTA: F.col(new), C.ATTR_DELTA_KEY: F.col(key)})
    a = inherit(base_attrs, extra) if base_attrs is not None else extra
    return t.select(F.lit(route).alias("route"), a.alias("attributes"), F.col(new).alias("content"),
                    F.lit(C.EMIT_TOKEN).cast("bigint").alias("emit_seq"))


def latest_per_key(rows: DataFrame, order: str | None = None) -> DataFrame:
    """The row of the highest version per key (for the small side: new tokens, deltas).

    Of equal versions the highest ``order`` wins, or without one the greatest delta, so that the
    choice is always the same."""
    place = [F.col("version"), *([F.col(order)] if order else []), F.col("delta")]
    return (rows.groupBy("key").agg(F.max(F.struct(*place)).alias("_w")).select("key", "_w.delta", "_w.version"))


def upsert_checkpoints(ckpt: DataFrame, tokens: DataFrame, version: int | Column, order: str | None = None) -> DataFrame:
    """T4: the new map = old map overlaid by the new tokens (the new version wins per key).

    ``tokens`` has ``key`` and ``delta``. Only the new side is aggregated; the old map is never
    grouped: its rows whose key got a new token are dropped with an anti-join (AQE broadcasts the
    changed keys when few), and the new rows are appended.
    """
    v = version if isinstance(version, Column) else F.lit(version).cast("bigint")
    new = latest_per_key(tokens.select("key", "delta", v.alias("version"), *([order] if order else [])), order)
    kept = ckpt.select("key", "delta", "version").join(new.select("key"), on="key", how="left_anti")
    return kept.unionByName(new)


# ---- T6: bulk admin over the map -------------------------------------------------------------

def ckpt_get(ckpt: DataFrame, keys: DataFrame) -> DataFrame:
    """Get many: the stored rows for the asked keys (a semi-join)."""
    return ckpt.join(keys.select("key").distinct(), on="key", how="left_semi")


def ckpt_put(ckpt: DataFrame, pairs: DataFrame, version: int | Column, order: str | None = None) -> DataFrame:
    """Put pairs (key, delta); a pair without a value (the odd tail) is ignored.

    Of several pairs with one key the last wins, where ``order`` names the column with their
    places (rows of a DataFrame have none); without it the greatest delta wins."""
    return upsert_checkpoints(ckpt, pairs.filter(F.col("key").isNotNull() & F.col("delta").isNotNull()),
                              version, order)


def ckpt_remove(ckpt: DataFrame, keys: DataFrame) -> DataFrame:
    """Remove many: an anti-join."""
    return ckpt.join(keys.select("key").distinct(), on="key", how="left_anti")


def ckpt_keys(ckpt: DataFrame) -> DataFrame:
    """List keys."""
    return ckpt.select("key")
