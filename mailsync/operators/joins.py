"""Joins that keep null keys, and broadcasts behind a count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000  # of key columns only: some tens of megabytes


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where a null key matches a null key (``<=>``), so rows whose key
    holds a null are kept, not silently dropped. Still a hash/sort-merge join on the keys."""
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        cond = c if cond is None else cond & c
    joined = left.join(r, on=cond, how=how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_r_{k}" for k in keys])


def few(keys: DataFrame) -> bool:
    """Whether there are at most ``BROADCAST_ROWS`` of ``keys``."""
    return keys.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS


def sized(keys: DataFrame) -> DataFrame:
    """``keys`` with a broadcast hint if there are at most ``BROADCAST_ROWS`` of them."""
    return F.broadcast(keys) if few(keys) else keys
