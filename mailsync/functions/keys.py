"""Checkpoint keys: format (P6), parse (P7) and select by full-match pattern (F1)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailsync import constants as C


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def messages_key(user, folder) -> Column:
    """``O365_messages|<user>|<folder>``."""
    return F.concat_ws(C.KEY_SEP, F.lit(C.KEY_MESSAGES_PREFIX), _col(user), _col(folder))


def folders_key(user) -> Column:
    """``O365_folders|<user>``."""
    return F.concat_ws(C.KEY_SEP, F.lit(C.KEY_FOLDERS_PREFIX), _col(user))


def users_key() -> Column:
    """The single ``O365_users_delta`` key."""
    return F.lit(C.KEY_USERS)


def parse_key(key, want_folder: bool) -> dict[str, Column]:
    """Split on a literal ``|``; part 1 = user, part 2 = folder.

    Returns ``user``, ``folder`` and ``key_ok``. A missing **or blank** part makes ``key_ok`` false:
    Java's split drops trailing empty strings, so ``O365_messages|7|`` has no folder part.
    """
    parts = F.split(_col(key), r"[|]")
    user = F.try_element_at(parts, F.lit(2))
    folder = F.try_element_at(parts, F.lit(3))
    ok = F.coalesce(user, F.lit("")) != ""
    if want_folder:
        ok = ok & (F.coalesce(folder, F.lit("")) != "")
    return {"user": user, "folder": folder if want_folder else F.lit(None).cast("string"),
            "key_ok": ok}


_CHECKED: set[str] = set()


def check_pattern(spark, pattern: str, prefix: str) -> str:
    """F1 configuration check, run once per pattern on the driver: the pattern must compile (with
    the JVM's own regex engine, the one ``rlike`` uses) and must name its prefix."""
    if prefix not in pattern:
        raise ValueError(f"key pattern {pattern!r} must contain the prefix {prefix!r}")
    if pattern in _CHECKED:
        return pattern
    try:
        spark.range(1).select(F.lit("").rlike(pattern)).collect()
    except Exception as exc:  # a bad pattern would otherwise fail the whole query inside rlike
        raise ValueError(f"key pattern does not compile: {pattern!r}") from exc
    _CHECKED.add(pattern)
    return pattern


def _implies_prefix(pattern: str, prefix: str) -> bool:
    """True when every full match of ``pattern`` starts with ``prefix`` (no top-level alternation)."""
    if not pattern.startswith(prefix):
        return False
    rest = pattern[len(prefix):]
    if rest[:1] in ("?", "*", "+", "{"):  # a quantifier on the prefix's last character
        return False
    return "|" not in re.sub(r"\\.", "", rest)


def full_match(col, pattern: str) -> Column:
    """Java ``String.matches``: the whole key must match, not a part of it."""
    return _col(col).rlike(r"\A(?:" + pattern + r")\z")


def filter_keys(ckpt: DataFrame, pattern: str, prefix: str) -> DataFrame:
    """checkpoint rows whose key fully matches ``pattern``.

    When the pattern implies it, a ``startswith(prefix)`` conjunct is added next to the regex so
    Parquet can skip row groups on it; the regex alone decides the result.
    """
    check_pattern(ckpt.sparkSession, pattern, prefix)
    cond = full_match("key", pattern)
    if _implies_prefix(pattern, prefix):
        cond = F.col("key").startswith(prefix) & cond
    return ckpt.filter(cond)
