"""Typed scans of landed entities (S1, S4, S6): of a chain landed more than once, the pages that count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailsync import constants as C
from mailsync import schemas as S
from mailsync.operators.attempts import counting_chains
from mailsync.sources.pages import flatten_pages, parse_items


def full_user_messages(pages: DataFrame) -> DataFrame:
    """The counting pages of the per-user full chains of messages (no token, no folder in the chain)."""
    p = pages.filter((F.col("resource") == "messages") & F.col("folder_id").isNull() & (F.col("request_token") == ""))
    return counting_chains(p, ["user_id"])


def scan_users(pages: DataFrame, fields: str | None = C.USER_FIELDS_DEFAULT) -> DataFrame:
    """Every user of the full-load users chain (following pages to the end)."""
    p = pages.filter((F.col("resource") == "users") & (F.col("request_token") == ""))
    return parse_items(flatten_pages(counting_chains(p, ["request_token"]), ["page_no"]), S.USER_DDL, fields, keep=[])


def scan_messages(pages: DataFrame, fields: str | None = C.MESSAGE_FIELDS_DEFAULT) -> DataFrame:
    """All messages of each user over all folders."""
    return parse_items(flatten_pages(full_user_messages(pages), ["user_id"]), S.MESSAGE_DDL, fields, keep=["user_id"])


def scan_attachments(pages: DataFrame, fields: str | None = None) -> DataFrame:
    """Every attachment of every message, over all pages of each message's chain."""
    p = pages.filter(F.col("resource") == "attachments")
    return parse_items(flatten_pages(counting_chains(p, ["user_id", "message_id", "request_token"]), ["user_id", "message_id"]),
                       S.ATTACHMENT_DDL, fields, keep=["user_id", "message_id"])
