"""The composed sync plans: checkpoint keys -> landed page chains -> records + tokens.

One declarative plan per level (users, folders, messages, attachments) replaces one API call per
key. Each returns ``(records, tokens)``: ``records`` in the record shape (route, attributes,
content, emit_seq), ``tokens`` as ``(key, delta, new_delta)`` for the checkpoint upsert (T4).

Scale notes:

* the work of a level (one row per key) is written once; the buckets of its chains prune the landing, and
  pages are semi-joined to its keys before a body is parsed: by broadcast up to a counted number of
  keys, by a shuffle beyond;
* the links of these pages are parsed once and written. Tokens, and the attempts and pages that count
  (``operators.attempts``), come from them with hash aggregates over numbers; bodies move only if some of
  the pages do not count, or if the keys are too many to broadcast;
* pages are flattened last; a mailbox that holds a third of all items stays spread over its files;
* a page that does not parse keeps its chain incomplete; ``bad_pages`` reports such pages once,
  where pages land.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailsync import constants as C
from mailsync.functions.checks import token_changed
from mailsync.functions.fields import attachment_attrs, attrs_of, inherit
from mailsync.functions.keys import filter_keys, folders_key, messages_key, parse_key
from mailsync.operators.attempts import counting, decide, links_of, newest_attempts, page_links, tokens_of_links
from mailsync.operators.joins import few, join_null_safe, sized
from mailsync.operators.routes import error_records, passthrough_original, record, union_records
from mailsync.operators.state import bootstrap, reachable_tokens, token_records, work_from
from mailsync.session import written
from mailsync.sources.pages import flatten_pages, is_tombstone, item_field, of_chains, with_links
from mailsync.sources.scans import full_user_messages


def _base(input_attrs: dict | None) -> Column:
    if not input_attrs:
        return F.create_map().cast("map<string,string>")
    return attrs_of({k: F.lit(v) for k, v in input_attrs.items()})


class Selected(NamedTuple):
    """The landed pages of the chains of some work, and their links (parsed once)."""
    pages: DataFrame
    links: DataFrame
    work: DataFrame
    chain: list[str]

    def records_of(self, dedupe: bool = True) -> DataFrame:
        """The pages that count with the columns of the work; all landed pages with ``dedupe`` off."""
        own = counting(self.pages, self.links, self.chain) if dedupe else self.pages
        # rows of the work may be many and wide (attributes): the planner picks the join by measured sizes
        return own.join(self.work, on=self.chain, how="inner")

    def tokens(self) -> DataFrame:
        """The work rows whose chain has a complete attempt, with ``new_delta``."""
        return self.work.join(tokens_of_links(self.links, self.chain), on=self.chain, how="inner")

    def unread(self) -> DataFrame:
        """Rows of the work whose chain has a page that does not parse and no complete attempt."""
        readable = self.links.groupBy(*self.chain).agg(F.count(F.lit(1)).alias("readable"))
        landed = self.pages.groupBy(*self.chain).agg(F.count(F.lit(1)).alias("landed"))
        bad = landed.join(readable, self.chain, "left").filter("landed > coalesce(readable, 0)")
        return (self.work.join(bad, on=self.chain, how="left_semi")
                .join(newest_attempts(self.links, self.chain), on=self.chain, how="left_anti"))


def select_chains(pages: DataFrame, resource: str, work: DataFrame, chain: list[str]) -> Selected:
    """The resource's pages of the chains in ``work``: pruned by bucket, then by key, then parsed for links."""
    work = written(work, "work")
    found = of_chains(pages.filter(F.col("resource") == resource), work)
    found = found.join(sized(work.select(*chain).distinct()), on=chain, how="left_semi")
    return Selected(found, links_of(found, chain), work, chain)


def bad_pages(pages: DataFrame, chain: list[str] | None = None) -> DataFrame:
    """Landing validation: pages whose body is not a JSON page (the API client would have failed
    on them), one ``Failure`` record each naming the chain and page.

    Run once where pages land, not inside every sync: the syncs already treat such a page as
    missing (its chain never completes, so its token is held back and the next run asks again
    from the old token), and a second parse of every page per sync would cost a full pass."""
    chain = chain or ["resource", "user_id", "folder_id", "message_id", "request_token"]
    bad = with_links(pages).filter(~F.col("page_ok"))
    a = attrs_of({**{f"office365_{c}": F.col(c) for c in chain}, "page_no": F.col("page_no")})
    return error_records(bad.select(a.alias("attributes"), F.col("body").alias("content")),
                         F.lit("page body is not JSON"), "JsonParseException", keep_attrs=True)


def _chain_failures(failed: DataFrame, variant: str) -> DataFrame:
    """R2 of the record-driven variants: the input's attributes and content with their error names."""
    return error_records(failed.select(F.col("input_attrs").alias("attributes"), F.col("input_content").alias("content")),
                         F.lit("page body is not JSON"), "JsonParseException", variant=variant, keep_attrs=True)


def _bad_keys(work: DataFrame) -> DataFrame:
    failed = work.filter(~F.col("key_ok"))
    return error_records(failed.select(F.lit("").alias("content"), "key"),
                         F.concat(F.lit("malformed checkpoint key: "), F.col("key")),
                         "ArrayIndexOutOfBoundsException")


# ---- messages (S5): keys O365_messages|user|folder -------------------------------------------------

def message_work(ckpt: DataFrame, pattern: str = C.REGEX_MESSAGES_DEFAULT) -> DataFrame:
    """F1 + P7 + F3: the keys to sync, parsed, with the token each chain is asked with."""
    keys = filter_keys(ckpt, pattern, C.KEY_MESSAGES_PREFIX)
    pk = parse_key(F.col("key"), want_folder=True)
    return work_from(keys.select("key", "delta", pk["user"].alias("user_id"),
                                 pk["folder"].alias("folder_id"), pk["key_ok"].alias("key_ok")))


MESSAGE_CHAIN = ["user_id", "folder_id", "request_token"]


def select_message_chains(pages: DataFrame, work: DataFrame) -> Selected:
    """The landed message pages of the chains the work asks for (carrying ``key`` and ``delta``)."""
    return select_chains(pages, "messages", work.filter(F.col("key_ok")).select(*MESSAGE_CHAIN, "key", "delta"), MESSAGE_CHAIN)


def message_records(sel: DataFrame, input_attrs: dict | None = None,
                    route: str = C.ROUTE_SUCCESS_MESSAGES) -> DataFrame:
    """Message records of selected pages: input attributes plus user, folder and message ids."""
    items = flatten_pages(sel, MESSAGE_CHAIN + ["page_no"])
    ids = attrs_of({C.ATTR_USER_ID: F.col("user_id"), C.ATTR_FOLDER_ID: F.col("folder_id"),
                    C.ATTR_MESSAGE_ID: item_field("id")})
    return items.select(*record(route, inherit(_base(input_attrs), ids), F.col("item"), C.EMIT_ITEM))


def message_tokens(pages: DataFrame, work: DataFrame) -> DataFrame:
    """T1 per chain of the work: ``(user_id, folder_id, request_token, key, delta, new_delta)``."""
    return select_message_chains(pages, work).tokens()


def sync_messages(pages: DataFrame, ckpt: DataFrame, pattern: str = C.REGEX_MESSAGES_DEFAULT,
                  input_attrs: dict | None = None, route: str = C.ROUTE_SUCCESS_MESSAGES,
                  always_emit_token: bool = False, dedupe: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """S5 (cache variant): messages of every matching folder key from its token on.

    Returns ``(records, tokens, failures)``. Message records carry the input attributes plus user,
    folder and message ids; token records go to the same route (R3) after them (R5).
    """
    work = message_work(ckpt, pattern)
    found = select_message_chains(pages, work)
    records = message_records(found.records_of(dedupe), input_attrs, route)
    tokens = found.tokens()
    tok_records = token_records(tokens, route, _base(input_attrs), always=always_emit_token)
    return union_records(records, tok_records), tokens, _bad_keys(work)


def catch_up_messages(pages: DataFrame, ckpt: DataFrame, pattern: str = C.REGEX_MESSAGES_DEFAULT, input_attrs: dict | None = None,
                      route: str = C.ROUTE_SUCCESS_MESSAGES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """S5 over a landing that holds several runs: from every key's token on, each chain asked with the token
    that the chain before it ended with is synced too.

    Returns ``(records, tokens, failures)`` as :func:`sync_messages`; there is a token record per closed
    chain, and ``tokens`` has the last token of each key.
    """
    work = written(message_work(ckpt, pattern), "work")
    folder, good = ["user_id", "folder_id"], work.filter(F.col("key_ok"))
    found = of_chains(pages.filter(F.col("resource") == "messages"), good)
    found = found.join(sized(good.select(*folder).distinct()), on=folder, how="left_semi")
    links = links_of(found, MESSAGE_CHAIN)
    edges = written(tokens_of_links(links, MESSAGE_CHAIN), "edges")
    reached = reachable_tokens(edges, good, folder)
    keyed = written(reached.join(good.select(*folder, "key", F.col("delta").alias("stored")), on=folder), "reached")
    chosen = found.join(sized(reached), on=MESSAGE_CHAIN, how="left_semi")
    own = counting(chosen, written(links.join(reached, on=MESSAGE_CHAIN, how="left_semi"), "links"), MESSAGE_CHAIN)
    closed = keyed.join(edges, on=MESSAGE_CHAIN).withColumn("delta", F.col("request_token"))
    moved = closed.filter(token_changed("request_token", "new_delta"))
    onward = moved.select(*folder, F.col("request_token").alias("new_delta"))
    last = moved.join(onward, on=[*folder, "new_delta"], how="left_anti").select(*folder, "key", F.col("stored").alias("delta"), "new_delta")
    records = union_records(message_records(own, input_attrs, route), token_records(closed, route, _base(input_attrs)))
    return records, last, _bad_keys(work)


# ---- users (S1/S2): key O365_users_delta ---------------------------------------------------------

def user_work(ckpt: DataFrame, pattern: str = C.REGEX_USERS_DEFAULT) -> DataFrame:
    """F1 + J2: the users key(s); with none matched, one tokenless run."""
    keys = filter_keys(ckpt, pattern, C.KEY_USERS).select("key", "delta")
    return work_from(keys.unionByName(bootstrap(keys, C.KEY_USERS)))


def user_records(pages: DataFrame, input_attrs: dict | None = None, route: str = C.ROUTE_SUCCESS) -> DataFrame:
    """User records of selected pages, each with the folders key its children are fetched under."""
    items = flatten_pages(pages, ["request_token", "page_no"])
    uid = item_field("id")
    a = attrs_of({C.ATTR_USER_ID: uid, C.ATTR_CACHE_KEY: folders_key(uid)})
    return items.select(*record(route, inherit(_base(input_attrs), a), F.col("item"), C.EMIT_ITEM))


def sync_users(pages: DataFrame, ckpt: DataFrame, pattern: str = C.REGEX_USERS_DEFAULT,
               input_attrs: dict | None = None, route: str = C.ROUTE_SUCCESS,
               always_emit_token: bool = False, dedupe: bool = True,
               trigger: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Users from the stored token (full load without one). Each user record carries the
    folders key its children are fetched under (``office365_cache_key``). The records that
    triggered the run (``trigger``), if any, go to ``Original`` (R4)."""
    found = select_chains(pages, "users", user_work(ckpt, pattern).select("request_token", "key", "delta"), ["request_token"])
    records = user_records(found.records_of(dedupe), input_attrs, route)
    tokens = found.tokens()
    recs = union_records(records, token_records(tokens, route, _base(input_attrs), always=always_emit_token))
    return (union_records(recs, passthrough_original(trigger)) if trigger is not None else recs), tokens


# ---- folders (S3): keys O365_folders|user ---------------------------------------------------------

def folder_work(ckpt: DataFrame, pattern: str = C.REGEX_FOLDERS_DEFAULT) -> DataFrame:
    keys = filter_keys(ckpt, pattern, C.KEY_FOLDERS_PREFIX)
    pk = parse_key(F.col("key"), want_folder=False)
    return work_from(keys.select("key", "delta", pk["user"].alias("user_id"), pk["key_ok"].alias("key_ok")))


def folder_records(pages: DataFrame, input_attrs: dict | None = None, route: str = C.ROUTE_SUCCESS) -> DataFrame:
    """Folder records of selected pages, each with the messages key its children are fetched under."""
    items = flatten_pages(pages, ["user_id", "page_no"])
    fid = item_field("id")
    a = attrs_of({C.ATTR_USER_ID: F.col("user_id"), C.ATTR_FOLDER_ID: fid, C.ATTR_CACHE_KEY: messages_key(F.col("user_id"), fid)})
    return items.select(*record(route, inherit(_base(input_attrs), a), F.col("item"), C.EMIT_ITEM))


def sync_folders(pages: DataFrame, ckpt: DataFrame, pattern: str = C.REGEX_FOLDERS_DEFAULT,
                 input_attrs: dict | None = None, route: str = C.ROUTE_SUCCESS,
                 always_emit_token: bool = False, dedupe: bool = True,
                 trigger: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """S3: folders of every matching user key from its token. Each folder record carries the
    messages key its children are fetched under. ``trigger`` as in :func:`sync_users`."""
    work = folder_work(ckpt, pattern)
    good = work.filter(F.col("key_ok")).select("user_id", "request_token", "key", "delta")
    found = select_chains(pages, "folders", good, ["user_id", "request_token"])
    records = folder_records(found.records_of(dedupe), input_attrs, route)
    tokens = found.tokens()
    recs = union_records(records, token_records(tokens, route, _base(input_attrs), always=always_emit_token))
    return (union_records(recs, passthrough_original(trigger)) if trigger is not None else recs), tokens, _bad_keys(work)


def scan_message_records(pages: DataFrame, route: str = C.ROUTE_SUCCESS_MESSAGES) -> DataFrame:
    """S4 as records: every message of the per-user full chains (no folder, no token), with user,
    folder (the message's parent folder) and message ids as attributes."""
    items = flatten_pages(full_user_messages(pages), ["user_id"]).withColumn("_m", F.from_json("item", "id STRING, parentFolderId STRING"))
    ids = attrs_of({C.ATTR_USER_ID: F.col("user_id"), C.ATTR_FOLDER_ID: F.col("_m.parentFolderId"),
                    C.ATTR_MESSAGE_ID: F.col("_m.id")})
    return items.select(*record(route, ids, F.col("item"), C.EMIT_ITEM))


# ---- attachments (J3): message -> attachments -----------------------------------------------------

ATTACHMENT_CHAIN = ["user_id", "message_id", "request_token"]


def attachment_parents(message_records: DataFrame, dedupe: bool = True) -> DataFrame:
    """``user_id, message_id, parent_attrs`` of the message records that can have attachments: no tombstones
    (removed messages have none), no token records; equal ones once unless told not to."""
    msgs = (message_records.filter((F.col("emit_seq") == C.EMIT_ITEM) & ~is_tombstone("content"))
            .select(F.col("attributes")[C.ATTR_USER_ID].alias("user_id"), F.col("attributes")[C.ATTR_MESSAGE_ID].alias("message_id"),
                    F.array_sort(F.map_entries("attributes")).alias("entries"))
            .filter(F.col("message_id").isNotNull()))
    msgs = msgs.distinct() if dedupe else msgs  # a map can not be compared, its sorted entries can
    return msgs.select("user_id", "message_id", F.map_from_entries("entries").alias("parent_attrs"))


def attachment_records(pages: DataFrame, route: str = C.ROUTE_SUCCESS_ATTACHMENTS, with_file_attrs: bool = True) -> DataFrame:
    """Attachment records of pages that carry their message's ``parent_attrs``. Within a page attachments are
    a bag: no key on them is assumed."""
    items = flatten_pages(pages, ["parent_attrs"]).withColumn("_a", F.from_json("item", "name STRING, contentType STRING"))
    extra = attachment_attrs(F.col("_a.contentType"), F.col("_a.name")) if with_file_attrs else F.create_map().cast("map<string,string>")
    return items.select(*record(route, inherit(F.col("parent_attrs"), extra), F.col("item"), C.EMIT_ATTACHMENT))


def expand_attachments(message_records: DataFrame, pages: DataFrame,
                       route: str = C.ROUTE_SUCCESS_ATTACHMENTS, with_file_attrs: bool = True,
                       dedupe: bool = True) -> DataFrame:
    """J3 + P4 + P5: each message record's attachments, inheriting the message's attributes.

    Message records without attachments give nothing (inner join). With ``dedupe`` (the default) the
    attachments are those of the attempt that counts (an unfinished rerun never hides a complete one),
    pages landed again count once, and equal message records count once.

    The messages prune the landing (by their users' buckets); few of them semi-join the pages before a body is
    read, many only the links. Attempts are chosen on links, and the pages that count are flattened last.
    """
    msgs = written(attachment_parents(message_records, dedupe), "parents")
    keys = ["user_id", "message_id"]
    found = of_chains(pages.filter(F.col("resource") == "attachments"), msgs)
    wanted = msgs.select(*keys).distinct()
    near = few(wanted)
    if near:
        found = found.join(F.broadcast(wanted), on=keys, how="left_semi")
    if not dedupe:
        return attachment_records(found.join(msgs, on=keys, how="inner"), route, with_file_attrs)
    links = page_links(found, ATTACHMENT_CHAIN)
    # with many messages only the links are sifted: a body moves once, to the messages that have it
    count = decide(written(links if near else links.join(wanted, on=keys, how="left_semi"), "links"), ATTACHMENT_CHAIN)
    if count.all_count or near or not count.all_whole:
        return attachment_records(count.pages_of(found).join(msgs, on=keys, how="inner"), route, with_file_attrs)
    asked = msgs.join(count.by_chain.select(*ATTACHMENT_CHAIN, F.col("attempt").alias("chosen")), on=keys, how="inner")
    pages_of_msgs = (join_null_safe(count.of_runs(found), asked, ATTACHMENT_CHAIN)
                     .filter("chosen is null or attempt = chosen"))
    return attachment_records(pages_of_msgs, route, with_file_attrs)


def new_tokens(tokens: DataFrame) -> DataFrame:
    """Changed tokens as ``(key, delta)`` pairs for T4."""
    return (tokens.filter(token_changed(F.col("delta"), F.col("new_delta")))
            .select("key", F.col("new_delta").alias("delta")))


# ---- record-driven delta (3.2): input records carry user, folder and token ---------------------

def sync_messages_from_records(pages: DataFrame, inputs: DataFrame,
                               delta_attr: str = C.ATTR_DELTA) -> tuple[DataFrame, DataFrame, DataFrame]:
    """S5 (delta variant): every input record names a user, a folder and (in the attribute named by
    ``delta_attr``) a token. Returns ``(records, delta_records, failures)``.

    * F2: a record without user or folder id goes to ``Failure`` unchanged, with no error attributes;
    * a record whose chain has an unreadable page (and no complete attempt) goes to ``Failure`` with its
      attributes and the error's (R2);
    * message records inherit the input attributes and always get the ids (a deliberate choice);
    * the token goes to the ``Delta`` route on every run, carrying only the ids (T3).
    """
    ok = F.col("attributes")[C.ATTR_USER_ID].isNotNull() & F.col("attributes")[C.ATTR_FOLDER_ID].isNotNull()
    failed = inputs.filter(~ok).select(F.lit(C.ROUTE_FAILURE).alias("route"), "attributes", "content",
                                       "emit_seq")
    work = work_from(inputs.filter(ok).select(
        F.col("attributes")[C.ATTR_USER_ID].alias("user_id"),
        F.col("attributes")[C.ATTR_FOLDER_ID].alias("folder_id"),
        F.col("attributes")[delta_attr].alias("delta"),
        F.col("attributes").alias("input_attrs"), F.col("content").alias("input_content")))
    found = select_chains(pages, "messages", work, MESSAGE_CHAIN)
    failed = union_records(failed, _chain_failures(found.unread(), "message"))
    items = flatten_pages(found.records_of(), [*MESSAGE_CHAIN, "page_no", "input_attrs"])
    ids = attrs_of({C.ATTR_USER_ID: F.col("user_id"), C.ATTR_FOLDER_ID: F.col("folder_id"),
                    C.ATTR_MESSAGE_ID: item_field("id")})
    records = items.select(*record(C.ROUTE_SUCCESS_MESSAGES, inherit(F.col("input_attrs"), ids),
                                   F.col("item"), C.EMIT_ITEM))
    delta = found.tokens().filter(F.col("new_delta").isNotNull()).select(
        *record(C.ROUTE_DELTA, attrs_of({C.ATTR_USER_ID: F.col("user_id"), C.ATTR_FOLDER_ID: F.col("folder_id")}),
                F.col("new_delta"), C.EMIT_TOKEN))
    return records, delta, failed


# ---- the whole cache-driven sync (3.1): users -> folders -> messages -> attachments -----------------

def sync_tenant(pages: DataFrame, ckpt: DataFrame, out_dir: str | None = None,
                input_attrs: dict | None = None, dedupe: bool = True):
    """One run of the cache-driven sync over a landed tenant.

    users (from their token, J2 bootstrap when unknown) -> folder work = stored folder keys plus
    the new users' keys (J4) -> folders -> message work = stored message keys plus the new folders'
    keys (J4) -> messages -> their attachments (J3).

    Each level is one job: its records, token records and failures are written under ``out_dir``
    (default: a fresh folder under ``spark.checkpoint.dir``), partitioned by level and route, and a
    marker file is written after them. The next level reads back only the column it needs (the
    children's cache keys, or the message ids), and the changed tokens are read from the written
    token records. A rerun with the same ``out_dir`` skips the levels that have a marker and writes
    the others anew.

    Returns ``(records, new_tokens, failures)`` read from the written levels: records on the routes
    ``Success`` (users, folders and their tokens), ``success_messages`` and
    ``success_attachments``; tokens as ``(key, delta)`` for the checkpoint store (T4).
    """
    from mailsync.operators.state import seed_work
    from mailsync.session import scratch_path
    from mailsync.sources.checkpoints import is_marked, mark
    from mailsync.sources.sink import read_records, write_records

    spark = pages.sparkSession
    out = (out_dir or scratch_path(spark, "tenant")).rstrip("/")
    base = ckpt.select("key", "delta")

    def level(name: str, make) -> DataFrame:
        path, marker = f"{out}/records/level={name}", f"{out}/done/{name}"
        if not is_marked(spark, marker):
            recs, failed = make()
            write_records(union_records(recs, failed) if failed is not None else recs, path, mode="overwrite")
            mark(spark, marker)
        return read_records(spark, path)

    def child_keys(recs: DataFrame) -> DataFrame:
        return recs.filter((F.col("route") != C.ROUTE_FAILURE) & (F.col("emit_seq") == C.EMIT_ITEM)).select(
            F.col("attributes")[C.ATTR_CACHE_KEY].alias("key"))

    def work_under(parents: DataFrame) -> DataFrame:
        return base.unionByName(seed_work(child_keys(parents), base))

    def of_users():
        recs, _ = sync_users(pages, base, input_attrs=input_attrs, dedupe=dedupe)
        return recs, None

    def of_folders():
        recs, _, failed = sync_folders(pages, work_under(users), input_attrs=input_attrs, dedupe=dedupe)
        return recs, failed

    def of_messages():
        recs, _, failed = sync_messages(pages, work_under(folders), input_attrs=input_attrs, dedupe=dedupe)
        return recs, failed

    users = level("users", of_users)
    folders = level("folders", of_folders)
    messages = level("messages", of_messages)
    level("attachments", lambda: (expand_attachments(messages.filter(F.col("route") != C.ROUTE_FAILURE), pages, dedupe=dedupe), None))

    stored = read_records(spark, f"{out}/records")
    records = stored.filter(F.col("route") != C.ROUTE_FAILURE)
    failures = stored.filter(F.col("route") == C.ROUTE_FAILURE)
    tokens = records.filter(F.col("emit_seq") == C.EMIT_TOKEN).select(
        F.col("attributes")[C.ATTR_DELTA_KEY].alias("key"), F.col("attributes")[C.ATTR_DELTA].alias("delta"))
    return records, tokens, failures


def sync_folders_from_records(pages: DataFrame, inputs: DataFrame,
                              delta_attr: str = C.ATTR_DELTA) -> tuple[DataFrame, DataFrame, DataFrame]:
    """S3 (delta variant): every input record names a user and (in ``delta_attr``) a token.

    F2: a record without a user id goes to ``Failure`` unchanged; one whose chain has an unreadable page
    goes there with its attributes and the error's (R2). Folder records inherit the
    input attributes plus the folder id; the token goes to ``Delta`` on every run carrying only the
    user id (T3). Returns ``(records, delta_records, failures)``.
    """
    ok = F.col("attributes")[C.ATTR_USER_ID].isNotNull()
    failed = inputs.filter(~ok).select(F.lit(C.ROUTE_FAILURE).alias("route"), "attributes", "content",
                                       "emit_seq")
    work = work_from(inputs.filter(ok).select(
        F.col("attributes")[C.ATTR_USER_ID].alias("user_id"),
        F.col("attributes")[delta_attr].alias("delta"),
        F.col("attributes").alias("input_attrs"), F.col("content").alias("input_content")))
    chain = ["user_id", "request_token"]
    found = select_chains(pages, "folders", work, chain)
    failed = union_records(failed, _chain_failures(found.unread(), "folder"))
    items = flatten_pages(found.records_of(), chain + ["page_no", "input_attrs"])
    a = inherit(F.col("input_attrs"), attrs_of({C.ATTR_FOLDER_ID: item_field("id")}))
    records = items.select(*record(C.ROUTE_SUCCESS, a, F.col("item"), C.EMIT_ITEM))
    delta = (found.tokens().filter(F.col("new_delta").isNotNull())
             .select(*record(C.ROUTE_DELTA, attrs_of({C.ATTR_USER_ID: F.col("user_id")}), F.col("new_delta"),
                             C.EMIT_TOKEN)))
    return records, delta, failed


def sync_users_from_records(pages: DataFrame, inputs: DataFrame,
                            delta_attr: str = C.ATTR_DELTA) -> tuple[DataFrame, DataFrame, DataFrame]:
    """S2 (delta variant): every input record asks for the users from the token in ``delta_attr``.

    User records inherit the input attributes plus the user id; a changed token goes to ``Delta``
    inheriting all input attributes; each input also goes to ``Original`` (R4), or unchanged to
    ``Failure`` if its chain has an unreadable page. Returns ``(records, delta_records, inputs)``.
    """
    work = work_from(inputs.select(F.col("attributes")[delta_attr].alias("delta"),
                                   F.col("attributes").alias("input_attrs"), "content", "emit_seq"))
    found = select_chains(pages, "users", work, ["request_token"])
    items = flatten_pages(found.records_of(), ["request_token", "page_no", "input_attrs"])
    a = inherit(F.col("input_attrs"), attrs_of({C.ATTR_USER_ID: item_field("id")}))
    records = items.select(*record(C.ROUTE_SUCCESS, a, F.col("item"), C.EMIT_ITEM))
    delta = (found.tokens().filter(token_changed(F.col("delta"), F.col("new_delta")))
             .select(*record(C.ROUTE_DELTA, F.col("input_attrs"), F.col("new_delta"), C.EMIT_TOKEN)))
    unread = found.unread().select("request_token").distinct()
    routed = work.join(unread.withColumn("unread", F.lit(True)), on="request_token", how="left").select(
        F.when(F.col("unread"), C.ROUTE_FAILURE).otherwise(C.ROUTE_ORIGINAL).alias("route"),
        F.col("input_attrs").alias("attributes"), "content", "emit_seq")
    return records, delta, routed
