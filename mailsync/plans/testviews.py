"""Views over the driver's test tables that stand in for a mail tenant, and the landed pages
the API would have returned for them.

| view        | from                                        |
| users       | customer                                    |
| folders     | orders grouped by (o_custkey, o_orderstatus) |
| messages    | orders                                      |
| attachments | lineitem joined with part                   |
| changes     | events (a delta feed; tombstones where k % 10 = 0) |
| checkpoints | events before 2024-01-15, plus folder keys and one users key |
| bodies      | conversations                               |

Everything here is Spark over the given tables, so the work grows with them. Landing (packing
items into API pages) is what a real deployment receives from the API; here Spark derives it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailsync import constants as C
from mailsync import schemas as S
from mailsync.functions.keys import folders_key, messages_key, users_key
from mailsync.operators.joins import sized
from mailsync.plans.testpaging import crowded, pack_chained, pack_pages
from mailsync.session import written
from mailsync.sources.pages import read_pages, write_pages

# Cut-off of the previous sync in the changes feed (fixed test parameter).
TOKEN_CUTOFF = "2024-01-15 00:00:00"
# Server default page size for users, folders and attachments in these fixtures.
DEFAULT_PAGE_SIZE = 100


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _json(*cols: Column) -> Column:
    return F.to_json(F.struct(*cols), S.JSON_TS_OPTIONS)


# ---- entity views ---------------------------------------------------------------------------------

def users(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("custkey"),
                    F.col("c_custkey").cast("string").alias("id"),
                    F.col("c_name").alias("displayName"),
                    F.col("c_mktsegment").alias("jobTitle"),
                    F.col("c_nationkey").cast("string").alias("officeLocation"))


def folders(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return (o.groupBy("o_custkey", "o_orderstatus")
            .agg(F.count(F.lit(1)).cast("int").alias("totalItemCount"),
                 F.count_if(F.col("o_orderpriority") == "1-URGENT").cast("int").alias("unreadItemCount"),
                 F.max("o_orderkey").alias("max_orderkey"))
            .select(F.col("o_custkey").cast("string").alias("user_id"),
                    F.col("o_orderstatus").alias("id"),
                    F.col("o_orderstatus").alias("displayName"),
                    F.lit(0).alias("childFolderCount"),
                    "totalItemCount", "unreadItemCount", "max_orderkey"))


def importance_of(priority: Column) -> Column:
    """1, 2 -> high; 3, 4 -> normal; 5 -> low (by the leading digit of the order priority)."""
    d = F.substring(priority, 1, 1)
    return (F.when(d.isin("1", "2"), F.lit("high")).when(d.isin("3", "4"), F.lit("normal"))
            .when(d == "5", F.lit("low")))


def messages(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("orderkey"),
                    F.col("o_custkey").cast("string").alias("user_id"),
                    F.col("o_orderkey").cast("string").alias("id"),
                    F.col("o_orderstatus").alias("parentFolderId"),
                    F.col("o_orderdate").alias("receivedDateTime"),
                    importance_of(F.col("o_orderpriority")).alias("importance"),
                    F.col("o_orderpriority").alias("subject"))


def attachments(spark, sf_dir) -> DataFrame:
    """A bag: ``(l_orderkey, l_linenumber)`` is not unique in the test data."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    return (li.join(p, li.l_partkey == p.p_partkey, "inner")
            .select(F.col("l_orderkey").cast("string").alias("message_id"),
                    F.col("l_linenumber").alias("seq"),
                    F.concat_ws("-", F.col("l_orderkey").cast("string"),
                                F.col("l_linenumber").cast("string")).alias("id"),
                    F.col("p_name").alias("name"),
                    F.col("p_type").alias("contentType"),
                    F.col("l_quantity").cast("int").alias("size")))


def changes(spark, sf_dir) -> DataFrame:
    """The messages delta feed: one change per event, a tombstone where ``k % 10 = 0``."""
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    return e.select(F.col("user_id").cast("string").alias("user_id"),
                    F.col("event_type").alias("folder_id"),
                    F.col("event_id"),
                    F.concat(F.lit("c"), F.col("event_id").cast("string")).alias("id"),  # never an order key
                    F.col("ts"),
                    F.col("props").alias("subject"),
                    F.coalesce(k % 10 == 0, F.lit(False)).alias("removed"))


def checkpoints(spark, sf_dir) -> DataFrame:
    """The checkpoint map before this sync.

    * ``O365_messages|user|type -> max(event_id)`` over events before the cut-off;
    * ``O365_folders|user -> ''`` for the users seen in events (the others are new work, J4);
    * ``O365_users_delta -> max(user_id in events)``.
    """
    e = table(spark, sf_dir, "events")
    msg = (e.filter(F.col("ts") < F.lit(TOKEN_CUTOFF).cast("timestamp_ntz"))
           .groupBy("user_id", "event_type").agg(F.max("event_id").alias("tok"))
           .select(messages_key(F.col("user_id").cast("string"), F.col("event_type")).alias("key"),
                   F.col("tok").cast("string").alias("delta")))
    fold = (e.select("user_id").distinct()
            .select(folders_key(F.col("user_id").cast("string")).alias("key"), F.lit("").alias("delta")))
    usr = e.agg(F.max("user_id").alias("m")).select(users_key().alias("key"),
                                                    F.col("m").cast("string").alias("delta"))
    return (msg.unionByName(fold).unionByName(usr)
            .select("key", "delta", F.lit(1).cast("bigint").alias("version")))


def mail_records(spark, sf_dir) -> DataFrame:
    """Records to mail: one per conversation turn, addressed to the customer team with the same
    number (teams = customers grouped by ``c_custkey div 10``, so every list is bounded)."""
    conv = table(spark, sf_dir, "conversations")
    teams = recipient_lists(spark, sf_dir)
    j = conv.join(teams, conv.conv_id == teams.team, "left")
    mailbox = F.when(F.col("role") == "user", F.lit("ME")).otherwise(
        F.concat(F.lit("agent-"), F.col("conv_id").cast("string")))
    a = F.create_map(
        F.lit("conv_id"), F.col("conv_id").cast("string"),
        F.lit("turn"), F.col("turn").cast("string"),
        F.lit("role"), F.col("role"),
        F.lit("mailbox"), mailbox,
        F.lit("to"), F.col("csv"),
        F.lit("note"), F.when(F.col("role") == "system", F.lit(" ")).when(F.col("turn") == 0, F.lit(""))
        .otherwise(F.lit(None)),
        F.lit("btype"), F.when(F.col("role") == "user", F.lit("text"))
        .when(F.col("role") == "assistant", F.lit("Html")).otherwise(F.lit("markdown")),
        F.lit("prio"), F.when(F.col("turn") == 0, F.lit("high")).when(F.col("turn") <= 3, F.lit("Normal"))
        .otherwise(F.lit("LOW")),
        F.lit("save"), F.when(F.col("role") == "user", F.lit("TRUE"))
        .when(F.col("role") == "assistant", F.lit("yes")).otherwise(F.lit(None)),
    )
    return j.select(F.lit(C.ROUTE_SUCCESS).alias("route"),
                    F.map_filter(a, lambda k, v: v.isNotNull()).alias("attributes"),
                    F.col("text").alias("content"), F.lit(C.EMIT_ITEM).cast("bigint").alias("emit_seq"))


def recipient_lists(spark, sf_dir) -> DataFrame:
    """Comma-separated, sorted address lists per team of at most 10 customers."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    addr = F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@"), F.lower(F.col("n_name")),
                    F.lit(".example"))
    j = c.join(n, c.c_nationkey == n.n_nationkey, "inner").select(
        F.floor(F.col("c_custkey") / 10).cast("bigint").alias("team"), addr.alias("addr"))
    return j.groupBy("team").agg(F.array_join(F.array_sort(F.collect_list("addr")), ",").alias("csv"))


# ---- landing: the pages the API answers with -----------------------------------------------------

def land_changes(spark, sf_dir, ckpt: DataFrame | None = None, fetched_at: Column | None = None,
                 page_size: int = C.MESSAGE_PAGE_SIZE) -> DataFrame:
    """Message delta chains per folder, asked with the folder's checkpoint token ('' if none).

    The chain holds the changes after the token, ten per page, in event order; its last page
    carries the new delta link (the folder's highest event id).
    """
    ch = changes(spark, sf_dir)
    ck = ckpt if ckpt is not None else checkpoints(spark, sf_dir)
    tok = (ck.filter(F.col("key").startswith(C.KEY_MESSAGES_PREFIX + C.KEY_SEP))
           .select(F.try_element_at(F.split("key", r"[|]"), F.lit(2)).alias("user_id"),
                   F.try_element_at(F.split("key", r"[|]"), F.lit(3)).alias("folder_id"),
                   F.col("delta").alias("request_token")))
    fold = ch.groupBy("user_id", "folder_id").agg(F.max("event_id").alias("last_id"))
    chains = (fold.join(tok, on=["user_id", "folder_id"], how="left")
              .select("user_id", "folder_id", F.coalesce("request_token", F.lit("")).alias("request_token"),
                      F.col("last_id").cast("string").alias("delta_link")))
    keys = ["user_id", "folder_id", "request_token"]
    after = (ch.join(chains.select(*keys), on=["user_id", "folder_id"], how="inner")
             .filter((F.col("request_token") == "")
                     | (F.col("event_id") > F.col("request_token").cast("bigint"))))
    item = F.when(F.col("removed"), _json(F.col("id"), F.struct(F.lit("deleted").alias("reason")).alias(C.REMOVED))) \
        .otherwise(_json(F.col("id"), F.col("ts").alias("receivedDateTime"), F.col("subject"),
                         F.col("folder_id").alias("parentFolderId")))
    items = after.select(*keys, "event_id", item.alias("item"))
    return pack_pages(items, chains, keys, ["event_id"], page_size, "messages", fetched_at)


def land_chained_changes(spark, sf_dir) -> DataFrame:
    """The changes feed as two chains per folder with a checkpoint token: the full load up to the
    token, then the chain asked with it; folders without a token have their full load only."""
    ch = changes(spark, sf_dir)
    tok = (checkpoints(spark, sf_dir).filter(F.col("key").startswith(C.KEY_MESSAGES_PREFIX + C.KEY_SEP))
           .select(F.try_element_at(F.split("key", r"[|]"), F.lit(2)).alias("user_id"),
                   F.try_element_at(F.split("key", r"[|]"), F.lit(3)).alias("folder_id"), F.col("delta").alias("tok")))
    keys = ["user_id", "folder_id", "request_token"]
    chains = tok.select("user_id", "folder_id", F.lit("").alias("request_token"), F.col("tok").alias("delta_link"))
    items = (ch.join(tok, ["user_id", "folder_id"]).filter(F.col("event_id") <= F.col("tok").cast("bigint"))
             .select("user_id", "folder_id", F.lit("").alias("request_token"), "event_id",
                     _json(F.col("id"), F.col("ts").alias("receivedDateTime"), F.col("subject")).alias("item")))
    first = pack_pages(items, chains, keys, ["event_id"], C.MESSAGE_PAGE_SIZE, "messages")
    return first.unionByName(land_changes(spark, sf_dir))


def land_users(spark, sf_dir, ckpt: DataFrame | None = None) -> DataFrame:
    """Two users chains: the full load ('' token) and the delta from the checkpoint's users token
    (users with a higher key). A chain's new delta link is the highest user key it returned, or
    the token it was asked with when it returned nothing."""
    u = users(spark, sf_dir)
    ck = ckpt if ckpt is not None else checkpoints(spark, sf_dir)
    utok = ck.filter(F.col("key") == C.KEY_USERS).select(F.col("delta").alias("request_token"))
    tok = utok.select(F.max("request_token")).scalar()  # at most one users key: a scalar subquery
    item = _json(F.col("id"), F.col("displayName"), F.col("jobTitle"), F.col("officeLocation"))
    full_items = u.select(F.lit("").alias("request_token"), "custkey", item.alias("item"))
    delta_items = (u.filter(F.col("custkey") > tok.cast("bigint"))
                   .select(tok.alias("request_token"), "custkey", item.alias("item")))
    items = full_items.unionByName(delta_items)
    asked = spark.range(1).select(F.lit("").alias("request_token")).unionByName(utok)
    last = items.groupBy("request_token").agg(F.max("custkey").cast("string").alias("_max"))
    chains = asked.join(last, on="request_token", how="left").select(
        "request_token", F.coalesce("_max", "request_token").alias("delta_link"))
    return pack_pages(items, chains, ["request_token"], ["custkey"], DEFAULT_PAGE_SIZE, "users")


def land_folders(spark, sf_dir) -> DataFrame:
    """One full-load folders chain per user; the delta link is the user's highest order key."""
    f = folders(spark, sf_dir)
    u = users(spark, sf_dir)
    lastf = f.groupBy("user_id").agg(F.max("max_orderkey").cast("string").alias("delta_link"))
    chains = (u.select(F.col("id").alias("user_id")).join(lastf, on="user_id", how="left")
              .select("user_id", F.lit("").alias("request_token"), "delta_link"))
    item = _json(F.col("id"), F.col("displayName"), F.col("childFolderCount"), F.col("totalItemCount"),
                 F.col("unreadItemCount"))
    items = f.select("user_id", F.lit("").alias("request_token"), "id", item.alias("item"))
    return pack_pages(items, chains, ["user_id", "request_token"], ["id"], DEFAULT_PAGE_SIZE, "folders")


def land_messages(spark, sf_dir) -> DataFrame:
    """All messages of each user over all folders, ten per page (no folder, no token)."""
    m = messages(spark, sf_dir)
    chains = m.groupBy("user_id").agg(F.max("orderkey").cast("string").alias("delta_link")) \
        .select("user_id", F.lit("").alias("request_token"), "delta_link")
    item = _json(F.col("id"), F.col("receivedDateTime"), F.col("subject"), F.col("importance"),
                 F.col("parentFolderId"))
    items = m.select("user_id", F.lit("").alias("request_token"), "orderkey", item.alias("item"))
    return pack_pages(items, chains, ["user_id", "request_token"], ["orderkey"], C.MESSAGE_PAGE_SIZE,
                      "messages")


def land_folder_messages(spark, sf_dir) -> DataFrame:
    """Message delta chains per (user, folder) asked as full loads, ten per page; the delta link
    is the folder's highest message key."""
    m = messages(spark, sf_dir)
    keys = ["user_id", "folder_id", "request_token"]
    chains = (m.groupBy("user_id", F.col("parentFolderId").alias("folder_id"))
              .agg(F.max("orderkey").cast("string").alias("delta_link"))
              .select("user_id", "folder_id", F.lit("").alias("request_token"), "delta_link"))
    item = _json(F.col("id"), F.col("receivedDateTime"), F.col("subject"), F.col("importance"),
                 F.col("parentFolderId"))
    items = m.select("user_id", F.col("parentFolderId").alias("folder_id"), F.lit("").alias("request_token"),
                     "orderkey", item.alias("item"))
    return pack_pages(items, chains, keys, ["orderkey"], C.MESSAGE_PAGE_SIZE, "messages")


def land_attachments(spark, sf_dir, page_size: int = DEFAULT_PAGE_SIZE) -> DataFrame:
    """The attachments chain of every message (asked for every message, with or without any).

    Lines move twice, as narrow rows: to their part, and with its name and type to their message, where their
    items are made, gathered and cut. Messages with more lines than one group may hold go the general way."""
    keys, order = ["user_id", "message_id", "request_token"], ["seq", "name"]
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    o = table(spark, sf_dir, "orders").groupBy("o_orderkey", "o_custkey").agg(F.count(F.lit(1)).cast("int").alias("asks"))
    large = written(crowded(li, ["l_orderkey"]).filter("l_orderkey is not null").withColumnRenamed("l_orderkey", "o_orderkey"), "crowded")
    all_small = large.isEmpty()
    small = o if all_small else o.join(sized(large), on="o_orderkey", how="left_anti")
    line = F.struct(F.col("l_linenumber").alias("seq"), F.col("p_name").alias("name"), _json(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("id"), F.col("p_name").alias("name"),
        F.col("p_type").alias("contentType"), F.col("l_quantity").cast("int").alias("size")).alias("item"))
    lines = li.join(p, li.l_partkey == p.p_partkey, "inner").drop("l_partkey", "p_partkey")
    gathered = (small.join(lines, small.o_orderkey == lines.l_orderkey, "left").groupBy("o_orderkey", "o_custkey", "asks")
                .agg(F.collect_list(F.when(F.col("l_orderkey").isNotNull(), line)).alias("_lines")))
    # a message that is there several times is asked several times, and its lines come with each
    chained = gathered.select(F.col("o_custkey").cast("string").alias("user_id"), F.col("o_orderkey").cast("string").alias("message_id"),
                              F.lit("").alias("request_token"), F.flatten(F.array_repeat("_lines", F.col("asks"))).alias("items"),
                              F.array_repeat(F.struct(F.lit(None).cast("string").alias("delta_link")), F.col("asks")).alias("links"))
    pages = pack_chained(chained, keys, page_size, "attachments")
    if all_small:
        return pages
    m = (messages(spark, sf_dir).join(sized(large), F.col("orderkey") == F.col("o_orderkey"), "left_semi")
         .select("user_id", F.col("id").alias("message_id"), F.lit("").alias("request_token")))
    items = attachments(spark, sf_dir).join(m, on="message_id", how="inner").select(*keys, *order, _json(
        F.col("id"), F.col("name"), F.col("contentType"), F.col("size")).alias("item"))
    return pages.unionByName(pack_pages(items, m.withColumn("delta_link", F.lit(None).cast("string")), keys, order, page_size, "attachments"))


LANDERS = {
    "users": lambda spark, d: land_users(spark, d),
    "folders": lambda spark, d: land_folders(spark, d),
    "messages": lambda spark, d: land_messages(spark, d),
    "changes": lambda spark, d: land_changes(spark, d),
    "folder_messages": lambda spark, d: land_folder_messages(spark, d),
    "attachments": lambda spark, d: land_attachments(spark, d),
}
OTHER_LANDERS = {"attachments_by_one": lambda spark, d: land_attachments(spark, d, page_size=1)}  # not part of the tenant
_LANDED: dict[tuple, str] = {}


def landed(spark, sf_dir, part: str) -> DataFrame:
    """One landed feed, written once per session to the shared checkpoint folder (a written table
    cuts the lineage), then read back by every query that needs it."""
    from mailsync.session import ensure_checkpoint_dir, scratch_path
    key = (ensure_checkpoint_dir(spark), sf_dir.rstrip("/"), part)
    path = _LANDED.get(key)
    if path is None:
        path = scratch_path(spark, f"landing-{part}")
        write_pages({**LANDERS, **OTHER_LANDERS}[part](spark, sf_dir), path)
        _LANDED[key] = path
    return read_pages(spark, path).select(*S.ENVELOPE_DDL_COLS)


def landed_all(spark, sf_dir) -> DataFrame:
    out = None
    for part in LANDERS:
        df = landed(spark, sf_dir, part)
        out = df if out is None else out.unionByName(df)
    return out


def land_all(spark, sf_dir) -> DataFrame:
    """Every landed page of the tenant, as one envelope table."""
    return (land_users(spark, sf_dir).unionByName(land_folders(spark, sf_dir))
            .unionByName(land_messages(spark, sf_dir)).unionByName(land_changes(spark, sf_dir))
            .unionByName(land_folder_messages(spark, sf_dir))
            .unionByName(land_attachments(spark, sf_dir)))


def request_records(spark, sf_dir) -> DataFrame:
    """Records to turn into API requests: one per event; the content is the event's props.

    Per event type: view -> GET; click -> post with blank data (falls back to the content);
    purchase -> PUT with nested function options; signup -> patch with an array body;
    error -> HEAD (not an allowed method).
    """
    e = table(spark, sf_dir, "events")
    t = F.col("event_type")
    method = (F.when(t == "view", F.lit("GET")).when(t == "click", F.lit("post"))
              .when(t == "purchase", F.lit("PUT")).when(t == "signup", F.lit("patch"))
              .otherwise(F.lit("HEAD")))
    data = (F.when(t == "click", F.lit("")).when(t == "purchase", F.col("props"))
            .when(t == "signup", F.lit("[1, 2]")))
    fopts = F.when(t == "purchase", F.lit('{"a": {"b": 1}}')).when(
        t == "click", F.concat(F.lit('{"n": '), F.get_json_object("props", "$.k"), F.lit("}")))
    a = F.create_map(F.lit("eid"), F.col("event_id").cast("string"),
                     F.lit("uid"), F.col("user_id").cast("string"),
                     F.lit("etype"), t,
                     F.lit("k"), F.get_json_object("props", "$.k"),
                     F.lit("method"), method,
                     F.lit("data"), data,
                     F.lit("fopts"), fopts)
    return e.select(F.lit(C.ROUTE_SUCCESS).alias("route"),
                    F.map_filter(a, lambda k, v: v.isNotNull()).alias("attributes"),
                    F.col("props").alias("content"), F.lit(C.EMIT_ITEM).cast("bigint").alias("emit_seq"))


def generic_responses(spark, sf_dir) -> DataFrame:
    """Landed answers of generic GET calls, one JSON object per page of the ``pages`` table."""
    p = table(spark, sf_dir, "pages")
    body = F.to_json(F.struct(F.col("page_id").alias("id"), F.col("url").alias("webUrl"),
                              F.col("html").alias("content")))
    return p.select(F.col("page_id").alias("request_id"), body.alias("content"))
