"""One query per operator of the inventory, each over the driver's tables at ``sf_dir``.

Every query derives its input from the test tables with Spark (views and landed pages in
``testviews``), runs the operator, and projects flat, named columns so that it can be compared
with the DuckDB oracle of the same name (``oracles.py``), which reads the base tables directly.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailsync import constants as C
from mailsync import schemas as S
from mailsync.functions import checks as K
from mailsync.functions import fields as P
from mailsync.functions import keys as KY
from mailsync.operators import dedupe as D
from mailsync.operators import outbox as O
from mailsync.operators import routes as R
from mailsync.operators import state as ST
from mailsync.operators.tree import expand_children
from mailsync.plans import sync as SY
from mailsync.plans import testviews as TV
from mailsync.sources import checkpoints as CK
from mailsync.sources import pages as PS
from mailsync.sources import scans as SC
from mailsync.sources import sink as SK

MSG_ITEM_DDL = "id STRING, receivedDateTime TIMESTAMP_NTZ, subject STRING, `@removed` STRUCT<reason: STRING>"


def record_view(records: DataFrame) -> DataFrame:
    """Records as flat columns (the attributes every sync sets)."""
    a = F.col("attributes")
    return records.select(
        "route", "emit_seq",
        a[C.ATTR_USER_ID].alias("user_id"), a[C.ATTR_FOLDER_ID].alias("folder_id"),
        a[C.ATTR_MESSAGE_ID].alias("message_id"), a[C.ATTR_CACHE_KEY].alias("cache_key"),
        a[C.ATTR_DELTA_KEY].alias("delta_key"), a[C.ATTR_DELTA].alias("delta"))


def message_view(records: DataFrame) -> DataFrame:
    """Message records with the typed fields of their content."""
    a = F.col("attributes")
    m = F.from_json("content", MSG_ITEM_DDL, {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})
    return (records.filter(F.col("emit_seq") == C.EMIT_ITEM)
            .select(a[C.ATTR_USER_ID].alias("user_id"), a[C.ATTR_FOLDER_ID].alias("folder_id"),
                    a[C.ATTR_MESSAGE_ID].alias("message_id"), m.alias("m"))
            .select("user_id", "folder_id", "message_id",
                    F.col("m").getField(C.REMOVED).isNotNull().alias("removed"),
                    F.col("m.subject").alias("subject"),
                    F.col("m.receivedDateTime").alias("received_at")))


# ---- the changes feed: the messages delta sync -----------------------------------------------------

def _changes_work(spark, d) -> DataFrame:
    """Checkpoint map plus new work (J4) for every folder seen in the feed."""
    ck = TV.checkpoints(spark, d)
    folder_keys = TV.changes(spark, d).select(KY.messages_key("user_id", "folder_id").alias("key"))
    return ck.select("key", "delta").unionByName(ST.seed_work(folder_keys, ck))


def _messages_sync(spark, d, pages=None):
    pages = pages if pages is not None else TV.landed(spark, d, "changes")
    return SY.sync_messages(pages, _changes_work(spark, d))


def q_messages_delta(spark, d):
    recs, _, _ = _messages_sync(spark, d)
    return message_view(recs)


def q_flatten_pages(spark, d):
    items = PS.flatten_pages(TV.landed(spark, d, "changes").filter(F.col("resource") == "messages"))
    return items.select("user_id", "folder_id", "request_token", "page_no", "item_pos",
                        PS.item_field("id").alias("message_id"))


def q_assign_pages(spark, d):
    p = PS.with_links(TV.landed(spark, d, "changes"))
    return p.select("user_id", "folder_id", "request_token", "page_no",
                    F.size(PS.parse_body().getField("value")).alias("n_items"),
                    "next_link", "delta_link")


def _tokens(spark, d):
    _, toks, _ = _messages_sync(spark, d)
    return toks


def q_last_token(spark, d):
    return _tokens(spark, d).select("key", F.col("delta").alias("old_delta"), "new_delta")


def q_token_changed(spark, d):
    t = _tokens(spark, d)
    return t.select("key", F.col("delta").alias("old_delta"), "new_delta",
                    K.token_changed(F.col("delta"), F.col("new_delta")).alias("changed"))


def q_token_records(spark, d):
    recs, _, _ = _messages_sync(spark, d)
    return (recs.filter(F.col("emit_seq") == C.EMIT_TOKEN)
            .select("route", F.col("attributes")[C.ATTR_DELTA_KEY].alias("delta_key"),
                    F.col("attributes")[C.ATTR_DELTA].alias("delta"), "content"))


def q_success_union(spark, d):
    recs, _, _ = _messages_sync(spark, d)
    return record_view(recs)


def q_upsert_checkpoints(spark, d):
    ck = TV.checkpoints(spark, d)
    _, toks, _ = _messages_sync(spark, d)
    return ST.upsert_checkpoints(ck, SY.new_tokens(toks), 2)


def q_dedupe_replay(spark, d):
    once = TV.landed(spark, d, "changes")
    again = once.withColumn("fetched_at", F.col("fetched_at") + F.expr("INTERVAL 5 MINUTES"))
    recs, _, _ = _messages_sync(spark, d, once.unionByName(again))
    return record_view(D.dedupe_replay(recs))


# ---- record-driven delta (3.2): inputs are the checkpoint rows as records ------------------------------

def _delta_inputs(spark, d) -> DataFrame:
    """One input record per checkpoint row: message keys name a user, a folder and a token;
    folder keys name a user only; the users key names neither."""
    ck = TV.checkpoints(spark, d)
    pk = KY.parse_key(F.col("key"), want_folder=True)
    is_msg = F.col("key").startswith(C.KEY_MESSAGES_PREFIX + C.KEY_SEP)
    a = P.attrs_of({C.ATTR_USER_ID: pk["user"], C.ATTR_FOLDER_ID: F.when(is_msg, pk["folder"]),
                    C.ATTR_DELTA: F.col("delta")})
    return ck.select(F.lit(C.ROUTE_SUCCESS).alias("route"), a.alias("attributes"),
                     F.lit("").alias("content"), F.lit(C.EMIT_ITEM).cast("bigint").alias("emit_seq"))


def _delta_run(spark, d):
    return SY.sync_messages_from_records(TV.landed(spark, d, "changes"), _delta_inputs(spark, d))


def q_delta_route(spark, d):
    _, delta, _ = _delta_run(spark, d)
    return delta.select("route", F.col("attributes")[C.ATTR_USER_ID].alias("user_id"),
                        F.col("attributes")[C.ATTR_FOLDER_ID].alias("folder_id"),
                        F.size("attributes").alias("n_attrs"), F.col("content").alias("delta"))


def q_require_attrs(spark, d):
    inputs = _delta_inputs(spark, d)
    ok, failed = K.require_attrs(inputs, [C.ATTR_USER_ID, C.ATTR_FOLDER_ID])
    out = ok.withColumn("route", F.lit("pass")).unionByName(failed.withColumn("route", F.lit(C.ROUTE_FAILURE)))
    a = F.col("attributes")
    return out.select("route", a[C.ATTR_USER_ID].alias("user_id"), a[C.ATTR_FOLDER_ID].alias("folder_id"),
                      a[C.ATTR_DELTA].alias("delta"), F.size(a).alias("n_attrs"))


def q_route_counts(spark, d):
    recs, delta, failed = _delta_run(spark, d)
    return R.route_counts(R.union_records(recs, delta, failed))


def q_original_route(spark, d):
    inputs = _delta_inputs(spark, d)
    ok, _ = K.require_attrs(inputs, [C.ATTR_USER_ID, C.ATTR_FOLDER_ID])
    a = F.col("attributes")
    return R.passthrough_original(ok).select("route", a[C.ATTR_USER_ID].alias("user_id"),
                                             a[C.ATTR_FOLDER_ID].alias("folder_id"),
                                             a[C.ATTR_DELTA].alias("delta"))


def q_inherit_attrs(spark, d):
    recs, _, _ = _delta_run(spark, d)
    return recs.select(F.col("attributes")[C.ATTR_MESSAGE_ID].alias("message_id"),
                       F.explode("attributes").alias("attr_key", "attr_value"))


def _ckpt_records(spark, d, keep) -> DataFrame:
    """Checkpoint rows as input records (user id parsed from the key when it has one)."""
    ck = TV.checkpoints(spark, d).filter(keep)
    pk = KY.parse_key(F.col("key"), want_folder=False)
    a = P.attrs_of({C.ATTR_USER_ID: pk["user"], C.ATTR_DELTA: F.col("delta")})
    return ck.select(F.lit(C.ROUTE_SUCCESS).alias("route"), a.alias("attributes"),
                     F.lit("").alias("content"), F.lit(C.EMIT_ITEM).cast("bigint").alias("emit_seq"))


def q_folders_delta_records(spark, d):
    inputs = _ckpt_records(spark, d, ~F.col("key").startswith(C.KEY_MESSAGES_PREFIX + C.KEY_SEP))
    recs, delta, failed = SY.sync_folders_from_records(TV.landed(spark, d, "folders"), inputs)
    a = F.col("attributes")
    return R.union_records(recs, delta, failed).select(
        "route", "emit_seq", a[C.ATTR_USER_ID].alias("user_id"), a[C.ATTR_FOLDER_ID].alias("folder_id"),
        F.when(F.col("route") == C.ROUTE_DELTA, F.col("content")).alias("token"), F.size(a).alias("n_attrs"))


def q_users_delta_records(spark, d):
    inputs = _ckpt_records(spark, d, F.col("key") == C.KEY_USERS)
    recs, delta, originals = SY.sync_users_from_records(TV.landed(spark, d, "users"), inputs)
    a = F.col("attributes")
    return R.union_records(recs, delta, originals).select(
        "route", "emit_seq", a[C.ATTR_USER_ID].alias("user_id"),
        F.when(F.col("route") == C.ROUTE_DELTA, F.col("content")).alias("token"), F.size(a).alias("n_attrs"))


def q_delta_failures(spark, d):
    """Inputs of the record-driven message sync whose first page is cut off."""
    pages = TV.landed(spark, d, "changes")
    first = (F.col("page_no") == 0) & (F.col("user_id").cast("bigint") % 3 == 0)
    cut = pages.withColumn("body", F.when(first, F.lit('{"value": [oops')).otherwise(F.col("body")))
    _, _, failed = SY.sync_messages_from_records(cut, _delta_inputs(spark, d))
    a = F.col("attributes")
    return failed.select("route", a[C.ATTR_USER_ID].alias("user_id"), a[C.ATTR_FOLDER_ID].alias("folder_id"),
                         a[C.ATTR_DELTA].alias("delta"), a[C.ATTR_MSG_ERROR].alias("error"), a[C.ATTR_MSG_STACK].alias("error_class"))


def q_cache_original(spark, d):
    """The cache syncs of users and folders give their triggers to ``Original``."""
    trigger = _ckpt_records(spark, d, F.col("key").startswith(C.KEY_FOLDERS_PREFIX))
    users, _ = SY.sync_users(TV.landed(spark, d, "users"), TV.checkpoints(spark, d), trigger=trigger)
    folders, _, _ = SY.sync_folders(TV.landed(spark, d, "folders"), TV.checkpoints(spark, d), trigger=trigger)
    return R.route_counts(users.withColumn("route", F.concat(F.lit("users/"), "route")).unionByName(
        folders.withColumn("route", F.concat(F.lit("folders/"), "route"))))


def q_generic_records(spark, d):
    """S7 as records of their requests."""
    answers = TV.generic_responses(spark, d)
    asked = TV.table(spark, d, "pages").select(F.col("page_id").alias("request_id"), P.attrs_of(
        {"method": F.lit("GET"), "asked_url": F.col("url")}).alias("attributes"))
    r = PS.generic_records(asked, answers)
    return r.select("route", "emit_seq", F.col("attributes")["asked_url"].alias("asked_url"), F.size("attributes").alias("n_attrs"),
                    F.get_json_object("content", "$.id").cast("bigint").alias("page_id"))


# ---- users, folders, messages, attachments ---------------------------------------------------------

def q_users_scan(spark, d):
    return P.select_fields(SC.scan_users(TV.landed(spark, d, "users")), "id,displayName,jobTitle,officeLocation")


def _user_record_view(recs):
    a = F.col("attributes")
    return recs.select("route", "emit_seq", a[C.ATTR_USER_ID].alias("user_id"),
                       a[C.ATTR_CACHE_KEY].alias("cache_key"), a[C.ATTR_DELTA_KEY].alias("delta_key"),
                       a[C.ATTR_DELTA].alias("delta"),
                       F.get_json_object(F.when(F.col("emit_seq") == C.EMIT_ITEM, F.col("content")),
                                         "$.displayName").alias("display_name"))


def q_users_delta(spark, d):
    recs, _ = SY.sync_users(TV.landed(spark, d, "users"), TV.checkpoints(spark, d))
    return _user_record_view(recs)


def q_bootstrap_users(spark, d):
    ck = TV.checkpoints(spark, d).filter(F.col("key") != C.KEY_USERS)
    recs, _ = SY.sync_users(TV.landed(spark, d, "users"), ck)
    return _user_record_view(recs)


def q_folders_delta(spark, d):
    recs, _, _ = SY.sync_folders(TV.landed(spark, d, "folders"), TV.checkpoints(spark, d))
    a = F.col("attributes")
    f = F.from_json(F.when(F.col("emit_seq") == C.EMIT_ITEM, F.col("content")),
                    "totalItemCount INT, unreadItemCount INT")
    return recs.select("route", "emit_seq", a[C.ATTR_USER_ID].alias("user_id"),
                       a[C.ATTR_FOLDER_ID].alias("folder_id"), a[C.ATTR_CACHE_KEY].alias("cache_key"),
                       a[C.ATTR_DELTA_KEY].alias("delta_key"), a[C.ATTR_DELTA].alias("delta"),
                       f["totalItemCount"].alias("total_items"), f["unreadItemCount"].alias("unread_items"))


def _all_users(spark, d):
    """The full users load (bootstrap run) as user records."""
    ck = TV.checkpoints(spark, d).filter(F.col("key") != C.KEY_USERS)
    recs, _ = SY.sync_users(TV.landed(spark, d, "users"), ck)
    return recs.filter(F.col("emit_seq") == C.EMIT_ITEM)


def q_seed_folder_work(spark, d):
    users = _all_users(spark, d).select(F.col("attributes")[C.ATTR_CACHE_KEY].alias("key"))
    return ST.seed_work(users, TV.checkpoints(spark, d))


def _all_folder_records(spark, d):
    ck = TV.checkpoints(spark, d)
    users = _all_users(spark, d).select(F.col("attributes")[C.ATTR_CACHE_KEY].alias("key"))
    work = ck.select("key", "delta").unionByName(ST.seed_work(users, ck))
    recs, _, _ = SY.sync_folders(TV.landed(spark, d, "folders"), work)
    return recs.filter(F.col("emit_seq") == C.EMIT_ITEM)


def q_seed_message_work(spark, d):
    folders = _all_folder_records(spark, d).select(F.col("attributes")[C.ATTR_CACHE_KEY].alias("key"))
    return ST.seed_work(folders, TV.checkpoints(spark, d))


def q_user_folder_tree(spark, d):
    users = _all_users(spark, d).select(
        F.col("attributes")[C.ATTR_USER_ID].alias("user_id"),
        F.get_json_object("content", "$.displayName").alias("display_name"))
    folder_items = PS.parse_items(
        PS.flatten_pages(TV.landed(spark, d, "folders"), ["user_id"]), "id STRING, totalItemCount INT, unreadItemCount INT",
        keep=["user_id"])
    t = expand_children(users, folder_items, ["user_id"])
    return t.select("user_id", "display_name", F.col("id").alias("folder_id"),
                    F.col("totalItemCount").alias("total_items"), F.col("unreadItemCount").alias("unread_items"))


def q_messages_scan(spark, d):
    m = SC.scan_messages(TV.landed(spark, d, "messages"), "id,parentFolderId,receivedDateTime,importance,subject")
    return m.select("user_id", F.col("id").alias("message_id"), F.col("parentFolderId").alias("folder_id"),
                    F.col("receivedDateTime").alias("received_at"), "importance", "subject")


def q_attachments_scan(spark, d):
    a = SC.scan_attachments(TV.landed(spark, d, "attachments"), "name,contentType,size")
    return a.select("user_id", "message_id", "name", F.col("contentType").alias("content_type"), "size")


def _message_records_all(spark, d):
    """Message records of the full (per-user) message scan, with ids as attributes."""
    return SY.scan_message_records(TV.landed(spark, d, "messages"))


def q_message_attachments(spark, d):
    return _attachment_view(SY.expand_attachments(_message_records_all(spark, d), TV.landed(spark, d, "attachments")))


def _attachment_view(att):
    a = F.col("attributes")
    return att.select("route", "emit_seq", a[C.ATTR_USER_ID].alias("user_id"),
                      a[C.ATTR_FOLDER_ID].alias("folder_id"), a[C.ATTR_MESSAGE_ID].alias("message_id"),
                      a[C.ATTR_CONTENT_TYPE].alias("content_type"), a[C.ATTR_MIME_TYPE].alias("mime_type"),
                      a[C.ATTR_ATTACHMENT_FILE_NAME].alias("file_name"))


def q_attachment_attrs(spark, d):
    a = PS.flatten_pages(TV.landed(spark, d, "attachments"), ["message_id"])
    m = P.attachment_attrs(PS.item_field("contentType"), PS.item_field("name"))
    return a.select("message_id", F.explode(m).alias("attr_key", "attr_value"))


def q_select_fields(spark, d):
    """P1 on the typed view of all fields, and on the items' raw JSON with a field no schema knows."""
    pages = TV.landed(spark, d, "messages")
    typed = P.select_fields(SC.scan_messages(pages, None), "id, subject ,importance").withColumn("raw", F.lit(None).cast("string"))
    unknown = F.concat(F.expr("left(item, length(item) - 1)"), F.lit(',"extra":{"a":[1,"x"]}}'))
    items = PS.flatten_pages(pages.filter("folder_id is null"), ["user_id"]).withColumn("item", unknown)
    raw = items.select(PS.item_field("id").alias("id"), F.lit(None).cast("string").alias("subject"),
                       F.lit(None).cast("string").alias("importance"),
                       P.select_json_fields("item", S.MESSAGE_DDL, "extra, id").alias("raw"))
    return typed.unionByName(raw)


# ---- keys and checkpoints ------------------------------------------------------------------------

EDGE_KEYS = ["O365_messages|7", "O365_messages|7|", "O365_folders|"]


def _ckpt_with_edges(spark, d):
    ck = TV.checkpoints(spark, d).select("key", "delta")
    edges = spark.createDataFrame([(k, "") for k in EDGE_KEYS] + [("O365_folders|tab", "\t"), ("O365_folders|line", " \n")],
                                  "key STRING, delta STRING")
    return ck.unionByName(edges)


def q_filter_keys(spark, d):
    ck = _ckpt_with_edges(spark, d)
    a = KY.filter_keys(ck, C.REGEX_MESSAGES_DEFAULT, C.KEY_MESSAGES_PREFIX).withColumn("pattern", F.lit("messages"))
    b = KY.filter_keys(ck, r"O365_folders\|1\d", C.KEY_FOLDERS_PREFIX).withColumn("pattern", F.lit("folders_1x"))
    c = KY.filter_keys(ck, C.REGEX_USERS_DEFAULT, C.KEY_USERS).withColumn("pattern", F.lit("users"))
    return a.unionByName(b).unionByName(c)


def q_parse_keys(spark, d):
    ck = _ckpt_with_edges(spark, d).filter(F.col("key").startswith(C.KEY_MESSAGES_PREFIX)
                                          | F.col("key").startswith(C.KEY_FOLDERS_PREFIX))
    is_msg = F.col("key").startswith(C.KEY_MESSAGES_PREFIX)
    pm = KY.parse_key(F.col("key"), want_folder=True)
    pf = KY.parse_key(F.col("key"), want_folder=False)
    return ck.select("key", pm["user"].alias("user_id"),
                     F.when(is_msg, pm["folder"]).alias("folder_id"),
                     F.when(is_msg, pm["key_ok"]).otherwise(pf["key_ok"]).alias("key_ok"))


def q_format_keys(spark, d):
    f = TV.changes(spark, d).select("user_id", "folder_id").distinct()
    return f.select("user_id", "folder_id", KY.messages_key("user_id", "folder_id").alias("messages_key"),
                    KY.folders_key("user_id").alias("folders_key"), KY.users_key().alias("users_key"))


def q_full_load_flag(spark, d):
    ck = _ckpt_with_edges(spark, d)
    return ck.select("key", "delta", K.is_full_load("delta").alias("full_load"),
                     K.request_token("delta").alias("request_token"))


def q_lookup_token(spark, d):
    keys = TV.changes(spark, d).select(KY.messages_key("user_id", "folder_id").alias("key")).distinct()
    return ST.lookup_token(keys, TV.checkpoints(spark, d))


def q_checkpoint_scan(spark, d):
    from mailsync.session import scratch_path
    root = scratch_path(spark, "ckpt")
    CK.write_checkpoints(TV.checkpoints(spark, d), root, 1)
    _, toks, _ = _messages_sync(spark, d)
    CK.write_delta(SY.new_tokens(toks), root, 2)
    return CK.scan_checkpoints(spark, root)


def _customer_folder_keys(spark, d):
    return TV.users(spark, d).select(KY.folders_key("id").alias("key"))


def q_ckpt_get(spark, d):
    return ST.ckpt_get(TV.checkpoints(spark, d), _customer_folder_keys(spark, d))


def q_ckpt_put(spark, d):
    f = TV.folders(spark, d).groupBy("user_id").agg(F.max("max_orderkey").cast("string").alias("delta"))
    pairs = f.select(KY.folders_key("user_id").alias("key"), "delta")
    tail = TV.users(spark, d).select(KY.messages_key("id", F.lit("inbox")).alias("key"),
                                     F.lit(None).cast("string").alias("delta"))
    return ST.ckpt_put(TV.checkpoints(spark, d), pairs.unionByName(tail), 2)


def q_ckpt_remove(spark, d):
    gone = _customer_folder_keys(spark, d).unionByName(
        TV.users(spark, d).select(KY.users_key().alias("key")))
    return ST.ckpt_remove(TV.checkpoints(spark, d), gone)


def q_ckpt_keys(spark, d):
    return ST.ckpt_keys(TV.checkpoints(spark, d))


# ---- records out -------------------------------------------------------------------------------

def q_write_read_records(spark, d):
    from mailsync.session import scratch_path
    recs, _, _ = _messages_sync(spark, d)
    path = scratch_path(spark, "records")
    SK.write_records(recs, path)
    return record_view(SK.read_records(spark, path))


def q_literal_attrs(spark, d):
    recs, _, _ = _messages_sync(spark, d)
    v = record_view(recs).select("route", "emit_seq", "user_id", "message_id")
    return P.with_literals(v, {"batch": "r1", "source": F.lit("changes")})


def q_render_template(spark, d):
    recs, _, _ = _messages_sync(spark, d)
    t = "/users/${office365_user_id}/mailFolders/${office365_folder_id}/messages/${office365_message_id}?x=${missing}"
    return recs.filter(F.col("emit_seq") == C.EMIT_ITEM).select(
        F.col("attributes")[C.ATTR_MESSAGE_ID].alias("message_id"), P.render(t).alias("url"))


# ---- outgoing mail and requests --------------------------------------------------------------------

MAIL_PARAMS = O.MailParams(subject="Re: conversation ${conv_id}", body="${note}", body_type="${btype}",
                           user_id="${mailbox}", save_to_sent="${save}", to_recipients="${to}",
                           cc_recipients="${cc}", bcc_recipients="", importance="${prio}")


def _mail(spark, d):
    return O.outbox_mail(TV.mail_records(spark, d), MAIL_PARAMS)


def _mail_keys():
    a = F.col("attributes")
    return [a["conv_id"].cast("bigint").alias("conv_id"), a["turn"].cast("bigint").alias("turn"),
            a["role"].alias("role")]


def q_outbox_mail(spark, d):
    m = _mail(spark, d)
    return m.select(*_mail_keys(), F.col("out_route").alias("route"), "sender_path", "subject",
                    "body", "body_type", F.col("mail_importance").alias("importance"), "save_to_sent",
                    F.size("to_recipients").alias("n_to"), F.size("cc_recipients").alias("n_cc"),
                    F.size("bcc_recipients").alias("n_bcc"),
                    F.get(F.col("to_recipients"), 0)["emailAddress"]["address"].alias("first_to"))


def q_mail_enums(spark, d):
    r = TV.mail_records(spark, d)
    a = F.col("attributes")
    e = P.mail_enums(a["btype"], a["prio"], a["save"])
    return r.select(*_mail_keys(), e["body_type"].alias("body_type"), e["importance"].alias("importance"),
                    e["save_to_sent"].alias("save_to_sent"), e["ok"].alias("ok"))


def q_body_fallback(spark, d):
    r = TV.mail_records(spark, d)
    note = P.render("${note}")
    raw = F.col("attributes")["note"]
    return r.select(*_mail_keys(), P.mail_body(raw, F.col("content")).alias("mail_body"),
                    P.request_data(raw, F.col("content")).alias("request_body"),
                    note.alias("rendered_note"))


def q_recipients(spark, d):
    lists = TV.recipient_lists(spark, d).select(F.col("team").cast("string").alias("list_id"), "csv")
    edges = spark.createDataFrame([("edge-null", None), ("edge-empty", ""), ("edge-short", "a,b"),
                                   ("edge-inner", "a@b,,c@d,,"), ("edge-blank", " a@b , c@d"),
                                   ("edge-commas", ",,,,")], "list_id STRING, csv STRING")
    r = lists.unionByName(edges).select("list_id", P.recipients("csv").alias("r"))
    return r.select("list_id", F.posexplode_outer("r").alias("pos", "rcpt")).select(
        "list_id", "pos", F.col("rcpt")["emailAddress"]["address"].alias("address"))


REQUEST_PARAMS = O.RequestParams(
    url="/users/${uid}/events/${eid}", method="${method}", data="${data}",
    select_fields="id,subject", query_options='{"$top": "${k}", "$filter": "${etype}"}',
    headers='{"Prefer": "outlook.body-content-type=text"}', function_options="${fopts}")


def _request_records(spark, d) -> DataFrame:
    return TV.request_records(spark, d)


def q_request_table(spark, d):
    r = O.request_table(_request_records(spark, d), REQUEST_PARAMS)
    a = F.col("attributes")
    return r.select(a["eid"].cast("bigint").alias("event_id"), F.col("out_route").alias("route"), "url",
                    "method", "select_fields", F.size("query_options").alias("n_query_options"),
                    F.col("query_options")["$top"].alias("top"), F.col("query_options")["$filter"].alias("filter"),
                    F.size("headers").alias("n_headers"), F.size("function_options").alias("n_function_options"),
                    "request_body", "error")


def q_valid_requests(spark, d):
    r = _request_records(spark, d)
    a = F.col("attributes")
    return r.select(a["eid"].cast("bigint").alias("event_id"), a["method"].alias("method"),
                    K.valid_request(a["method"], P.render(REQUEST_PARAMS.url),
                                    P.request_data(a["data"], F.col("content"))).alias("ok"))


def q_json_options(spark, d):
    r = _request_records(spark, d)
    o = P.json_options(P.render(REQUEST_PARAMS.query_options))
    return r.select(F.col("attributes")["eid"].cast("bigint").alias("event_id"),
                    F.posexplode(o["options"]).alias("pos", "opt_key", "opt_value"))


def q_valid_json(spark, d):
    ev = TV.table(spark, d, "events").select(F.lit("events").alias("source"), F.col("event_id").alias("id"),
                                             F.col("props").alias("text"))
    cv = TV.table(spark, d, "conversations").select(
        F.lit("conversations").alias("source"), (F.col("conv_id") * 100 + F.col("turn")).alias("id"),
        F.col("text"))
    t = ev.unionByName(cv)
    return t.select("source", "id", K.valid_json("text").alias("ok"))


def q_error_records(spark, d):
    r = O.request_table(_request_records(spark, d), REQUEST_PARAMS)
    failed = r.filter(F.col("out_route") == C.ROUTE_FAILURE)
    e = R.error_records(failed, F.col("error"), F.col("error_class"), keep_attrs=True)
    a = F.col("attributes")
    return e.select("route", a["eid"].cast("bigint").alias("event_id"), a[C.ATTR_ERROR].alias("error"),
                    a[C.ATTR_STACK].alias("error_class"))


def q_generic_scan(spark, d):
    resp = TV.generic_responses(spark, d)
    g = PS.scan_generic(resp)
    v = F.col("response")
    return g.select("request_id", F.variant_get(v, "$.id", "bigint").alias("id"),
                    F.variant_get(v, "$.webUrl", "string").alias("web_url"),
                    F.length(F.variant_get(v, "$.content", "string")).alias("n_chars"))


# ---- the whole cache-driven sync ----------------------------------------------------------------

def q_tenant_sync(spark, d):
    pages = TV.landed_all(spark, d)
    recs, _, _ = SY.sync_tenant(pages, TV.checkpoints(spark, d))
    return record_view(recs)


def q_tenant_tokens(spark, d):
    pages = TV.landed_all(spark, d)
    _, toks, _ = SY.sync_tenant(pages, TV.checkpoints(spark, d))
    return toks


# ---- streaming ---------------------------------------------------------------------------------

def _stream_run(spark, d, *landings, ckpt=None, dedupe=True):
    """Land each frame as files of its own, one file per trigger, and stream them all."""
    from mailsync.session import scratch_path
    from mailsync.streaming import stream as STR
    root = scratch_path(spark, "stream")
    for pages in landings:
        STR.land_files(pages, f"{root}/landing", 3)
    ck = (ckpt if ckpt is not None else _changes_work(spark, d)).select("key", "delta", F.lit(0).cast("bigint").alias("version"))
    STR.sync_stream(spark, f"{root}/landing", f"{root}/state", f"{root}/out", initial_ckpt=ck, dedupe=dedupe,
                    max_files_per_trigger=1)
    return record_view(STR.read_stream_output(spark, f"{root}/out"))


def _later(pages, interval: str):
    return pages.withColumn("fetched_at", F.col("fetched_at") + F.expr(f"INTERVAL {interval}"))


def q_stream_sync(spark, d):
    return _stream_run(spark, d, TV.landed(spark, d, "changes"), dedupe=False)


def q_stream_dedupe(spark, d):
    pages = TV.landed(spark, d, "changes")
    return _stream_run(spark, d, pages, _later(pages, "5 MINUTES"))


def q_stream_late_pages(spark, d):
    """The later pages of every chain land first, the first page days after them."""
    pages = TV.landed(spark, d, "changes")
    return _stream_run(spark, d, _later(pages.filter("page_no > 0"), "3 DAYS"), pages.filter("page_no = 0"))


def q_stream_chained_tokens(spark, d):
    """Two chains per folder, the second asked with the first one's token, land together."""
    ck = _changes_work(spark, d).withColumn("delta", F.lit(""))
    return _stream_run(spark, d, TV.land_chained_changes(spark, d), ckpt=ck)


def q_stream_new_folders(spark, d):
    """Folders that the map does not know are seeded from their landed full loads."""
    return _stream_run(spark, d, TV.landed(spark, d, "changes"), ckpt=TV.checkpoints(spark, d))


# ---- attempts and replays ------------------------------------------------------------------------

def q_mixed_attempts(spark, d):
    """Every chain of several pages has a first attempt without its last page and a rerun without
    its first: neither is complete, so only chains of one page give a token."""
    pages = TV.landed(spark, d, "changes")
    last = pages.groupBy("user_id", "folder_id", "request_token").agg(F.max("page_no").alias("last"))
    both = pages.join(last, ["user_id", "folder_id", "request_token"])
    one = both.filter("page_no < last or last = 0").withColumn("attempt_id", F.lit("a"))
    two = _later(both.filter("page_no > 0").withColumn("attempt_id", F.lit("b")), "1 HOUR")
    toks = SY.sync_messages(one.unionByName(two).drop("last"), _changes_work(spark, d))[1]
    return toks.select("key", F.col("delta").alias("old_delta"), "new_delta")


def q_replay_new_link(spark, d):
    """Every chain is landed again an hour later with another delta link: the later one counts."""
    pages = TV.landed(spark, d, "changes")
    again = _later(pages.withColumn("body", F.regexp_replace("body", r'("@odata.deltaLink":"[^"]*)"', '$1-again"'))
                   .withColumn("attempt_id", F.lit("b")), "1 HOUR")
    toks = SY.sync_messages(pages.unionByName(again), _changes_work(spark, d))[1]
    return toks.select("key", F.col("delta").alias("old_delta"), "new_delta")


def q_attachments_replay(spark, d):
    """Message and attachment pages landed three times, the attachments in attempts of their own."""
    att, msg = TV.landed(spark, d, "attachments"), _message_records_all(spark, d)
    thrice = att
    for n in (1, 2):
        thrice = thrice.unionByName(_later(att.withColumn("attempt_id", F.lit(f"again-{n}")), f"{n} HOURS"))
    return _attachment_view(SY.expand_attachments(msg.unionByName(msg), thrice))


def _recut_changes(spark, d):
    """The changes feed in two complete attempts, the second an hour later in pages of seven instead of ten."""
    one = TV.landed(spark, d, "changes").withColumn("attempt_id", F.lit("a"))
    two = _later(TV.land_changes(spark, d, page_size=7).withColumn("attempt_id", F.lit("b")), "1 HOUR")
    return one.select(*S.ENVELOPE_DDL_COLS).unionByName(two.select(*S.ENVELOPE_DDL_COLS))


def q_messages_recut(spark, d):
    """A rerun whose pages are cut differently: the newer complete attempt counts."""
    return record_view(SY.sync_messages(_recut_changes(spark, d), _changes_work(spark, d))[0])


def q_stream_recut(spark, d):
    """The same on a stream: the first attempt that is complete counts, the rerun is a replay."""
    pages = _recut_changes(spark, d)
    return _stream_run(spark, d, pages.filter("attempt_id = 'a' and page_no = 0"), pages.filter("attempt_id = 'b'"),
                       pages.filter("attempt_id = 'a' and page_no > 0"))


def q_attachments_unfinished_rerun(spark, d):
    """Attachments in pages of one with a complete attempt, and a later rerun of which only the first page landed."""
    one = TV.landed(spark, d, "attachments_by_one").withColumn("attempt_id", F.lit("a"))
    two = _later(one.filter("page_no = 0").withColumn("attempt_id", F.lit("b")), "1 HOUR")
    return _attachment_view(SY.expand_attachments(_message_records_all(spark, d), one.unionByName(two)))


def q_scans_landed_twice(spark, d):
    """The plain scans of users, messages and attachments that were loaded twice, by attempts a day apart."""
    def twice(part):
        pages = TV.landed(spark, d, part).withColumn("attempt_id", F.lit("a"))
        return pages.unionByName(_later(pages.withColumn("attempt_id", F.lit("b")), "1 DAY"))

    users, messages = SC.scan_users(twice("users")), SC.scan_messages(twice("messages"), "id")
    files = SC.scan_attachments(twice("attachments"), "name")
    count = lambda df, name: df.agg(F.lit(name).alias("entity"), F.count(F.lit(1)).alias("n_rows"))
    return count(users, "users").unionByName(count(messages, "messages")).unionByName(count(files, "attachments"))


def q_messages_catch_up(spark, d):
    """Two chains per folder in one landing, the second asked with the first one's token, in one batch run."""
    ck = _changes_work(spark, d).withColumn("delta", F.lit(""))
    return record_view(SY.catch_up_messages(TV.land_chained_changes(spark, d), ck)[0])


def q_pruned_tokens(spark, d):
    """Tokens of the folders of ten users, from a landing whose other buckets are not read."""
    from mailsync.session import scratch_path
    root = scratch_path(spark, "landing-buckets")
    PS.write_pages(TV.landed(spark, d, "changes"), root, buckets=64)
    ten = F.col("key").rlike(r"^O365_messages\|[0-9]\|")
    toks = SY.sync_messages(PS.read_pages(spark, root), _changes_work(spark, d).filter(ten))[1]
    return toks.select("key", F.col("delta").alias("old_delta"), "new_delta")


def q_stream_tenant(spark, d):
    """The whole tenant as streams, the levels' pages landed from the last level to the first."""
    from mailsync.session import scratch_path
    from mailsync.streaming import stream as STR
    root = scratch_path(spark, "stream-tenant")
    parts = ("attachments", "folder_messages", "changes", "messages", "folders", "users")
    with ThreadPoolExecutor(3) as threads:  # one alone leaves most cores idle
        landed = list(threads.map(lambda part: TV.landed(spark, d, part), parts))
    for pages in landed:
        STR.land_files(pages, f"{root}/landing", 2)
    STR.sync_tenant_stream(spark, f"{root}/landing", f"{root}/state", f"{root}/out", initial_ckpt=TV.checkpoints(spark, d))
    return record_view(STR.read_tenant_output(spark, f"{root}/out"))


def q_ckpt_remove_stored(spark, d):
    """Removing keys as a stored delta version."""
    from mailsync.session import scratch_path
    root = scratch_path(spark, "ckpt")
    ck = TV.checkpoints(spark, d)
    CK.write_checkpoints(ck, root, 1)
    gone = _customer_folder_keys(spark, d).unionByName(TV.users(spark, d).select(KY.users_key().alias("key")).distinct())
    CK.write_delta(ck.select("key", "delta").limit(0), root, 2, removed=gone)
    return CK.scan_checkpoints(spark, root)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "messages_delta": q_messages_delta,
    "flatten_pages": q_flatten_pages,
    "assign_pages": q_assign_pages,
    "last_token": q_last_token,
    "token_changed": q_token_changed,
    "token_records": q_token_records,
    "success_union": q_success_union,
    "upsert_checkpoints": q_upsert_checkpoints,
    "dedupe_replay": q_dedupe_replay,
    "delta_route": q_delta_route,
    "require_attrs": q_require_attrs,
    "route_counts": q_route_counts,
    "original_route": q_original_route,
    "inherit_attrs": q_inherit_attrs,
    "folders_delta_records": q_folders_delta_records,
    "users_delta_records": q_users_delta_records,
    "users_scan": q_users_scan,
    "users_delta": q_users_delta,
    "bootstrap_users": q_bootstrap_users,
    "folders_delta": q_folders_delta,
    "seed_folder_work": q_seed_folder_work,
    "seed_message_work": q_seed_message_work,
    "user_folder_tree": q_user_folder_tree,
    "messages_scan": q_messages_scan,
    "attachments_scan": q_attachments_scan,
    "message_attachments": q_message_attachments,
    "attachment_attrs": q_attachment_attrs,
    "select_fields": q_select_fields,
    "filter_keys": q_filter_keys,
    "parse_keys": q_parse_keys,
    "format_keys": q_format_keys,
    "full_load_flag": q_full_load_flag,
    "lookup_token": q_lookup_token,
    "checkpoint_scan": q_checkpoint_scan,
    "ckpt_get": q_ckpt_get,
    "ckpt_put": q_ckpt_put,
    "ckpt_remove": q_ckpt_remove,
    "ckpt_keys": q_ckpt_keys,
    "write_read_records": q_write_read_records,
    "literal_attrs": q_literal_attrs,
    "render_template": q_render_template,
    "outbox_mail": q_outbox_mail,
    "mail_enums": q_mail_enums,
    "body_fallback": q_body_fallback,
    "recipients": q_recipients,
    "request_table": q_request_table,
    "valid_requests": q_valid_requests,
    "json_options": q_json_options,
    "valid_json": q_valid_json,
    "error_records": q_error_records,
    "generic_scan": q_generic_scan,
    "tenant_sync": q_tenant_sync,
    "tenant_tokens": q_tenant_tokens,
    "stream_sync": q_stream_sync,
    "stream_dedupe": q_stream_dedupe,
    "stream_late_pages": q_stream_late_pages,
    "stream_chained_tokens": q_stream_chained_tokens,
    "stream_new_folders": q_stream_new_folders,
    "delta_failures": q_delta_failures,
    "cache_original": q_cache_original,
    "generic_records": q_generic_records,
    "mixed_attempts": q_mixed_attempts,
    "replay_new_link": q_replay_new_link,
    "attachments_replay": q_attachments_replay,
    "ckpt_remove_stored": q_ckpt_remove_stored,
    "messages_recut": q_messages_recut,
    "stream_recut": q_stream_recut,
    "attachments_unfinished_rerun": q_attachments_unfinished_rerun,
    "scans_landed_twice": q_scans_landed_twice,
    "messages_catch_up": q_messages_catch_up,
    "pruned_tokens": q_pruned_tokens,
    "stream_tenant": q_stream_tenant,
}
