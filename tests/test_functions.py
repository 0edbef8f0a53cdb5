"""Edge rows for the column functions (FIXTURES.md, "Edge rows every test must include")."""

import pytest
from pyspark.sql import functions as F

from mailsync import constants as C
from mailsync.functions import checks as K
from mailsync.functions import fields as P
from mailsync.functions import keys as KY


def one(spark, col, value, ddl="v STRING"):
    return spark.createDataFrame([(value,)], ddl).select(col.alias("out")).collect()[0]["out"]


def addresses(spark, csv):
    r = one(spark, P.recipients(F.col("v")), csv)
    return [x["emailAddress"]["address"] for x in r]


@pytest.mark.parametrize("csv,expected", [
    (None, []),
    ("", []),
    ("a,b", []),                       # length 3: empty
    ("a@b,,c@d,,", ["a@b", "", "c@d"]),  # trailing empties dropped, inner kept
    (" a@b , c@d", [" a@b ", " c@d"]),   # no trim
    (",,,,", []),                      # only commas
    ("x@y.z", ["x@y.z"]),
    (",a@b", ["", "a@b"]),             # leading empty kept (Java split)
])
def test_recipients_java_split(spark, csv, expected):
    assert addresses(spark, csv) == expected


@pytest.mark.parametrize("key,want_folder,user,folder,ok", [
    ("O365_messages|7|inbox", True, "7", "inbox", True),
    ("O365_messages|7", True, "7", None, False),
    ("O365_messages|7|", True, "7", "", False),
    ("O365_folders|42", False, "42", None, True),
    ("O365_folders|", False, "", None, False),
])
def test_parse_key(spark, key, want_folder, user, folder, ok):
    pk = KY.parse_key(F.col("v"), want_folder)
    row = spark.createDataFrame([(key,)], "v STRING").select(
        pk["user"].alias("u"), pk["folder"].alias("f"), pk["key_ok"].alias("ok")).collect()[0]
    assert (row.u, row.f if want_folder else None, row.ok) == (user, folder, ok)


def test_filter_keys_full_match(spark):
    ck = spark.createDataFrame([("O365_folders|1", ""), ("O365_folders|10", ""), ("O365_folders|100", ""),
                                ("xO365_folders|1", ""), ("O365_messages|1|a", "t")], "key STRING, delta STRING")
    got = sorted(r.key for r in KY.filter_keys(ck, r"O365_folders\|1\d?", C.KEY_FOLDERS_PREFIX).collect())
    assert got == ["O365_folders|1", "O365_folders|10"]  # 100 matches only in part: not selected


def test_filter_keys_alternation_not_pruned(spark):
    ck = spark.createDataFrame([("O365_folders|1", ""), ("other", "")], "key STRING, delta STRING")
    got = sorted(r.key for r in KY.filter_keys(ck, "O365_folders.*|other", C.KEY_FOLDERS_PREFIX).collect())
    assert got == ["O365_folders|1", "other"]


@pytest.mark.parametrize("pattern", ["O365_messages[", "nothing_here.*"])
def test_filter_keys_bad_pattern(spark, pattern):
    ck = spark.createDataFrame([("O365_messages|1|a", "")], "key STRING, delta STRING")
    with pytest.raises(ValueError):
        KY.filter_keys(ck, pattern, C.KEY_MESSAGES_PREFIX)


@pytest.mark.parametrize("token,full", [(None, True), ("", True), ("  ", True), ("abc", False)])
def test_full_load(spark, token, full):
    assert one(spark, K.is_full_load(F.col("v")), token) is full


@pytest.mark.parametrize("old,new,emit", [("a", "a", False), ("a", "b", True), (None, "b", True),
                                          ("a", None, False), ("", "x", True)])
def test_token_changed(spark, old, new, emit):
    row = spark.createDataFrame([(old, new)], "o STRING, n STRING").select(
        K.token_changed(F.col("o"), F.col("n")).alias("x")).collect()[0]
    assert row.x is emit


def test_render_single_pass(spark):
    df = spark.createDataFrame([({"a": "1", "b": "${a}"},)], "attributes MAP<STRING,STRING>")
    out = df.select(P.render("x=${a};y=${b};z=${missing}").alias("o")).collect()[0].o
    assert out == "x=1;y=${a};z="


def test_inherit_new_wins(spark):
    df = spark.createDataFrame([({"a": "1", "b": "2"}, {"b": "3", "c": "4"})],
                               "p MAP<STRING,STRING>, n MAP<STRING,STRING>")
    out = df.select(P.inherit(F.col("p"), F.col("n")).alias("o")).collect()[0].o
    assert out == {"a": "1", "b": "3", "c": "4"}


@pytest.mark.parametrize("text,ok,opts", [
    (None, True, {}), ("", True, {}),
    ('{"$top": 5, "h": "x"}', True, {"$top": "5", "h": "x"}),
    ('{"a": {"b": 1}}', False, None), ('{"a": null}', False, None),
    ("[1]", False, None), (" ", False, None), ("bad{", False, None),
])
def test_json_options(spark, text, ok, opts):
    o = P.json_options(F.col("v"))
    row = spark.createDataFrame([(text,)], "v STRING").select(o["ok"].alias("ok"), o["options"].alias("m")).collect()[0]
    assert row.ok is ok
    if ok:
        assert (row.m or {}) == opts


@pytest.mark.parametrize("body,content,mail,req", [
    (None, "c", "c", "c"), ("", "c", "c", "c"), (" ", "c", " ", "c"), ("b", "c", "b", "b")])
def test_body_fallback(spark, body, content, mail, req):
    row = spark.createDataFrame([(body, content)], "b STRING, c STRING").select(
        P.mail_body(F.col("b"), F.col("c")).alias("m"), P.request_data(F.col("b"), F.col("c")).alias("r")).collect()[0]
    assert (row.m, row.r) == (mail, req)


@pytest.mark.parametrize("bt,imp,save,ok,saved", [
    ("html", "low", "true", True, True), ("Text", "NORMAL", "TRUE ", True, True),
    ("HTML", "High", "yes", True, False), ("markdown", "low", "true", False, True),
    ("HTML", "urgent", "true", False, True), ("HTML", "low", None, False, None)])
def test_mail_enums(spark, bt, imp, save, ok, saved):
    e = P.mail_enums(F.col("a"), F.col("b"), F.col("c"))
    row = spark.createDataFrame([(bt, imp, save)], "a STRING, b STRING, c STRING").select(
        e["ok"].alias("ok"), e["save_to_sent"].alias("s")).collect()[0]
    assert (row.ok, row.s) == (ok, saved)


@pytest.mark.parametrize("user,path", [("me", "/me"), ("ME", "/me"), ("bob", "/users/bob")])
def test_mailbox_path(spark, user, path):
    assert one(spark, P.mailbox_path(F.col("v")), user) == path


@pytest.mark.parametrize("method,url,body,ok", [
    ("get", "/me", None, True), ("HEAD", "/me", None, False), ("POST", "/me", '{"a": 1}', True),
    ("post", "/me", "[1]", False), ("PATCH", "/me", " ", False), ("GET", "", None, False),
    ("DELETE", "/me/x", None, True)])
def test_valid_request(spark, method, url, body, ok):
    row = spark.createDataFrame([(method, url, body)], "m STRING, u STRING, b STRING").select(
        K.valid_request(F.col("m"), F.col("u"), F.col("b")).alias("ok")).collect()[0]
    assert row.ok is ok


@pytest.mark.parametrize("text,ok", [(" ", True), ("${x}", True), ('{"a":1}', True), ("nope", False)])
def test_valid_json(spark, text, ok):
    assert one(spark, K.valid_json(F.col("v")), text) is ok


def test_blank_select_list_is_no_list(spark):
    from mailsync.operators.outbox import RequestParams, request_table
    rows = [(C.ROUTE_SUCCESS, {"s": s}, "", 1) for s in ("\t", " ", "\n \t", "id,name")]
    out = request_table(spark.createDataFrame(rows, "route STRING, attributes MAP<STRING,STRING>, content STRING, emit_seq BIGINT"),
                        RequestParams(url="/me", method="GET", select_fields="${s}"))
    assert [r.select_fields for r in out.collect()] == [None, None, None, "id,name"]
