"""Paging, chain tokens, replays and the stream."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from mailsync import constants as C
from mailsync.operators.dedupe import dedupe_replay
from mailsync.plans.testpaging import pack_pages, rank_within
from mailsync.operators.state import bootstrap, chain_tokens, upsert_checkpoints
from mailsync.plans import queries as Q
from mailsync.plans import sync as SY
from mailsync.plans import testviews as TV
from mailsync.session import scratch_path
from mailsync.sources.pages import flatten_pages
from mailsync.streaming import stream as STR


def test_rank_within_hot_key_spans_partitions(spark):
    # one key holds most rows; ranks must still be 1..n per key with no gap or repeat
    df = spark.range(0, 20000).select(
        F.when(F.col("id") % 7 == 0, F.lit("cold")).otherwise(F.lit("hot")).alias("k"), F.col("id").alias("o"))
    r = rank_within(df, ["k"], ["o"], num_partitions=8)
    got = {row.k: (row.n, row.lo, row.hi, row.d) for row in
           r.groupBy("k").agg(F.count("*").alias("n"), F.min("rank").alias("lo"), F.max("rank").alias("hi"),
                              F.count_distinct("rank").alias("d")).collect()}
    for k, (n, lo, hi, d) in got.items():
        assert (lo, hi, d) == (1, n, n), k
    # order kept: the rank is the row number by o inside the key (checked the slow way on a small input)
    expect = df.withColumn("rank", F.row_number().over(Window.partitionBy("k").orderBy("o")))
    assert r.select("k", "o", "rank").exceptAll(expect).count() == 0


def test_pack_flatten_round_trip(spark):
    items = spark.range(0, 95).select(F.lit("u").alias("user_id"), F.col("id").alias("o"),
                                      F.to_json(F.struct(F.col("id").cast("string").alias("id"))).alias("item"))
    chains = spark.createDataFrame([("u", "42"), ("empty", "7")], "user_id STRING, delta_link STRING")
    pages = pack_pages(items, chains, ["user_id"], ["o"], 10, "folders")
    assert pages.filter("user_id = 'u'").count() == 10
    flat = flatten_pages(pages)
    assert flat.count() == 95
    back = flat.select(F.get_json_object("item", "$.id").cast("bigint").alias("id"))
    assert back.exceptAll(spark.range(0, 95)).count() == 0 and spark.range(0, 95).exceptAll(back).count() == 0
    toks = {r.user_id: r.new_delta for r in chain_tokens(pages, ["user_id"]).collect()}
    assert toks == {"u": "42", "empty": "7"}  # an empty chain still ends with its delta link


def test_incomplete_chain_holds_token(spark):
    items = spark.range(0, 25).select(F.lit("u").alias("user_id"), F.col("id").alias("o"),
                                      F.to_json(F.struct(F.col("id").alias("id"))).alias("item"))
    chains = spark.createDataFrame([("u", "T")], "user_id STRING, delta_link STRING")
    pages = pack_pages(items, chains, ["user_id"], ["o"], 10, "folders")
    assert chain_tokens(pages.filter("page_no != 1"), ["user_id"]).count() == 0  # a middle page missing
    assert chain_tokens(pages.filter("page_no != 2"), ["user_id"]).count() == 0  # the last page missing
    assert chain_tokens(pages.unionByName(pages), ["user_id"]).count() == 1     # replayed pages count once


def test_bootstrap_only_without_keys(spark):
    none = spark.createDataFrame([], "key STRING, delta STRING")
    some = spark.createDataFrame([("O365_users_delta", "x")], "key STRING, delta STRING")
    assert [r.key for r in bootstrap(none, C.KEY_USERS).collect()] == [C.KEY_USERS]
    assert bootstrap(some, C.KEY_USERS).count() == 0


def test_upsert_latest_version_wins(spark):
    ck = spark.createDataFrame([("a", "1", 1), ("b", "1", 1)], "key STRING, delta STRING, version BIGINT")
    new = spark.createDataFrame([("b", "2"), ("c", "3")], "key STRING, delta STRING")
    got = {r.key: (r.delta, r.version) for r in upsert_checkpoints(ck, new, 2).collect()}
    assert got == {"a": ("1", 1), "b": ("2", 2), "c": ("3", 2)}


def test_malformed_keys_fail_alone(spark):
    pages = TV.land_changes(spark, SF_SMALL)
    ck = Q._changes_work(spark, SF_SMALL)
    bad = spark.createDataFrame([("O365_messages|7", ""), ("O365_messages|7|", "")], "key STRING, delta STRING")
    recs, _, failed = SY.sync_messages(pages, ck.unionByName(bad))
    assert failed.count() == 2
    assert set(r.route for r in failed.collect()) == {C.ROUTE_FAILURE}
    good, _, _ = SY.sync_messages(pages, ck)
    assert recs.count() == good.count()  # the other keys are unaffected


def test_replay_dedupe_and_rerun(spark):
    pages = TV.land_changes(spark, SF_SMALL)
    work = Q._changes_work(spark, SF_SMALL)
    once, _, _ = SY.sync_messages(pages, work)
    doubled = pages.unionByName(pages)
    twice, _, _ = SY.sync_messages(doubled, work, dedupe=False)
    assert twice.count() > once.count()
    key = ["route", "emit_seq", "content"]
    default, _, _ = SY.sync_messages(doubled, work)  # replayed pages are dropped unless asked not to
    assert default.select(*key).exceptAll(once.select(*key)).count() == 0 and default.count() == once.count()
    d = dedupe_replay(twice)
    assert d.select(*key).exceptAll(once.select(*key)).count() == 0
    assert once.select(*key).exceptAll(d.select(*key)).count() == 0


def test_stream_equals_batch_and_rerun_is_noop(spark):
    batch = Q.q_success_union(spark, SF_SMALL)
    root = scratch_path(spark, "test-stream")
    STR.land_files(TV.land_changes(spark, SF_SMALL), f"{root}/landing", 3)
    ck = Q._changes_work(spark, SF_SMALL).withColumn("version", F.lit(0).cast("bigint"))
    args = (spark, f"{root}/landing", f"{root}/state", f"{root}/out")
    STR.sync_stream(*args, initial_ckpt=ck, dedupe=False)
    out = Q.record_view(STR.read_stream_output(spark, f"{root}/out"))
    assert out.exceptAll(batch).count() == 0 and batch.exceptAll(out).count() == 0
    STR.sync_stream(*args, initial_ckpt=ck, dedupe=False)  # nothing new landed: no change
    again = Q.record_view(STR.read_stream_output(spark, f"{root}/out"))
    assert again.count() == out.count()


def test_checkpoint_store_deltas_and_compaction(spark):
    import pytest
    from mailsync.sources import checkpoints as CK
    root = scratch_path(spark, "test-ckpt")
    rows = lambda *x: spark.createDataFrame(list(x), "key STRING, delta STRING")
    assert CK.scan_checkpoints(spark, root).count() == 0 and CK.latest_version(spark, root) is None
    CK.write_checkpoints(rows(("a", "1"), ("b", "1")), root, 0)
    CK.write_delta(rows(("b", "half")), root, 1)
    CK.write_delta(rows(("b", "2")), root, 1)  # the replay of a run that failed
    CK.write_delta(rows(("c", "3"), ("d", "3")), root, 2)
    CK.write_delta(rows(), root, 3, removed=rows(("d", "")).select("key"))
    want = {"a": ("1", 0), "b": ("2", 1), "c": ("3", 2)}
    read = lambda: {r.key: (r.delta, r.version) for r in CK.scan_checkpoints(spark, root).collect()}
    assert read() == want
    assert CK.compact(spark, root) == 3 and CK._places(spark, root) == [7]
    assert read() == want and CK.compact(spark, root) == 3
    with pytest.raises(ValueError):
        CK.write_delta(rows(("d", "4")), root, 2)
    CK.write_delta(rows(("d", "4")), root, 4)
    assert read() == {**want, "d": ("4", 4)}


def test_a_compaction_that_died_leaves_the_same_map(spark):
    from mailsync.sources import checkpoints as CK
    root = scratch_path(spark, "test-compact")
    rows = lambda *x: spark.createDataFrame(list(x), "key STRING, delta STRING")
    CK.write_checkpoints(rows(("a", "1"), ("b", "1")), root, 0)
    CK.write_delta(rows(("a", "2")), root, 1, removed=rows(("b", "")).select("key"))
    CK._store(CK.scan_checkpoints(spark, root).withColumn("removed", F.lit(False)), root, 3)  # written, nothing deleted yet
    assert {r.key: r.delta for r in CK.scan_checkpoints(spark, root).collect()} == {"a": "2"}
    assert CK.compact(spark, root) == 1 and CK._places(spark, root) == [3]
    assert {r.key: r.delta for r in CK.scan_checkpoints(spark, root).collect()} == {"a": "2"}


def test_stream_batch_replay_gives_the_same(spark, monkeypatch):
    """A run dies after its batch wrote records, before the batch was committed: the replay overwrites it."""
    from mailsync.sources import checkpoints as CK
    root = scratch_path(spark, "test-replay")
    args = (spark, f"{root}/landing", f"{root}/state", f"{root}/out")
    STR.land_files(TV.land_changes(spark, SF_SMALL), f"{root}/landing", 1)
    ck = Q._changes_work(spark, SF_SMALL).withColumn("version", F.lit(0).cast("bigint"))
    real = CK.write_delta
    monkeypatch.setattr(CK, "write_delta", lambda *a, **k: (real(*a, **k), 1 / 0))
    try:
        STR.sync_stream(*args, initial_ckpt=ck)
        raise AssertionError("the batch should have failed")
    except Exception as exc:
        assert "ZeroDivisionError" in str(exc)
    monkeypatch.undo()
    first = Q.record_view(STR.read_stream_output(spark, f"{root}/out")).collect()
    STR.sync_stream(*args, initial_ckpt=ck)
    again = Q.record_view(STR.read_stream_output(spark, f"{root}/out")).collect()
    assert len(first) > 0 and sorted(map(str, first)) == sorted(map(str, again))
    assert CK.latest_version(spark, f"{root}/state/checkpoints") == 1


def test_json_lines_landing_and_json_records(spark):
    from mailsync.sources.pages import read_pages
    from mailsync.sources.sink import read_records, write_records
    root = scratch_path(spark, "test-jsonl")
    pages = TV.land_changes(spark, SF_SMALL)
    pages.write.json(f"{root}/landing")
    back = read_pages(spark, f"{root}/landing", resource="messages", fmt="json")
    cols = ["user_id", "folder_id", "request_token", "page_no", "body"]
    assert back.select(*cols).exceptAll(pages.select(*cols)).count() == 0
    recs, _, _ = SY.sync_messages(back, Q._changes_work(spark, SF_SMALL))
    write_records(recs, f"{root}/records", fmt="json")
    got = read_records(spark, f"{root}/records", fmt="json")
    assert got.count() == recs.count()
    assert {r.route for r in got.select("route").distinct().collect()} == {C.ROUTE_SUCCESS_MESSAGES}


def test_select_json_fields_keeps_only_listed(spark):
    from mailsync import schemas as S
    from mailsync.functions.fields import select_json_fields
    df = spark.createDataFrame([('{"id":"1","subject":"s","importance":"high","isRead":true}',)], "c STRING")
    out = df.select(select_json_fields(F.col("c"), S.MESSAGE_DDL, "id, subject").alias("o")).collect()[0].o
    assert out == '{"id":"1","subject":"s"}'


def test_last_page_without_delta_link_emits_no_token(spark):
    from mailsync.operators.state import token_records
    items = spark.range(0, 5).select(F.lit("u").alias("user_id"), F.col("id").alias("o"),
                                     F.to_json(F.struct(F.col("id").alias("id"))).alias("item"))
    chains = spark.createDataFrame([("u", None)], "user_id STRING, delta_link STRING")
    pages = pack_pages(items, chains, ["user_id"], ["o"], 10, "folders")
    toks = chain_tokens(pages, ["user_id"]).withColumn("key", F.lit("k")).withColumn("delta", F.lit("old"))
    assert toks.count() == 1 and toks.collect()[0].new_delta is None
    assert token_records(toks, C.ROUTE_SUCCESS).count() == 0
    assert token_records(toks, C.ROUTE_DELTA, always=True).count() == 0


def test_corrupt_page_fails_and_holds_token(spark):
    pages = TV.land_changes(spark, SF_SMALL)
    work = Q._changes_work(spark, SF_SMALL)
    victim = pages.select("user_id", "folder_id", "request_token").limit(1).collect()[0]
    hit = ((F.col("user_id") == victim.user_id) & (F.col("folder_id") == victim.folder_id)
           & (F.col("page_no") == 0))
    broken = pages.withColumn("body", F.when(hit, F.lit('{"value": [oops')).otherwise(F.col("body")))
    _, good_toks, _ = SY.sync_messages(pages, work)
    _, toks, _ = SY.sync_messages(broken, work)
    failed = SY.bad_pages(broken)
    assert failed.filter(F.col("attributes")[C.ATTR_ERROR] == "page body is not JSON").count() == 1
    assert toks.count() == good_toks.count() - 1  # that folder's token is held back


def test_paging_keeps_null_keys(spark):
    items = spark.range(0, 25).select(
        F.when(F.col("id") < 12, F.lit(None)).otherwise(F.lit("u")).cast("string").alias("user_id"),
        F.col("id").alias("o"), F.to_json(F.struct(F.col("id").alias("id"))).alias("item"))
    r = rank_within(items, ["user_id"], ["o"])
    assert r.count() == 25
    chains = spark.createDataFrame([(None, "a"), ("u", "b")], "user_id STRING, delta_link STRING")
    pages = pack_pages(items, chains, ["user_id"], ["o"], 5, "folders")
    assert flatten_pages(pages).count() == 25


def test_second_run_after_upsert_picks_up_nothing_old(spark):
    from mailsync.operators.state import upsert_checkpoints
    pages = TV.land_changes(spark, SF_SMALL)
    work = Q._changes_work(spark, SF_SMALL).withColumn("version", F.lit(1).cast("bigint"))
    recs, toks, _ = SY.sync_messages(pages, work)
    assert recs.count() > 0
    after = upsert_checkpoints(work, SY.new_tokens(toks), 2)
    again, toks2, _ = SY.sync_messages(pages, after)
    # every chain landed was asked with the old tokens: with the new ones nothing old comes back,
    # except chains whose token did not change (asked with the same token as before)
    unchanged = toks.filter(F.col("new_delta") == F.col("delta")).count()
    assert toks2.count() == unchanged
    assert again.filter(F.col("emit_seq") == C.EMIT_TOKEN).count() == 0


def test_tenant_sync_routes_bad_keys_to_failure(spark):
    pages = TV.landed_all(spark, SF_SMALL)
    ck = TV.checkpoints(spark, SF_SMALL).select("key", "delta").unionByName(
        spark.createDataFrame([("O365_messages|7|", ""), ("O365_folders|", "")], "key STRING, delta STRING"))
    recs, toks, failures = SY.sync_tenant(pages, ck)
    assert failures.count() == 2
    assert {r.route for r in recs.select("route").distinct().collect()} == {
        C.ROUTE_SUCCESS, C.ROUTE_SUCCESS_MESSAGES, C.ROUTE_SUCCESS_ATTACHMENTS}
    assert toks.filter(F.col("key").isNull() | F.col("delta").isNull()).count() == 0


def _page(chain, no, items, nxt=None, delta=None, attempt=None, at=0):
    import datetime as dt
    import json
    body = {"value": [{"id": i} for i in items]}
    body.update({"@odata.nextLink": nxt} if nxt else {})
    body.update({"@odata.deltaLink": delta} if delta else {})
    return ("messages", "u", "f", None, chain, no, dt.datetime(2024, 3, 1) + dt.timedelta(minutes=at), json.dumps(body), attempt)


def _pages(spark, *rows):
    from mailsync import schemas as S
    return spark.createDataFrame(list(rows), S.ENVELOPE_DDL)


MAIL_KEY = "O365_messages|u|f"


def test_attempts_never_add_up(spark):
    chain = ["user_id", "folder_id", "request_token"]
    failed = [_page("", 0, ["a"], nxt="n", attempt="1"), _page("", 1, ["b"], nxt="n", attempt="1")]
    rerun = [_page("", 0, ["a"], nxt="n", attempt="2", at=9), _page("", 2, ["c"], delta="T", attempt="2", at=9)]
    assert chain_tokens(_pages(spark, *failed, *rerun), chain).count() == 0
    whole = _page("", 1, ["b"], nxt="n", attempt="2", at=9)
    again = [_page("", 0, ["z"], delta="T9", attempt="0", at=3)]
    got = chain_tokens(_pages(spark, *failed, *rerun, whole, *again), chain).collect()
    assert [r.new_delta for r in got] == ["T"]  # the complete attempt that ended last


def test_token_plan_moves_no_body(spark):
    pages = _pages(spark, _page("", 0, ["a"], delta="T"))
    work = SY.message_work(spark.createDataFrame([(MAIL_KEY, "")], "key STRING, delta STRING"))
    plan = SY.message_tokens(pages, work)._jdf.queryExecution().optimizedPlan().toString()
    below = [line for line in plan.split("\n") if "Join" in line or "Aggregate" in line]
    assert below and not any("body" in line for line in below)


def test_hot_chain_gives_its_token(spark):
    rows = [_page("", n, [f"i{n}"], nxt="n" if n < 299 else None, delta="T" if n == 299 else None) for n in range(300)]
    assert [r.new_delta for r in chain_tokens(_pages(spark, *rows), ["user_id", "folder_id", "request_token"]).collect()] == ["T"]


def _streamed(spark, batches, ckpt, **how):
    from mailsync.sources import checkpoints as CK
    from mailsync.sources.pages import write_pages
    root = scratch_path(spark, "test-lossless")
    for rows in batches:
        write_pages(_pages(spark, *rows).coalesce(1), f"{root}/landing", mode="append", buckets=1)
    STR.sync_stream(spark, f"{root}/landing", f"{root}/state", f"{root}/out", initial_ckpt=spark.createDataFrame(ckpt, "key STRING, delta STRING"),
                    max_files_per_trigger=1, compact_every=2, **how)
    recs = STR.read_stream_output(spark, f"{root}/out").collect()
    ids = sorted(r.attributes[C.ATTR_MESSAGE_ID] for r in recs if r.emit_seq == C.EMIT_ITEM)
    tokens = [r.content for r in recs if r.emit_seq == C.EMIT_TOKEN]
    now = {r.key: r.delta for r in CK.scan_checkpoints(spark, f"{root}/state/checkpoints").collect()}
    return ids, sorted(tokens), now, STR.scan_waiting(spark, f"{root}/state").count()


def test_stream_loses_nothing(spark):
    a, b, c = _page("", 0, ["a"], delta="T1"), _page("T1", 0, ["b"], delta="T2"), _page("T2", 0, ["c"], delta="T3")
    want = (["a", "b", "c"], ["T1", "T2", "T3"], {MAIL_KEY: "T3"}, 0)
    known = [(MAIL_KEY, "")]
    assert _streamed(spark, [[a, b], [c]], known) == want                    # chained tokens in one batch
    assert _streamed(spark, [[c], [b], [a]], known, dedupe=False) == want    # later tokens first
    assert _streamed(spark, [[a, b, c]], [("O365_users_delta", "")])[0] == ["a", "b", "c"]  # unknown key
    late = _page("", 1, ["b2"], delta="T1", at=9000), _page("", 0, ["a"], nxt="n", at=0)
    assert _streamed(spark, [[late[0]], [late[1]]], known) == (["a", "b2"], ["T1"], {MAIL_KEY: "T1"}, 0)
    assert _streamed(spark, [[late[0]], [c]], known) == ([], [], {MAIL_KEY: ""}, 2)  # both wait


def test_stream_drops_replays_only(spark):
    first, last = _page("", 0, ["a"], nxt="n"), _page("", 1, ["b"], delta="T1")
    again = _page("", 0, ["a"], nxt="n", attempt="2", at=5)
    got = _streamed(spark, [[first, again], [again], [last], [first, last]], [(MAIL_KEY, "")])
    assert got == (["a", "b"], ["T1"], {MAIL_KEY: "T1"}, 0)
    got = _streamed(spark, [[first, last], [first, last]], [(MAIL_KEY, "")], dedupe=False)
    assert got[0] == ["a", "a", "b", "b"] and got[1:] == (["T1"], {MAIL_KEY: "T1"}, 0)


def _token_row(n):
    return [_page(f"T{k}" if k else "", 0, [f"m{k}"], delta=f"T{k + 1}", at=k) for k in range(n)]


def test_64_chained_tokens_in_one_landing(spark, monkeypatch):
    from mailsync.operators import state as ST
    got = _streamed(spark, [_token_row(64)[::-1]], [(MAIL_KEY, "")])
    assert got[0] == sorted(f"m{k}" for k in range(64)) and got[2:] == ({MAIL_KEY: "T64"}, 0)
    rounds = []
    real = ST.written
    monkeypatch.setattr(ST, "written", lambda df, name: rounds.append(name) or real(df, name))
    ck = spark.createDataFrame([(MAIL_KEY, "")], "key STRING, delta STRING")
    recs, tokens, _ = SY.catch_up_messages(_pages(spark, *_token_row(64)), ck)
    assert sorted(r.attributes[C.ATTR_MESSAGE_ID] for r in recs.collect() if r.emit_seq == C.EMIT_ITEM) == got[0]
    assert [tuple(r) for r in tokens.select("key", "delta", "new_delta").collect()] == [(MAIL_KEY, "", "T64")]
    assert rounds.count("jumps") <= 7  # log2 of 64, and the round that finds nothing


def test_catch_up_ends_where_tokens_run_in_a_circle(spark):
    rows = [_page("", 0, ["a"], delta="T1"), _page("T1", 0, ["b"], delta="T2"), _page("T2", 0, ["c"], delta="T1"), _page("T9", 0, ["z"], delta="T10")]
    ck = spark.createDataFrame([(MAIL_KEY, "")], "key STRING, delta STRING")
    recs, _, _ = SY.catch_up_messages(_pages(spark, *rows), ck)
    assert sorted(r.attributes[C.ATTR_MESSAGE_ID] for r in recs.collect() if r.emit_seq == C.EMIT_ITEM) == ["a", "b", "c"]


def test_attachments_of_replays_and_removed_messages(spark):
    import datetime as dt
    from mailsync import schemas as S
    msg = lambda i, body: (C.ROUTE_SUCCESS_MESSAGES, {C.ATTR_USER_ID: "u", C.ATTR_MESSAGE_ID: i}, body, C.EMIT_ITEM)
    records = spark.createDataFrame([msg("m", '{"id":"m"}'), msg("gone", '{"id":"gone","@removed":{"reason":"deleted"}}')], S.RECORD_DDL)

    def page(message, attempt, hour, names):
        body = '{"value": [' + ",".join(f'{{"name":"{n}"}}' for n in names) + "]}"
        return ("attachments", "u", None, message, "", 0, dt.datetime(2024, 3, 1, hour), body, attempt)

    landed = [page("m", "1", 1, ["x", "x"]), page("m", "2", 2, ["x", "x", "y"]), page("gone", "1", 1, ["z"])]
    for k in (1, 2, 3):
        got = SY.expand_attachments(records, spark.createDataFrame(landed * k, S.ENVELOPE_DDL))
        assert sorted(r.attributes[C.ATTR_ATTACHMENT_FILE_NAME] for r in got.collect()) == ["x", "x", "y"]
    plan = SY.expand_attachments(records, spark.createDataFrame(landed, S.ENVELOPE_DDL))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Join")  # pages are flattened after they are chosen


def test_tenant_rerun_takes_up_after_the_last_level(spark, monkeypatch):
    pages, ck = TV.landed_all(spark, SF_SMALL), TV.checkpoints(spark, SF_SMALL)
    out = scratch_path(spark, "test-tenant")
    real = SY.sync_messages
    monkeypatch.setattr(SY, "sync_messages", lambda *a, **k: 1 / 0)
    try:
        SY.sync_tenant(pages, ck, out)
        raise AssertionError("the level should have failed")
    except ZeroDivisionError:
        pass
    monkeypatch.setattr(SY, "sync_messages", real)
    monkeypatch.setattr(SY, "sync_users", lambda *a, **k: 1 / 0)  # done before, must not run again
    recs, toks, _ = SY.sync_tenant(pages, ck, out)
    monkeypatch.undo()
    recs2, toks2, _ = SY.sync_tenant(pages, ck)
    assert (recs.count(), toks.count()) == (recs2.count(), toks2.count())


def test_incremental_runs_read_by_date_and_skip_nothing(spark):
    from mailsync.sources.pages import read_pages, write_pages
    root = scratch_path(spark, "test-dates")
    land = lambda *rows: write_pages(_pages(spark, *rows), f"{root}/landing", mode="append")
    ck = spark.createDataFrame([(MAIL_KEY, "")], "key STRING, delta STRING")
    day = 24 * 60
    runs = ([_page("", 1, ["b"], delta="T1")], [_page("T1", 0, ["c"], delta="T2", at=day)],
            [_page("", 0, ["a"], nxt="n", at=2 * day)])  # the first page of the first chain comes last
    for rows in runs:
        land(*rows)
        STR.sync_landing(spark, f"{root}/landing", f"{root}/state", f"{root}/out", initial_ckpt=ck)
    recs = STR.read_stream_output(spark, f"{root}/out").collect()
    assert sorted(r.attributes[C.ATTR_MESSAGE_ID] for r in recs if r.emit_seq == C.EMIT_ITEM) == ["a", "b", "c"]
    assert sorted(r.content for r in recs if r.emit_seq == C.EMIT_TOKEN) == ["T1", "T2"]
    recent = read_pages(spark, f"{root}/landing", resource="messages", since="2024-03-03")
    assert recent.count() == 1 and "landing_date" in str(recent._jdf.queryExecution().executedPlan()).split("PartitionFilters")[1]


def test_incremental_runs_take_older_days_and_undated_pages_that_land_later(spark):
    from mailsync.sources.pages import write_pages
    root = scratch_path(spark, "test-late-days")
    ck = spark.createDataFrame([(MAIL_KEY, "")], "key STRING, delta STRING")
    day = 24 * 60
    newest = _pages(spark, _page("", 2, ["c"], delta="T1", at=2 * day))
    older = _pages(spark, _page("", 0, ["a"], nxt="n", at=-1))  # the day before, lands after
    undated = _pages(spark, _page("", 1, ["b"], nxt="n")).withColumn("fetched_at", F.lit(None).cast("timestamp"))
    for pages in (newest, older, undated):
        write_pages(pages, f"{root}/landing", mode="append")
        STR.sync_landing(spark, f"{root}/landing", f"{root}/state", f"{root}/out", initial_ckpt=ck)
    recs = STR.read_stream_output(spark, f"{root}/out").collect()
    assert sorted(r.attributes[C.ATTR_MESSAGE_ID] for r in recs if r.emit_seq == C.EMIT_ITEM) == ["a", "b", "c"]
    assert [r.content for r in recs if r.emit_seq == C.EMIT_TOKEN] == ["T1"]


def test_small_chains_are_gathered_and_large_ones_spread(spark, monkeypatch):
    from mailsync.plans import testpaging as TP
    sizes = {"a": 3, "b": 10, "c": 41, "d": 0}
    items = spark.createDataFrame([(u, n, f'{{"id":{n}}}') for u, k in sizes.items() for n in range(k)] + [(None, 1, '{"id":1}')],
                                  "user_id STRING, o INT, item STRING")
    chains = spark.createDataFrame([(u, f"T{u}") for u in sizes] + [(None, "Tn"), ("b", "again")], "user_id STRING, delta_link STRING")
    land = lambda: sorted((str(r.user_id), r.page_no, r.body) for r in pack_pages(items, chains, ["user_id"], ["o"], 5, "folders").collect())
    assert len(land()) == 1 + 2 * 2 + 9 + 1 + 1
    gathered = land()
    monkeypatch.setattr(TP, "rank_within", None)  # nothing is ranked or checkpointed for chains that fit a group
    assert land() == gathered
    monkeypatch.undo()
    monkeypatch.setattr(TP, "SMALL_CHAIN", 8)
    assert land() == gathered
