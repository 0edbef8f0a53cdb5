"""Which attempt counts, and that bodies of other chains stay where they are."""

import random
import re

from pyspark.sql import functions as F

from mailsync.operators.attempts import counting_chains, links_of, tokens_of_links
from mailsync.plans import sync as SY
from mailsync.session import scratch_path
from mailsync.sources.pages import flatten_pages, item_field, read_pages, write_pages
from test_sync import MAIL_KEY, _page, _pages

CHAIN = ["user_id", "folder_id", "request_token"]


def _ids(df):
    return sorted(r.id for r in flatten_pages(df, ["page_no"]).select(item_field("id").alias("id")).collect())


def test_newest_complete_attempt_counts(spark):
    whole = [_page("", 0, ["a1", "a2"], nxt="n", attempt="A"), _page("", 1, ["a3"], delta="T", attempt="A", at=1)]
    begun = [_page("", 0, ["a1"], nxt="n", attempt="B", at=60)]
    assert _ids(counting_chains(_pages(spark, *whole, *begun), CHAIN)) == ["a1", "a2", "a3"]
    ended = [*begun, _page("", 1, ["a2"], nxt="n", attempt="B", at=60), _page("", 2, ["a3", "a4"], delta="T2", attempt="B", at=61)]
    pages = _pages(spark, *whole, *ended)
    assert _ids(counting_chains(pages, CHAIN)) == ["a1", "a2", "a3", "a4"]
    assert [r.new_delta for r in tokens_of_links(links_of(pages, CHAIN), CHAIN).collect()] == ["T2"]


def test_pages_landed_again(spark):
    whole = [_page("", 0, ["x", "x"], nxt="n"), _page("", 1, ["y"], delta="T")]
    assert _ids(counting_chains(_pages(spark, *whole, *whole), CHAIN)) == ["x", "x", "y"]  # equal rows
    later = _page("", 1, ["y", "z"], delta="T", at=5)
    assert _ids(counting_chains(_pages(spark, *whole, later), CHAIN)) == ["x", "x", "y", "z"]
    unfinished = [_page("", 0, ["x"], nxt="n", attempt="A"), _page("", 0, ["x"], nxt="n", attempt="B", at=3), _page("", 2, ["q"], nxt="n", attempt="B")]
    assert _ids(counting_chains(_pages(spark, *unfinished), CHAIN)) == ["q", "x"]


def test_random_attempts_against_the_rule(spark):
    rng = random.Random(3)
    rows, want = [], {}
    for chain in range(60):
        done = []
        for attempt in range(rng.randint(1, 4)):
            n, at = rng.randint(1, 3), rng.randint(0, 500)
            landed = [p for p in range(n) if rng.random() < 0.8]
            for p in landed:
                rows.append(_page(f"c{chain}", p, [f"{chain}.{attempt}.{p}"], nxt=None if p == n - 1 else "n",
                                  delta=f"{chain}.{attempt}" if p == n - 1 else None, attempt=f"a{attempt}", at=at + p))
            if len(landed) == n:
                done.append((at + n - 1, f"a{attempt}", f"{chain}.{attempt}"))
        if done:
            want[f"c{chain}"] = max(done)[2]
    pages = _pages(spark, *rows)
    got = {r.request_token: r.new_delta for r in tokens_of_links(links_of(pages, CHAIN), CHAIN).collect()}
    assert got == want
    ids = _ids(counting_chains(pages, CHAIN).filter(F.col("request_token").isin(list(want))))
    assert ids == sorted(f"{want[r[4]]}.{r[5]}" for r in rows if r[4] in want and r[8] == "a" + want[r[4]].split(".")[1])


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_body_is_read_only_from_buckets_and_chains_of_the_work(spark):
    root = scratch_path(spark, "test-buckets")
    rows = []
    for u in range(200):
        for token in ("", "T"):
            rows.append(("messages", f"u{u}", "f", None, token, 0, None, f'{{"value":[{{"id":"m{u}"}}],"@odata.deltaLink":"L"}}', None))
            rows.append(("attachments", f"u{u}", None, f"m{u}", token, 0, None, '{"value":[{"name":"x"}]}', None))
    write_pages(_pages(spark, *rows), root, buckets=64)
    pages = read_pages(spark, root)
    ck = spark.createDataFrame([(f"O365_messages|u{u}|f", "") for u in range(10)], "key STRING, delta STRING")
    found = SY.select_message_chains(pages, SY.message_work(ck))
    assert "chain_bucket_64" in _plan(found.pages).split("PartitionFilters")[1].split("]")[0]
    listed = re.search(r"chain_bucket_64#\d+ IN(?:SET)? \(?([\d, ]+)", found.pages._jdf.queryExecution().optimizedPlan().toString())
    buckets = {int(x) for x in re.findall(r"\d+", listed.group(1))}
    assert 0 < len(buckets) <= 10
    assert buckets == {r[0] for r in pages.filter(F.col("user_id").isin([f"u{u}" for u in range(10)])).select("chain_bucket_64").distinct().collect()}
    records, tokens, _ = SY.sync_messages(pages, ck)
    assert tokens.count() == 10
    messages = records.filter("emit_seq = 1")
    files = SY.expand_attachments(messages, pages)
    assert files.count() == 20  # both chains of ten messages
    for df in (records, files):
        moved = [line for line in _plan(df).split("\n") if "Exchange" in line and "body" in line and "Broadcast" not in line]
        assert not moved


def test_no_sort_aggregate_over_pages(spark):
    pages = _pages(spark, _page("", 0, ["a"], nxt="n"), _page("", 1, ["b"], delta="T"))
    links = links_of(pages, CHAIN)
    from mailsync.operators.attempts import newest_attempts
    plan = _plan(newest_attempts(links, CHAIN))
    over_pages = [line for line in plan.split("\n") if "SortAggregate" in line and "page_no" in line]
    assert not over_pages


def test_work_of_one_key_finds_its_chain_without_buckets(spark):
    pages = _pages(spark, _page("", 0, ["a"], delta="T"))
    recs, toks, _ = SY.sync_messages(pages, spark.createDataFrame([(MAIL_KEY, "")], "key STRING, delta STRING"))
    assert recs.count() == 2 and [r.new_delta for r in toks.collect()] == ["T"]


def test_a_body_moves_once_to_many_messages(spark, monkeypatch):
    from mailsync.operators import joins
    rows = []
    for u in range(20):
        rows.append(("messages", f"u{u}", "f", None, "", 0, None, f'{{"value":[{{"id":"m{u}"}}],"@odata.deltaLink":"L"}}', None))
        for run in ("a", "b"):
            rows.append(("attachments", f"u{u}", None, f"m{u}", "", 0, None, f'{{"value":[{{"name":"{run}"}}]}}', run))
    pages = _pages(spark, *rows)
    ck = spark.createDataFrame([(f"O365_messages|u{u}|f", "") for u in range(10)], "key STRING, delta STRING")
    messages = SY.sync_messages(pages, ck)[0].filter("emit_seq = 1")
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 3)
    files = SY.expand_attachments(messages, pages)
    moved = [line for line in _plan(files).split("\n") if "Exchange" in line]
    assert len(moved) <= 2  # the pages, and the messages with what is decided for them
    assert sorted(r.content for r in files.collect()) == ['{"name":"b"}'] * 10
