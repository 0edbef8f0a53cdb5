import re
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from mailsync.llm import exact_dedup as K
from mailsync.session import scratch_path


def _normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute(rows):
    groups = defaultdict(list)
    for doc, text in rows:
        groups[_normal(text)].append(doc)
    out = []
    for text, docs in groups.items():
        known = [d for d in docs if d is not None]
        keep = min(known) if known else None
        for n, doc in enumerate(sorted(docs, key=lambda d: (d is None, d))):
            out.append((doc, keep, len(docs), n == 0, sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def _got(docs, **how):
    return sorted((tuple(r) for r in K.exact_dedup(docs, **how).collect()), key=repr)


@pytest.mark.parametrize("digest", [lambda s: s, lambda s: F.substring(s, 1, 1)], ids=["sha256", "colliding"])
def test_groups_by_full_bytes(spark, edge_docs, digest):
    rows = [(r.doc_id, r.text) for r in edge_docs.select("doc_id", "text").collect()]
    assert _got(edge_docs, digest=digest) == brute(rows)


def test_a_hot_group_is_salted(spark, monkeypatch):
    monkeypatch.setattr(K, "SALT_ROWS", 4)
    rows = [(i, "the  same\ttext") for i in range(300)] + [(1000 + i, f"text {i // 2}") for i in range(100)]
    assert _got(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_three_landings_with_copies_across_them(spark):
    root = scratch_path(spark, "test-op4")
    landings = [[(5, "a b"), (6, "c"), (7, "c")], [(2, "a  b"), (9, "d"), (6, "c")], [(1, "e"), (5, "a\tb"), (None, "d")]]
    for n, rows in enumerate(landings):
        K.land(spark.createDataFrame(rows, "doc_id long, text string"), f"{root}/landing")
        groups = K.absorb(spark, f"{root}/landing", f"{root}/state")
        landed = spark.read.parquet(f"{root}/landing")
        so_far = [x for rows in landings[:n + 1] for x in rows]
        assert landed.select("locator").distinct().count() == len(so_far)
        settled = K.settle(landed, groups)
        got = settled.select("doc_id", "first.doc_id", "n", (F.col("locator") == F.col("first.locator")).alias("kept"), "text_sha256")
        assert sorted(map(tuple, got.collect()), key=repr) == brute(so_far)
        assert K.first_rows(landed, settled).count() == len({_normal(t) for _, t in so_far})
    assert sorted((r["first"].doc_id, r.n) for r in groups.collect()) == [(1, 1), (2, 3), (6, 3), (9, 2)]


def test_rows_and_columns_of_the_table_stay(edge_docs, no_docs):
    left = K.drop_copies(edge_docs)
    assert left.columns == edge_docs.columns
    assert left.count() == len({_normal(r.text) for r in edge_docs.select("text").collect()})
    assert K.drop_copies(no_docs).collect() == [] and K.exact_dedup(no_docs).collect() == []
