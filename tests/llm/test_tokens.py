import random

import pytest

from conftest import SF_SMALL
from llm.conftest import BYTE_BPE
from mailsync.llm import tokens as K

PIECES = ["a", "b ", " ", "  ", "\n", "x" * 12, "<|endoftext|>", "<|endof", "é", "日本", "'s", "12", "!?", " ", "​", " \n\n "]


def _want(texts):
    return [len(e.ids) for e in K.tokenizer(BYTE_BPE).encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("how", [{}, {"huge_chars": 50, "chunk": 64, "overlaps": (24, 40, 64)}])
def test_counts_are_the_librarys(spark, how):
    rng = random.Random(1)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(1, 200))) for _ in range(150)]
    texts += [None, "", "a" * 3000, " " * 2000, "<|endoftext|>" * 200, "é" * 2000 + " x " * 100]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in K.count_tokens(docs, BYTE_BPE, **how).collect()}
    assert got == {i: (len((t or "").encode()), n) for i, (t, n) in enumerate(zip(texts, _want(texts), strict=True))}


def test_query_over_the_table(spark):
    from mailsync.llm.queries import QUERIES
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    got = {r.doc_id: (r.n_tokens, r.over_limit) for r in QUERIES["op2_token_counts"](spark, SF_SMALL).collect()}
    assert got == {r.doc_id: (n, n > 512) for r, n in zip(rows, _want([r.text for r in rows]), strict=True)}


def test_edges(edge_docs, no_docs):
    rows = edge_docs.collect()
    got = sorted(r.n_tokens for r in K.count_tokens(edge_docs, BYTE_BPE, huge_chars=5000, chunk=2000).collect())
    assert got == sorted(_want([r.text for r in rows]))
    assert K.count_tokens(no_docs, BYTE_BPE).collect() == []


def test_cache_generations():
    calls = []
    cache = K.SpanCache(lambda xs: calls.append(list(xs)) or [len(x) for x in xs], most=8)
    for words in (["a", "bb"], ["ccc", "a", "d", "e"], ["f", "g", "a"], ["y" * 100, "a"], ["a"] * 50):
        assert cache.values(words) == [len(w) for w in words]
    assert len(cache.young) <= 4 and "y" * 100 not in cache.young
