import random
import re

import numpy as np
import pytest
import xxhash

from conftest import SF_CHECK
from mailsync.llm import simhash as H


def print_of(text):
    lower = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    words = re.findall(rb"[^\x20\x09-\x0D]+", lower)
    shingles = [b" ".join(words[k:k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for k in range(64):
            counts[k] += h >> k & 1
    return sum(1 << k for k in range(64) if 2 * counts[k] > len(shingles))


def groups(fps):
    """Root of every fingerprint by comparing all pairs."""
    fps = np.array(sorted(set(fps)), np.uint64)
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a in range(len(fps)):
        for b in np.flatnonzero(np.bitwise_count(fps[a] ^ fps[a + 1:]) <= 4) + a + 1:
            parent[find(int(b))] = find(a)
    return {int(fps[k]): find(k) for k in range(len(fps))}


def brute(rows):
    fps = [print_of(text) for _, text in rows]
    root, least = groups(fps), {}
    for (doc, _), fp in zip(rows, fps, strict=True):
        if doc is not None:
            least[root[fp]] = min(least.get(root[fp], doc), doc)
    return sorted(((doc, f"{fp:016x}", least.get(root[fp])) for (doc, _), fp in zip(rows, fps, strict=True)), key=repr)


def _got(docs):
    return sorted((tuple(r) for r in H.simhash_duplicates(docs).collect()), key=repr)


def test_table(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    assert _got(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_edges(spark, edge_docs, no_docs):
    assert _got(no_docs) == []
    assert _got(edge_docs) == brute([(r.doc_id, r.text) for r in edge_docs.collect()])


def test_near_copies(spark):
    rng = random.Random(4)
    rows = []
    for k in range(300):
        base = [f"w{rng.randint(0, 3000)}" for _ in range(150)] if k % 30 == 0 else base
        own = list(base)
        for _ in range(rng.randint(0, 3)):
            own[rng.randrange(len(own))] = f"w{rng.randint(0, 3000)}"
        rows.append((k, "  ".join(own).upper() if k % 5 == 0 else "\t".join(own)))
    want = brute(rows)
    assert 10 <= len({c for _, _, c in want}) < 200
    assert _got(spark.createDataFrame(rows, "doc_id long, text string")) == want


@pytest.mark.parametrize("most", [16, 16384])
def test_all_links_of_clusters(spark, most):
    rng, fps = random.Random(3), set()
    for _ in range(8):
        base = rng.getrandbits(64)
        for _ in range(120):
            fp = base
            for _ in range(rng.randint(0, 8)):
                fp ^= 1 << rng.randrange(64)
            fps.add(fp)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    links = H.fingerprint_links(spark.createDataFrame([(signed(x),) for x in fps], "fp long"), most).distinct().collect()
    parent = {x: x for x in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in links:
        u, v = r.u % (1 << 64), r.v % (1 << 64)
        assert (u ^ v).bit_count() <= 4
        parent[find(u)] = find(v)
    as_sets = lambda root: {frozenset(x for x in fps if root(x) == r) for r in {root(x) for x in fps}}
    assert as_sets(find) == as_sets(groups(fps).__getitem__)


def test_chain_budgets_lose_no_pair():
    assert H.CHAIN == [(3, 0), (7, 1), (11, 2), (15, 3)]
    rng = np.random.default_rng(9)
    for _ in range(300):
        a = np.uint64(rng.integers(0, 1 << 63))
        b = a
        for k in rng.choice(64, rng.integers(0, 5), replace=False):
            b ^= np.uint64(1) << np.uint64(k)
        assert a == b or any(len(H.spanning_links(np.array([a, b]), start)[0]) for start in range(H.SEGMENTS))
