import random
import re

import numpy as np
import pytest

from conftest import SF_CHECK
from mailsync.llm import near_dup as K
from mailsync.llm.components import components

LAST = (1 << 63) - 1


def brute(rows):
    """``doc_id, n_shingles, component`` of each row by comparing all rows that share a shingle."""
    sets = []
    for _, text in rows:
        words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
        made = [tuple(words[k:k + 5]) for k in range(len(words) - 4)] if len(words) >= 5 else ([tuple(words)] if words else [])
        sets.append(frozenset(made))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    first, where = {}, {}
    for n, s in enumerate(sets):
        if s and s in first:
            parent[find(n)] = find(first[s])
        elif s:
            first[s] = n
            others = set()
            for x in s:
                others.update(where.setdefault(x, []))
                where[x].append(n)
            for m in others:
                if find(m) != find(n) and 100 * len(s & sets[m]) >= 75 * len(s | sets[m]):
                    parent[find(n)] = find(m)
    least = {}
    for n, (doc, _) in enumerate(rows):
        least[find(n)] = min(least.get(find(n), LAST), LAST if doc is None else doc)
    none = lambda x: None if x == LAST else x
    return sorted(((doc, len(s), none(least[find(n)])) for n, ((doc, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def _got(docs):
    return sorted((tuple(r) for r in K.near_duplicates(docs).collect()), key=repr)


def test_components_on_the_table(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    assert _got(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_families_passages_and_borders(spark, monkeypatch):
    monkeypatch.setattr(K, "OPEN_MEMBERS", 6)  # so that small fixtures take the path for large keys
    rng = random.Random(8)
    word = lambda: f"w{rng.randint(0, 5000)}"
    texts = []
    for base_size, copies, edits in ((120, 60, 4), (80, 40, 9), (40, 12, 2)):
        base = [word() for _ in range(base_size)]
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.randint(0, edits)):
                own[rng.randrange(len(own))] = word()
            texts.append(" ".join(own))
    passage = [word() for _ in range(60)]
    texts += [" ".join([*[word() for _ in range(rng.randint(5, 60))], *passage]) for _ in range(80)]
    texts += [" ".join(passage)] * 5 + [" ".join(word() for _ in range(30)) for _ in range(50)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    assert _got(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_pigeonhole_guarantee():
    rng = np.random.default_rng(3)
    one = rng.integers(0, 1 << 16, (200, K.SYMBOLS)).astype(np.uint16)
    other = one.copy()
    for row in other:
        row[rng.choice(K.SYMBOLS, 2 * K.CHUNKS - 1, replace=False)] += 1
    a, b = K.signature_keys(one), K.signature_keys(other)
    assert all(np.intersect1d(x, y).size for x, y in zip(a, b, strict=True))


def test_signature_estimates_similarity():
    rng = np.random.default_rng(4)
    shared, left, right = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (3000, 500, 500))
    both = np.concatenate([shared, left, shared, right])
    signs = K.signatures(both, np.array([0, 3500, 7000]))
    assert (signs[0] == signs[1]).mean() == pytest.approx(0.75, abs=0.15)


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + k) for k in range(1, 90)] + [(7, 7)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, **{100 + k: 100 for k in range(1, 90)}}


def test_edges(edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.select("doc_id", "text").collect()]
    assert _got(edge_docs) == brute(rows)
    left = K.drop_near_duplicates(edge_docs)
    assert left.columns == edge_docs.columns
    assert {r.doc_id for r in left.select("doc_id").collect()} == {c for _, _, c in brute(rows)}
    assert _got(no_docs) == [] and K.drop_near_duplicates(no_docs).collect() == []


def test_rows_that_share_an_id_or_have_none_are_judged_by_their_texts(spark):
    rng = random.Random(12)
    base = [[f"w{rng.randint(0, 9000)}" for _ in range(90)] for _ in range(6)]
    near = lambda n, k: " ".join([*base[n][:k], "edited", *base[n][k + 1:]])
    rows = [(5, near(0, 10)), (9, near(1, 10)), (None, near(0, 50)), (None, near(1, 50)),   # 5 and 9 are near nothing common
            (20, near(2, 10)), (21, near(3, 10)), (30, near(2, 50)), (30, near(3, 50)),     # one id near two documents
            (30, near(4, 10)), (None, near(5, 10)), (None, near(5, 60)), (None, None), (None, near(0, 50))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert _got(docs) == brute(rows)
    left = sorted((tuple(r) for r in K.drop_near_duplicates(docs).collect()), key=repr)
    alone = [r for r in rows if r in {(5, near(0, 10)), (9, near(1, 10)), (20, near(2, 10)), (21, near(3, 10)), (30, near(4, 10)), (None, None)}]
    one = [r for r in left if r[0] is None and r[1] is not None]  # two near-copies without an id: one stays
    assert sorted([*alone, *one], key=repr) == left and len(one) == 1 and one[0] in rows[9:11]


def test_counts_of_streamed_shingles(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(K, "MOST_DF", 5)
    rng = random.Random(2)
    for _ in range(200):
        sizes = [rng.choice([1, 1, 2, 4, 5, 6, 30]) for _ in range(rng.randint(0, 12))]
        shingles = np.repeat(np.arange(len(sizes)), sizes).astype(np.int64)
        cuts = sorted(rng.randint(0, len(shingles)) for _ in range(4))
        batches = [pa.RecordBatch.from_arrays([pa.array(part)] * 2, ["id", "shingle"]) for part in np.split(shingles, cuts)]
        got = [(r["id"], r["shingle"], r["df"]) for b in K._rare(iter(batches)) for r in b.to_pylist()]
        assert [x for x in got if x[0] is not None] == [(k, k, size) for k, size in enumerate(sizes) if 1 < size <= 5 for _ in range(size)]
        assert {x[1:] for x in got if x[0] is None} == {(k, 6) for k, size in enumerate(sizes) if size > 5}


@pytest.mark.parametrize("sent", [0, 500_000])
def test_prefixes_keep_one_order(spark, monkeypatch, sent):
    monkeypatch.setattr(K, "MOST_DF", 3)
    monkeypatch.setattr(K, "MOST_SENT", sent)
    rng = np.random.default_rng(5)
    sets = [np.unique(np.concatenate([rng.integers(0, 12, 8), rng.integers(100, 160, 12), rng.integers(1000, 90000, 10)])) for _ in range(40)]
    frame = spark.createDataFrame([(k, 0, bytearray(x.astype(np.int64).tobytes())) for k, x in enumerate(sets)], "id long, component long, shingles binary")
    df = {x: sum(x in s for s in map(set, sets)) for x in {int(v) for s in sets for v in s}}
    for r in K._prefixes(frame).collect():
        order = sorted(map(int, sets[r.id]), key=lambda x: (min(df[x], 4), x))
        n = len(order)
        alone = sum(df[x] == 1 for x in order)
        assert (r.n, r.skipped, r.prefix) == (n, alone, order[alone:n - -(-75 * n // 100) + 1])
