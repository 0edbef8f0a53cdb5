import random
import re
import zlib
from collections import Counter

import pytest

from conftest import SF_SMALL
from mailsync.llm import spelling as S


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return a[k + 1:] == b[k + 1:] if len(a) == len(b) else a[k:] == b[k + 1:]


def brute(rows):
    count = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    words = {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}
    around = {w: [] for w in words}
    by_size = {}
    for w in words:
        by_size.setdefault(len(w), []).append(w)
    for size, some in by_size.items():
        for other in (size, size + 1):
            for a in some:
                for b in by_size.get(other, []):
                    if near(a, b) and (a < b or other > size):
                        around[a].append(b)
                        around[b].append(a)
    form = {}
    for w, found in around.items():
        best = min(found, key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= 10 * words[w]:
            form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(around[w]), words[form[w]] if w in form else None))
    return sorted(out, key=repr)


def _got(docs):
    return sorted((tuple(r) for r in S.spelling_variants(docs).collect()), key=repr)


def test_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert _got(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_edges_chains_and_ties(spark, edge_docs, no_docs):
    assert _got(no_docs) == []
    assert _got(edge_docs) == brute([(r.doc_id, r.text) for r in edge_docs.collect()])
    chain = [("abcdefg", 2), ("abcdefgh", 40), ("abcdefghi", 900), ("zzzzzzzy", 3), ("zzzzzzzx", 70), ("zzzzzzzw", 70),
             ("ÀÉÿþßñx", 4), ("àÉÿþßñx", 3), ("Q" * 5000, 2), ("Q" * 5001, 30), ("Q" * 2500 + "r" + "Q" * 2500, 2)]
    rows = [(None if k % 7 == 0 else k, " ".join([w] * n)) for k, (w, n) in enumerate(chain)]
    assert _got(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


@pytest.mark.parametrize("most", [6, 512])
def test_all_near_pairs_of_dense_lists(spark, most):
    rng = random.Random(1)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(7, 9))) for _ in range(900)}
    words |= {"commonprefix" + a + b for a in "abcdefgh" for b in "abcdefgh"}
    got = [(r.word, r.near) for r in S.near_words(spark.createDataFrame([(w, 2) for w in words], "word string, n long"), most).collect()]
    assert len(got) == len(set(got))
    assert set(got) == {(a, b) for a in words for b in words if near(a, b)}
