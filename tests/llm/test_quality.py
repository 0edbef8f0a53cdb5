import re
from collections import Counter

import numpy as np
import pytest

from conftest import SF_CHECK
from mailsync.llm import quality as K


def base(text):
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed`` by brute force."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    three = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {k + j for k in range(len(words) - 2) if three[tuple(words[k:k + 3])] > 1 for j in range(3)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


COUNTS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_base_counts_and_verdicts_on_labelled_documents(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    rows = {r.doc_id: r for r in K.quality_rules(docs).collect()}
    assert {i: tuple(r[c] for c in COUNTS[1:]) for i, r in rows.items()} == {r.doc_id: base(r.text) for r in docs.collect()}
    assert not any(r.kept and r.base_failed for r in rows.values())
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_CHECK}/labels.parquet").collect()}
    good = [rows[i].kept for i, q in labels.items() if q == 1 and not rows[i].base_failed]
    bad = [rows[i].kept for i, q in labels.items() if q == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.15


def test_references_cover_all_documents(spark):
    rows = [(i, "alpha beta gamma " * 200, "en", "s", 1) for i in range(3)] + [(9, "delta", "xx", "s", 1), (10, "delta", None, "s", 1)]
    found = K.language_references(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))
    assert set(found) == {"en", K.ALL}  # xx has too few words for a reference of its own
    classes, common, shares = found["en"]
    assert classes[K.CLASSES.index("lower")] == 1.0 and len(common) == 3 and shares[:3] == pytest.approx([1 / 3] * 3)
    assert found[K.ALL][2].sum() == pytest.approx(1.0) and len(found[K.ALL][1]) == 4


def test_distance_is_jensen_shannon():
    p, q = np.array([[3.0, 1.0, 0.0], [0.0, 0.0, 0.0]]), np.array([0.25, 0.25, 0.5])
    m = (p[0] / 4 + q) / 2
    kl = lambda a, b: sum(x * np.log2(x / y) for x, y in zip(a, b, strict=True) if x)
    assert K.js_distance(p, q) == pytest.approx([np.sqrt((kl(p[0] / 4, m) + kl(q, m)) / 2), 0.0])


def test_edges(edge_docs, no_docs):
    rows = K.quality_rules(edge_docs).select(*COUNTS, "kept").collect()
    assert sorted((tuple(r)[:7] for r in rows), key=repr) == sorted(
        ((r.doc_id, *base(r.text)) for r in edge_docs.select("doc_id", "text").collect()), key=repr)
    kept = K.good_documents(edge_docs)
    assert kept.columns == edge_docs.columns and kept.count() == sum(r.kept for r in rows)
    assert K.quality_rules(no_docs).collect() == [] and K.good_documents(no_docs).collect() == []
