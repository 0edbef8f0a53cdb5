import itertools
import zlib

import numpy as np
import pytest

from conftest import SF_CHECK
from mailsync.llm import language as K


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(0)
    for _ in range(40):
        counts = rng.integers(0, 8, 5)
        offsets = np.concatenate([[0], np.cumsum(counts)])
        scores = rng.normal(size=(offsets[-1], 3)).astype(np.float32)
        labels = K.viterbi(scores, offsets, 1.3)
        for d in range(5):
            part = scores[offsets[d]:offsets[d + 1]]
            value = lambda p, part=part: (sum(part[i, k] for i, k in enumerate(p))
                                          - 1.3 * sum(a != b for a, b in zip(p, p[1:], strict=False)))
            if len(part):
                best = max(map(value, itertools.product(range(3), repeat=len(part))))
                assert value(labels[offsets[d]:offsets[d + 1]]) == pytest.approx(best, abs=1e-4)


@pytest.fixture(scope="module")
def table(spark):
    return spark.read.parquet(f"{SF_CHECK}/documents.parquet")


@pytest.fixture(scope="module")
def model(table):
    return K.fit(table.filter("crc32(cast(doc_id as string)) % 5 != 0"))


def test_held_out_accuracy(table):
    rows = K.predict_languages(table).collect()
    lang = {r.doc_id: r.lang for r in table.collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(held) > 150 and np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_mixed_texts_get_spans(table, model):
    by = {x: " ".join(table.filter(f"lang = '{x}' and length(text) > 800").first().text[:700].split()) for x in ("en", "de")}
    text = f"{by['en']} {by['de']} {by['en']}"
    spans = K.label_spans([text, ""], model)
    assert [x[2] for x in spans[0]] == ["en", "de", "en"] and spans[1] == []
    assert abs(spans[0][1][0] - len(by["en"])) < 60 and abs(spans[0][1][1] - len(by["en"]) - len(by["de"])) < 60


def test_scripts_narrow_candidates(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("привет мир как дела", "ru"), ("hello world how are you", "en")] * 20)]
    model = K.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert [s[0][2] for s in K.label_spans(["дом", "zzzz"], model)] == ["ru", "en"]


def test_long_texts_are_scored_in_parts(model, monkeypatch):
    text = "the of and to in is that " * 400 + "x" * 500
    whole = K._judge([text, "of the", ""], model)
    monkeypatch.setattr(K, "BLOCK_CHARS", 300)
    parts = K._judge([text, "of the", ""], model)
    assert parts[0].argmax(axis=1).tolist() == whole[0].argmax(axis=1).tolist() and parts[0].sum() == whole[0].sum()


def test_spans_leave_the_operator(spark, model, monkeypatch):
    texts = ["the of and to in is", "", None, "  1 the der und die das of ", "x" * 50, "der und die " * 30 + "the of and " * 30]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    whole = {r.doc_id: r for r in K.identify(docs, model).collect()}
    for n, text in enumerate(texts):
        assert [tuple(x) for x in whole[n].spans] == K.label_spans([text or ""], model)[0] and whole[n].n_spans == len(whole[n].spans)
    monkeypatch.setattr(K, "BLOCK_CHARS", 100)  # spans keep their places in the whole text, also where it is scored in parts
    _, parts = K._judge([t or "" for t in texts], model)
    assert [[(x["start"], x["end"], x["lang"]) for x in spans] for spans in parts.to_pylist()] == K.label_spans([t or "" for t in texts], model)


def test_edges(spark, edge_docs, no_docs):
    rows = K.predict_languages(edge_docs).collect()
    learned = {r.lang for r in edge_docs.select("lang").collect()} | {K.UNDETERMINED}
    assert len(rows) == edge_docs.count() and {r.lang_pred for r in rows} <= learned
    letters = {r.doc_id: any(c.isalpha() for c in r.text or "") for r in edge_docs.select("doc_id", "text").collect() if r.doc_id}
    assert all((r.lang_pred == K.UNDETERMINED) == (not letters[r.doc_id]) for r in rows if r.doc_id)
    assert K.predict_languages(no_docs).collect() == []
    unlabelled = spark.createDataFrame([(1, "a b c", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in K.predict_languages(unlabelled).collect()] == [(K.UNDETERMINED, 0.0)]
