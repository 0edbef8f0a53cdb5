import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK
from mailsync.llm import mixing as K


def test_raked_words_meet_the_targets(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    rows = K.mix(docs).collect()
    words = sum(r.n_words for r in rows)
    expected = sum(r.n_words * r.probability for r in rows)
    for margin in K.MARGINS:
        own, mixed = {}, {}
        for r in rows:
            own[r[margin]] = own.get(r[margin], 0) + r.n_words
            mixed[r[margin]] = mixed.get(r[margin], 0) + r.n_words * r.probability
        powers = {k: (n / words) ** K.POWER for k, n in own.items()}
        for k in own:
            assert mixed[k] / expected == pytest.approx(powers[k] / sum(powers.values()), rel=0.02)
    assert max(r.probability for r in rows) == 1.0
    kept = sum(r.n_words for r in rows if r.kept)
    assert kept == pytest.approx(expected, rel=0.1)


@pytest.mark.parametrize("local", [True, False])
def test_given_targets(spark, monkeypatch, local):
    if not local:
        monkeypatch.setattr(K, "MOST_LOCAL_CELLS", 0)
    cells = spark.createDataFrame([("a", "x", 30), ("a", "y", 10), ("b", "x", 20), ("b", "y", 40)], "source string, lang string, n long")
    want = {"source": {"a": 50.0, "b": 50.0}, "lang": {"x": 80.0, "y": 20.0}}
    found = K.calibrate(cells, {m: spark.createDataFrame(list(t.items()), f"{m} string, target double") for m, t in want.items()}, 0.3)
    n = {("a", "x"): 30, ("a", "y"): 10, ("b", "x"): 20, ("b", "y"): 40}
    mass = {(r.source, r.lang): r.probability * n[r.source, r.lang] for r in found.collect()}
    assert all(r.margins_met for r in found.collect())
    assert sum(mass.values()) == pytest.approx(30, rel=0.002)
    assert sum(v for k, v in mass.items() if k[0] == "a") == pytest.approx(15, rel=0.002)
    assert sum(v for k, v in mass.items() if k[1] == "x") == pytest.approx(24, rel=0.002)
    odds = mass["a", "x"] * mass["b", "y"] / (mass["a", "y"] * mass["b", "x"])  # raking keeps the odds ratio
    assert odds == pytest.approx(30 * 40 / (10 * 20))


def test_both_ways_of_raking_agree(spark, monkeypatch):
    rng = random.Random(6)
    cells = [(f"s{i}", f"l{j}", f"t{k}", rng.choice([0, 1, 50, 3000, 100000])) for i in range(6) for j in range(4) for k in range(3) if rng.random() < 0.8]
    frame = spark.createDataFrame(cells, "source string, lang string, topic string, n long")
    targets = {m: K.tempered(frame, m, 0.7) for m in K.MARGINS}
    one = {tuple(r)[:3]: r[3:] for r in K.calibrate(frame, targets).collect()}
    monkeypatch.setattr(K, "MOST_LOCAL_CELLS", 0)
    two = {tuple(r)[:3]: r[3:] for r in K.calibrate(frame, targets).collect()}
    assert one.keys() == two.keys() and all(one[k][1] == two[k][1] and one[k][0] == pytest.approx(two[k][0], abs=1e-9) for k in one)


def test_edges(spark, edge_docs, no_docs):
    rows = K.mix(edge_docs).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r.probability <= 1 for r in rows)
    assert {r.source for r in rows if r.doc_id == 4} == {K.NULL_VALUE}
    left = K.sample_mix(edge_docs)
    assert left.columns == edge_docs.columns and left.count() == sum(r.kept for r in rows)
    assert K.mix(no_docs).collect() == [] and K.sample_mix(no_docs).collect() == []
    blank = spark.createDataFrame([(1, None, "en", "s"), (2, " ", "en", "s")], "doc_id long, text string, lang string, source string")
    assert [(r.n_words, r.topic) for r in K.mix(blank).collect()] == [(0, "brief")] * 2


def test_uniform_depends_on_the_id_alone(spark):
    rows = spark.range(4000).select(K.uniform(F.col("id")).alias("x")).collect()
    assert 0.47 < sum(r.x for r in rows) / 4000 < 0.53 and len({r.x for r in rows}) == 4000


def _expected(rows):
    """Share of the words that is kept in expectation."""
    return sum(r.n_words * r.probability for r in rows) / sum(r.n_words for r in rows)


def test_a_stray_document_does_not_thin_the_rest(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text", "lang", "source")
    stray = spark.createDataFrame([(-1, "word " * 200, "xx", "stray")], docs.schema)
    rows = K.mix(docs.union(stray)).collect()
    assert [r.probability for r in rows if r.doc_id == -1] == [pytest.approx(1, abs=K.TOLERANCE)]
    assert _expected(rows) == pytest.approx(K.KEEP_SHARE, rel=0.005)
    assert _expected([r for r in rows if r.doc_id != -1]) == pytest.approx(K.KEEP_SHARE, rel=0.01)


def test_rare_cells_are_kept_whole_at_any_size_of_the_rest(spark):
    for times in (1, 1000):
        cells = [("a", "x", 30000 * times), ("a", "y", 10000 * times), ("b", "x", 20000 * times), ("b", "y", 40000 * times), ("c", "z", 200)]
        frame = spark.createDataFrame(cells, "source string, lang string, n long")
        got = K.calibrate(frame, {m: K.tempered(frame, m) for m in ("source", "lang")}, 0.75).collect()
        p = {(r.source, r.lang): r.probability for r in got}
        assert p["c", "z"] == pytest.approx(1, abs=0.002)
        assert sum(n * p[s, v] for s, v, n in cells) / sum(n for *_, n in cells) == pytest.approx(0.75, rel=0.002)


def test_margins_that_can_not_be_met_are_said(spark, caplog):
    frame = spark.createDataFrame([("a", "x", 100), ("b", "y", 100)], "source string, lang string, n long")
    want = {"source": [("a", 150.0), ("b", 50.0)], "lang": [("x", 50.0), ("y", 150.0)]}
    got = K.calibrate(frame, {m: spark.createDataFrame(t, f"{m} string, target double") for m, t in want.items()}, 0.5).collect()
    assert [r.margins_met for r in got] == [False, False]
    docs = spark.createDataFrame([(1, "w " * 900, "en", "s"), (2, "w " * 10, "de", "s"), (3, "w " * 500, "en", "t"), (4, "w", "fr", "u")],
                                 "doc_id long, text string, lang string, source string")
    met = {r.margins_met for r in K.mix(docs, 0.9).collect()}
    K.sample_mix(docs, 0.9)
    assert len(met) == 1 and ("margins are missed" in caplog.text) == (met == {False})
