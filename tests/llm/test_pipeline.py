
import pytest

import corpus_pipeline as P
from conftest import SF_SMALL
from llm.test_exact_dedup import _normal
from llm.test_near_dup import brute as near
from mailsync.llm import mixing, packing, quality
from mailsync.llm.frames import written


@pytest.fixture(scope="module")
def steps(spark):
    """The tables after each stage, the documents first."""
    out = [spark.read.parquet(f"{SF_SMALL}/documents.parquet")]
    for name, stage in P.STAGES:
        out.append(written(stage(spark, out[-1], SF_SMALL), f"test-{name}"))
    return out


def test_stages_are_those_agreed():
    assert [n for n, _ in P.STAGES] == ["quality_rules", "exact_dedup", "near_dedup", "mixing", "packing"]


def test_columns_stay_until_the_last_stage(steps):
    assert all(s.columns == steps[0].columns for s in steps[1:-1])


def test_every_stage_does_its_work_on_its_input(spark, steps):
    ids = [[r.doc_id for r in s.select("doc_id").collect()] for s in steps]
    texts = {r.doc_id: r.text for r in steps[0].collect()}
    verdict = {r.doc_id: r.kept for r in quality.quality_rules(steps[0]).collect()}
    assert sorted(ids[1]) == sorted(i for i in ids[0] if verdict[i])
    first = {}
    for i in sorted(ids[1]):
        first.setdefault(_normal(texts[i]), i)
    assert sorted(ids[2]) == sorted(first.values())
    assert sorted(ids[3]) == sorted({c for _, _, c in near([(i, texts[i]) for i in ids[2]])})
    kept = {r.doc_id for r in mixing.mix(steps[3]).collect() if r.kept}
    assert sorted(ids[4]) == sorted(kept) and kept
    pieces = packing.token_pieces(steps[4], P.public_tokenizers.path("word_bpe_49k.json"))
    assert sorted(map(tuple, pieces.collect())) == sorted(map(tuple, steps[5].select(*pieces.columns).collect()))


def test_run_is_the_stages_in_order(spark, steps):
    got = sorted(map(tuple, P.run(spark, SF_SMALL).select("doc_id", "piece", "length").collect()))
    assert got == sorted(map(tuple, steps[-1].select("doc_id", "piece", "length").collect()))


def test_edge_rows_of_every_stage(spark, edge_docs, no_docs):
    stages = dict(P.STAGES)
    ids = lambda df: sorted((r.doc_id for r in df.select("doc_id").collect()), key=lambda x: (x is None, x))
    good = written(stages["quality_rules"](spark, edge_docs, SF_SMALL), "test-edge")
    verdict = sorted(((r.doc_id, r.kept) for r in quality.quality_rules(edge_docs).collect()), key=repr)
    assert good.columns == edge_docs.columns
    assert ids(good) == sorted((i for i, kept in verdict if kept), key=lambda x: (x is None, x))
    assert not {3, 4, 5, 7, 8} & set(ids(good))  # null, empty, blank, one word, three words
    once = written(stages["exact_dedup"](spark, edge_docs, SF_SMALL), "test-edge")
    texts = [(r.doc_id, _normal(r.text)) for r in edge_docs.select("doc_id", "text").collect()]
    assert ids(once) == sorted((min((d for d, t in texts if t == text and d is not None), default=None) for text in {t for _, t in texts}),
                               key=lambda x: (x is None, x))
    apart = written(stages["near_dedup"](spark, once, SF_SMALL), "test-edge")
    rows = [(r.doc_id, r.text) for r in once.select("doc_id", "text").collect()]
    assert set(ids(apart)) == {c for _, _, c in near(rows)} and apart.columns == edge_docs.columns
    mixed = written(stages["mixing"](spark, apart, SF_SMALL), "test-edge")
    assert ids(mixed) == ids(mixing.mix(apart).filter("kept"))
    pieces = stages["packing"](spark, edge_docs, SF_SMALL)
    assert sorted(r.length for r in pieces.collect() if r.doc_id in (3, 4)) == [1, 1]
    assert {r.doc_id for r in pieces.collect()} == set(ids(edge_docs))
    for name, stage in P.STAGES:
        assert stage(spark, no_docs, SF_SMALL).collect() == [], name
