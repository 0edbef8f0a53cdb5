import random
from zlib import crc32

import numpy as np
import pytest

from conftest import SF_SMALL
from llm.conftest import WORD_BPE
from mailsync.llm import packing as K
from mailsync.llm.tokens import tokenizer


def _pieces(rows, capacity=4096):
    out = {}
    for n, (doc, text) in enumerate(rows):
        ids = np.array([*tokenizer(WORD_BPE).encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at:at + capacity]
            out.setdefault((doc, piece, at, len(part), crc32(part.tobytes())), []).append(n)
    return sorted(((k, len(v)) for k, v in out.items()), key=repr)


def _check(rows, capacity):
    """Sequences are filled from 0 without gaps up to the capacity; returns their number."""
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_bounds_and_best_fit_on_small_cases():
    rng = np.random.default_rng(2)

    def optimum(items, capacity):
        best = len(items)

        def go(i, bins):
            nonlocal best
            if len(bins) >= best:
                return
            if i == len(items):
                best = len(bins)
                return
            for k in range(len(bins)):
                if bins[k] + items[i] <= capacity:
                    go(i + 1, [*bins[:k], bins[k] + items[i], *bins[k + 1:]])
            go(i + 1, [*bins, items[i]])
        go(0, [])
        return best

    certified = 0
    for _ in range(150):
        items = rng.integers(1, 21, rng.integers(1, 9))
        bins, offsets = K.best_fit_decreasing(items, 20)
        bound, true, made = K.bin_lower_bound(items, 20), optimum(sorted(items.tolist(), reverse=True), 20), bins.max() + 1
        assert bound <= true <= made and (np.bincount(bins, weights=items) <= 20).all()
        certified += bound == made
    assert certified > 100


def test_pieces_are_the_librarys(spark, edge_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.select("doc_id", "text").collect()]
    got = {}
    for r in K.token_pieces(edge_docs, WORD_BPE).collect():
        got[tuple(r)] = got.get(tuple(r), 0) + 1
    assert sorted(got.items(), key=repr) == _pieces(rows)


def test_plain_words_go_straight_to_the_model(monkeypatch):
    coder, whole = tokenizer(WORD_BPE), []

    class Counting:
        def __getattr__(self, name):
            return getattr(coder, name)

        def encode_batch_fast(self, texts, **how):
            whole.extend(texts)
            return coder.encode_batch_fast(texts, **how)
    monkeypatch.setattr(K, "tokenizer", lambda path: Counting())
    letters = [chr(c) for c in range(0x41, 0x100) if chr(c).isalpha() and chr(c) not in "ªµº"]
    marks = [chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum()]
    rng = random.Random(5)
    plain = [a + b for a in letters for b in ["", *marks]] + ["A" * 64, "it'''", "a<|", "z|>"]
    plain += ["".join(rng.choices(letters, k=rng.randint(1, 14)) + rng.choices(marks, k=rng.randint(0, 4))) for _ in range(3000)]
    odd = ["A" * 5000, "z" + "." * 50, "<|endoftext|>", "A<|endoftext|>,", "it's", "IT'S.", "'s", "H\u0331", "A\u0301,",
           "\u00c9\u0301,", "\u0130,", "\u212a", "\u03a3\u03a3,", "\ufb01", "\u017f", "\u00aa", "\u00b5", "\u00d7", "\u00a0",
           "A\u00a0b", "\u0001", "\u001c", "a1", "1,2", "...", "e\u0327\u0301", "\u65e5\u672c,", "a\u0338"]
    odd += ["".join(rng.choices([*letters, *marks, *odd], k=rng.randint(1, 6))) + "7" for _ in range(2000)]
    got = K._word_ids.__wrapped__(WORD_BPE).values([w.encode() for w in plain + odd])
    assert got == [np.array(e.ids, "<u4").tobytes() for e in coder.encode_batch(plain + odd, add_special_tokens=False)]
    assert sorted(whole) == sorted(set(odd))


@pytest.mark.parametrize("group", [16_384, 60])
def test_packing_is_whole_and_tight(spark, group):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    pieces = K.token_pieces(docs, WORD_BPE).collect()
    rows = K.pack(spark.createDataFrame(pieces, K.PIECE_SCHEMA), group=group).collect()
    assert sorted(tuple(r)[:5] for r in rows) == sorted(tuple(r) for r in pieces)
    made, least = _check(rows, K.CAPACITY), K.bin_lower_bound(np.array([r.length for r in pieces]), K.CAPACITY)
    assert made == least if group > 1000 else made <= least + 5


def test_exchange_needs_fewer_sequences_than_one_round(spark):
    rng = np.random.default_rng(7)
    rows = [(i, 0, 0, int(n), 0) for i, n in enumerate(rng.integers(900, 2100, 1500))]
    pieces = spark.createDataFrame(rows, K.PIECE_SCHEMA)
    once, more = (_check(K.pack(pieces, group=64, rounds=r).collect(), K.CAPACITY) for r in (1, 4))
    assert more < once


def test_edges(edge_docs, no_docs):
    rows = K.pack_documents(edge_docs, WORD_BPE).collect()
    _check(rows, K.CAPACITY)
    assert len(rows) == K.token_pieces(edge_docs, WORD_BPE).count()
    assert K.pack_documents(no_docs, WORD_BPE).collect() == []
