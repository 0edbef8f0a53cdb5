import random
import re

import numpy as np
import pyarrow as pa

from mailsync.llm import textbatch as T


def _texts():
    rng = random.Random(4)
    made = ["".join(rng.choice(["a", "B", "b ", " ", "\n", "\t", "é", "日", "cc"]) for _ in range(rng.randint(0, 40)))
            for _ in range(300)]
    return [None, "", " ", "one", *made, None, "end"]


def test_words_and_shingles_match_brute_force():
    texts = _texts()
    raw, offsets = T.text_bytes(pa.array(texts, pa.string()))
    words, at = T.word_hashes(raw, offsets)
    shingles, sat = T.shingle_hashes(words, at)
    by_word, by_shingle = {}, {}
    for i, text in enumerate(texts):
        want = [w.encode().lower() for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
        assert at[i + 1] - at[i] == len(want)
        for w, h in zip(want, words[at[i]:at[i + 1]], strict=True):
            assert by_word.setdefault(w, h) == h
        made = [tuple(want[k:k + 5]) for k in range(len(want) - 4)] if len(want) >= 5 else ([tuple(want)] if want else [])
        assert sat[i + 1] - sat[i] == len(made)
        for s, h in zip(made, shingles[sat[i]:sat[i + 1]], strict=True):
            assert by_shingle.setdefault(s, h) == h
    assert len(set(by_word.values())) == len(by_word) and len(set(by_shingle.values())) == len(by_shingle)


def test_slices_and_blocks():
    column = pa.array(["aa bb", None, "cc", "dd ee ff"], pa.string()).slice(2)
    raw, offsets = T.text_bytes(column)
    assert bytes(raw) == b"ccdd ee ff" and offsets.tolist() == [0, 2, 10]
    assert T.blocks(np.array([0, 5, 6, 30, 31]), 6) == [(0, 2), (2, 3), (3, 4)]
