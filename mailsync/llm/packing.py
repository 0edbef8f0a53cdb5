"""Best-fit packing of tokenised documents, with partitions certified by lower bounds.

``token_pieces`` turns every whole text into token ids followed by the end id, and cuts only what
is longer than a sequence. ``pack`` deals the pieces to partitions of about ``GROUP`` pieces, each
packed by best-fit decreasing. For each partition the largest of two families of dual feasible
functions gives a lower bound of its number of sequences; where the packing meets the bound, it is
certified as optimal and final. Partitions with a gap close their full sequences and release the
pieces of all others; released pieces are exchanged (dealt anew among fewer partitions, which may
hold twice as many pieces in each round, ``GROUP << (ROUNDS - 1)`` at most) and packed again. A
round's packing is taken only if it needs fewer sequences than the one before.

Plan: texts are read once; from then on only rows of a few numbers move. A partition holds a bounded
number of pieces whatever the sizes of sources or documents, as pieces are dealt by row number.

Edge cases: a null or empty text is one piece of length 1 (the end id); an empty table gives an
empty result; rows that repeat a ``doc_id``, or have none, are packed each; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from struct import pack as pack_ids
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailsync.llm.frames import id_text, written
from mailsync.llm.tokens import SpanCache, tokenizer

CAPACITY = 4096
GROUP = 16_384
ROUNDS = 4
END_ID = 1
TAILS = 4096  # kept runs of punctuation
_ACCENTED = "ßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"  # what is left of À-ÿ without × and ÷ in lower case
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]{1,64})([!-/:-@\[-`{-~]{0,16})")  # bounded, as tails are kept
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


@lru_cache(maxsize=2)
def _word_ids(path: str) -> SpanCache:
    """Ids of white-space-free words as little-endian 32-bit bytes.

    The vocabulary's normaliser and pattern never join characters across white space, so a text's
    ids are its words' ids laid end to end. A plain word, some Latin-1 letters and then ASCII
    punctuation if any, needs no normaliser and no pattern either: its lower-cased letters are one pre-token,
    and the library's model is given just that; the rest is another one, and few are distinct. No
    plain word holds a special token, which has letters after punctuation. Other words take the
    library's whole way.
    """
    coder = tokenizer(path)
    forms = str.maketrans({c: coder.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in _ACCENTED})
    split, tokenize = _PLAIN.fullmatch, coder.model.tokenize

    @lru_cache(maxsize=TAILS)
    def tail_ids(tail: str) -> list[int]:
        return coder.encode(tail, add_special_tokens=False).ids

    def encode(words: list[bytes]) -> list[bytes]:
        texts = [w.decode() for w in words]
        plain = list(map(split, texts))
        others = iter(coder.encode_batch_fast([t for t, m in zip(texts, plain, strict=True) if m is None],
                                              add_special_tokens=False))
        out = []
        for m in plain:
            if m is None:
                ids = next(others).ids
            else:
                letters, tail = m.groups()
                letters = letters.lower()
                ids = [t.id for t in tokenize(letters if letters.isascii() else letters.translate(forms))]
                if tail:
                    ids += tail_ids(tail)
            out.append(pack_ids(f"<{len(ids)}I", *ids))
        return out
    return SpanCache(encode)


def _cut_pieces(path: str, capacity: int, end_id: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _word_ids(path)
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = b"".join(words.values((text or "").encode().split())) + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    out.append((doc_id, piece, at // 4, len(part) // 4, crc32(part)))
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The pieces of every document: ``doc_id, piece, start, length, ids_crc32``."""
    return id_text(docs).mapInArrow(_cut_pieces(path, capacity, end_id), PIECE_SCHEMA)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item; an item goes to the fullest bin that still has room for it."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # by room left
    rooms = 0  # bit r is set if a bin with room r is open
    made = 0
    for i in np.argsort(-lengths, kind="stable"):
        size = int(lengths[i])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            chosen = open_bins[room].pop()
            if not open_bins[room]:
                rooms ^= 1 << room
        else:
            room, chosen, made = capacity, made, made + 1
        bins[i], offsets[i] = chosen, capacity - room
        left = room - size
        if left:
            if not open_bins[left]:
                rooms |= 1 << left
            open_bins[left].append(chosen)
    return bins, offsets


def bin_lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """The best bound of two families of dual feasible functions on the number of bins needed."""
    sizes = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    number, total = np.cumsum(sizes), np.cumsum(sizes * np.arange(capacity + 1))
    half, n, best = capacity // 2, len(lengths), 0
    # f_e: items above capacity - e count a whole bin, items below e nothing, others their size
    for e in range(half + 1):
        whole = n - number[capacity - e]
        lower = total[e - 1] if e else 0
        best = max(best, whole + -(-(total[capacity - e] - lower) // capacity))
    # u_k: x if (k + 1) x is a multiple of the capacity, else floor((k + 1) x / capacity) / k of it
    x = np.arange(capacity + 1)
    for k in range(1, 64):
        parts, rest = np.divmod((k + 1) * x, capacity)
        value = np.where(rest == 0, x * k, parts * capacity)  # times k
        best = max(best, -(-int((sizes * value).sum()) // (k * capacity)))
    return int(best)


def _pack_group(capacity: int, round_no: int) -> Callable[[tuple, pd.DataFrame], pd.DataFrame]:
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece", "row"], ascending=[False, True, True, True])
        lengths = rows["length"].to_numpy()
        bins, offsets = best_fit_decreasing(lengths, capacity)
        made = int(bins.max()) + 1
        filled = np.bincount(bins, weights=lengths).astype(np.int64)[bins]
        certified = made == bin_lower_bound(lengths, capacity)
        return rows.drop(columns="grp").assign(
            sequence_id=(round_no << 56) | (int(key[0]) << 24) | bins, offset=offsets,
            final=certified | (filled == capacity))
    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP, rounds: int = ROUNDS) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; ``group`` is the pieces in a partition."""
    numbered = written(pieces.select("doc_id", "piece", "start", "length", "ids_crc32")
                       .withColumn("row", F.monotonically_increasing_id()), "op5-pieces")
    schema = PIECE_SCHEMA + ", row long"
    packed_schema = schema + ", sequence_id long, offset long, final boolean"
    out_columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    loose, settled, before = numbered, None, None
    for round_no in range(rounds):
        groups = max(1, -(-loose.count() // (group << round_no)))
        dealt = loose.select("doc_id", "piece", "start", "length", "ids_crc32", "row",
                             F.pmod(F.xxhash64("row", F.lit(round_no)), F.lit(groups)).alias("grp"))
        packed = written(dealt.groupBy("grp").applyInPandas(_pack_group(capacity, round_no), packed_schema), "op5-packed")
        n = packed.agg(F.count_distinct("sequence_id")).first()[0]
        if before is not None and n >= before:
            continue
        done = packed.filter("final").select(out_columns)
        settled = done if settled is None else settled.union(done)
        loose = packed.filter(~F.col("final"))
        before = loose.agg(F.count_distinct("sequence_id")).first()[0]
        if groups == 1 or before <= 1:
            break
    return settled.union(loose.select(out_columns))


def pack_documents(docs: DataFrame, path: str) -> DataFrame:
    """Every document as pieces in sequences of at most ``CAPACITY`` tokens."""
    return pack(token_pieces(docs, path))
