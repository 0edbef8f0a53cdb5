"""Dedup of repeated lines, returned as compressed keep bitmaps per document.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends and with A-Z in lower case. Keys
of at least ``MIN_CHARS`` code points found in at least ``MIN_DOCS`` documents lose all their lines
but those of the largest ``doc_id`` that has them.

Plan. One pass over the texts writes one small row per document and distinct long key (16 bytes of
its SHA-256, document, line numbers). These are range-partitioned by hash *and* document, so a key
that a third of all documents share spreads over as many tasks as its rows need, and each partition
is sorted by hash, then document (largest first). A task streams through its partition: the first
occurrence of a hash stays, and its further lines go as soon as a third document is seen; at most
two documents of one hash are held back. Only a partition's first and last hash can continue in
another partition. For these two edges the task returns a count; edges are summed by hash, and the
rows that wait for them are judged by a join. Dropped line numbers then come together per document
as a compressed bitmap; texts move once, when a caller applies the bitmaps.

Edge cases: a null or empty text is one empty line; rows that repeat a ``doc_id`` count as one
document for ``MIN_DOCS`` and each keep their own bitmap; a null ``doc_id`` counts as the smallest; a
key that repeats within a document keeps or loses all of its lines; extra columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailsync.llm.frames import id_text, written

MIN_CHARS = 20
MIN_DOCS = 3
LEAST_ID = -(1 << 63)  # stands for a null doc_id
_STRIP = " \t\n\x0b\x0c\r"
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def line_key(line: str) -> str:
    return line.strip(_STRIP).translate(_LOWER)


def _document_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document and distinct long key with its line numbers, and one with the line count."""
    for batch in batches:
        ids, texts, hashes, numbers, counts = [], [], [], [], []
        for doc_id, text_id, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text_id", "text")), strict=True):
            lines = text.split("\n")
            keys: dict[str, list[int]] = {}
            for n, line in enumerate(lines):
                if len(line) >= MIN_CHARS:
                    key = line_key(line)
                    if len(key) >= MIN_CHARS:
                        keys.setdefault(key, []).append(n)
            ids.extend([doc_id] * (len(keys) + 1))
            texts.extend([text_id] * (len(keys) + 1))
            hashes.append(None)
            hashes.extend(sha256(k.encode()).digest()[:16] for k in keys)
            numbers.append([])
            numbers.extend(keys.values())
            counts.append(len(lines))
            counts.extend([None] * len(keys))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(texts, pa.int64()), pa.array(hashes, pa.binary()),
             pa.array(numbers, pa.list_(pa.int32())), pa.array(counts, pa.int64())],
            ["doc_id", "text_id", "hash", "lines", "n_lines"])


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stream through rows sorted by hash and falling document.

    Returns lines to drop (no hash), lines that wait for the hash's edges (hash, no ``n_docs``), and
    the edges themselves (``n_docs`` and the largest document).
    """
    out: list[tuple] = []
    now, top, docs, seen = None, None, 0, None   # the hash, its first document, documents, the last of them
    held: list[tuple] = []                       # rows of a hash that is not yet known to be in MIN_DOCS documents
    is_first = True                              # the partition's first hash may have begun in another partition

    def flush() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [()] * 5
        out.clear()
        kinds = (pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                          ["hash", "doc_id", "text_id", "lines", "n_docs"])

    for batch in batches:
        for h, doc, text, lines in zip(*(batch.column(c).to_pylist() for c in ("hash", "doc_id", "text_id", "lines")),
                                       strict=True):
            if h != now:
                if now is not None and is_first:
                    out.append((now, top, None, None, docs))
                    is_first = False
                now, top, docs, seen, held = h, doc, 1, doc, []
            elif doc != seen:
                docs, seen = docs + 1, doc
            if is_first:
                out.append((h, doc, text, lines, None))
            elif docs < MIN_DOCS:
                held.append((h, doc, text, lines, None))
            else:
                out.extend((None, d, t, x, None) for _, d, t, x, _ in held if d != top)
                held = []
                out.append((None, doc, text, lines, None))
        yield flush()
    if now is not None:
        out.append((now, top, None, None, docs))
        out.extend(held)
    yield flush()


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        dropped, maps = [], []
        for n, gone in zip(batch.column("n_lines").to_pylist(), batch.column("gone").to_pylist(), strict=True):
            keep = np.ones(n, dtype=bool)
            keep[gone] = False
            dropped.append(n - int(keep.sum()))
            maps.append(zlib.compress(np.packbits(keep).tobytes()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_id"), batch.column("n_lines"), pa.array(dropped, pa.int64()),
             pa.array(maps, pa.binary())], ["doc_id", "text_id", "n_lines", "n_dropped", "keep_bitmap"])


def _keyed(docs: DataFrame) -> DataFrame:
    """Never-null document key, a hash that tells texts of one ``doc_id`` apart, and the whole text."""
    return (id_text(docs).withColumn("text", F.coalesce("text", F.lit("")))
            .select(F.coalesce("doc_id", F.lit(LEAST_ID)).alias("doc_id"), F.xxhash64("text").alias("text_id"), "text"))


def line_bitmaps(docs: DataFrame) -> DataFrame:
    """``doc_id, text_id, n_lines, n_dropped, keep_bitmap`` of every document.

    ``keep_bitmap`` is zlib-compressed, most significant bit first, a set bit for a line that stays.
    """
    lines = written(_keyed(docs).mapInArrow(
        _document_lines, "doc_id long, text_id long, hash binary, lines array<int>, n_lines long"), "op3-lines")
    judged = written(
        lines.filter(F.col("hash").isNotNull()).select("hash", "doc_id", "text_id", "lines")
        .repartitionByRange("hash", F.desc("doc_id")).sortWithinPartitions("hash", F.desc("doc_id"), "text_id")
        .mapInArrow(_judge, "hash binary, doc_id long, text_id long, lines array<int>, n_docs long"), "op3-judged")
    edges = (judged.filter(F.col("n_docs").isNotNull()).groupBy("hash")
             .agg(F.sum("n_docs").alias("total"), F.max("doc_id").alias("top")))
    waiting = (judged.filter(F.col("hash").isNotNull() & F.col("n_docs").isNull()).join(edges, "hash")
               .filter((F.col("total") >= MIN_DOCS) & (F.col("doc_id") != F.col("top"))))
    gone = judged.filter(F.col("hash").isNull()).select("doc_id", "text_id", "lines").union(
        waiting.select("doc_id", "text_id", "lines"))
    per_document = (lines.filter(F.col("hash").isNull()).select("doc_id", "text_id", "lines", "n_lines")
                    .union(gone.withColumn("n_lines", F.lit(None).cast("bigint")))
                    .groupBy("doc_id", "text_id")
                    .agg(F.max("n_lines").alias("n_lines"), F.flatten(F.collect_list("lines")).alias("gone")))
    return per_document.mapInArrow(_bitmaps, "doc_id long, text_id long, n_lines long, n_dropped long, keep_bitmap binary")


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for text, n, bitmap in zip(*(batch.column(c).to_pylist() for c in ("text", "n_lines", "keep_bitmap")), strict=True):
            keep = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=n)
            texts.append(text if keep.all() else "\n".join(x for x, k in zip(text.split("\n"), keep, strict=True) if k))
        ids = [None if d == LEAST_ID else d for d in batch.column("doc_id").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), batch.column("n_lines"), batch.column("n_dropped"), pa.array(texts, pa.string())],
            ["doc_id", "n_lines", "n_dropped", "text"])


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``doc_id, n_lines, n_dropped`` and the text of the lines that stay."""
    return (_keyed(docs).join(bitmaps, ["doc_id", "text_id"])
            .mapInArrow(_apply, "doc_id long, n_lines long, n_dropped long, text string"))
