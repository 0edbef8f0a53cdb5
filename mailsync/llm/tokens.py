"""Token counts and token ids exactly as the ``tokenizers`` library gives them.

Encoding is the costly part and most words recur, so a worker encodes each distinct *span* of text
once and keeps the result in a bounded cache. Texts are cut only where the library's own splitting
is bound to cut, so the parts' tokens laid end to end are the whole text's tokens.

Counting (``count_tokens``, byte-level BPE). Documents up to ``HUGE_CHARS`` are cut before each
single blank between two non-blank characters: no alternative of the pattern matches across such a
place and none looks back over it. Longer documents become one row per chunk, spread over all
tasks. A chunk of ``CHUNK_CHARS`` also covers the next ``overlap`` characters. It is encoded with
offsets, and two neighbours are spliced at the first place in their overlap where both begin a new
pre-token. Such a place is proven stable: splitting runs left to right without looking back, so
from there on both give the same tokens, provided that it is ``SETTLED`` characters before the
first chunk's end, where neither a longer run nor a special token can change it. Documents with a
pair of chunks that never aligns are taken again with wider overlaps (``OVERLAPS``, the last as wide
as a chunk), and what still fails (one run longer than a chunk) is encoded whole.

Edge cases: a null or empty text has 0 bytes and 0 tokens; rows that repeat a ``doc_id``, or have none, are counted
each; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mailsync.llm.frames import id_text, written

HUGE_CHARS = 1 << 16
CHUNK_CHARS = 1 << 14
OVERLAPS = (256, 2048, CHUNK_CHARS)
SETTLED = 16           # longer than any special token of the vocabulary
CACHE_SPANS = 1_000_000  # spans kept by a worker, in two generations (under 200 MB)
CACHE_CHARS = 64       # longer spans are encoded each time
_CUT = re.compile(r"(?<=\S)(?= \S)")


@lru_cache(maxsize=2)
def tokenizer(path: str):
    """The tokenizer of a file, loaded once per worker, on one thread."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


class SpanCache:
    """Values of text spans; when full, the younger generation becomes the older one."""

    def __init__(self, encode: Callable[[list], list], most: int = CACHE_SPANS):
        self.encode, self.half = encode, max(1, most // 2)
        self.young: dict = {}
        self.old: dict = {}

    def values(self, spans: list) -> list:
        found = list(map(self.young.get, spans))
        missed = {x for x, v in zip(spans, found, strict=True) if v is None}
        if not missed:
            return found
        late = {x: self.old[x] for x in missed if x in self.old}
        new = [x for x in missed if x not in late]
        late.update(zip(new, self.encode(new), strict=True))
        if len(self.young) + len(late) > self.half:
            self.old, self.young = self.young, {}
        self.young.update((x, v) for x, v in late.items() if len(x) <= CACHE_CHARS)
        return [late[x] if v is None else v for x, v in zip(spans, found, strict=True)]


@lru_cache(maxsize=2)
def _lengths(path: str) -> SpanCache:
    coder = tokenizer(path)
    return SpanCache(lambda spans: [len(e.ids) for e in coder.encode_batch_fast(spans, add_special_tokens=False)])


def _count_whole(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = _lengths(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([sum(lengths.values(_CUT.split(t))) for t in texts], pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"])
    return run


def _chunk_marks(path: str, overlap: int, chunk: int) -> Callable:
    """Per chunk: its tokens, and where pre-tokens begin in its first and last ``overlap`` characters."""
    marks = pa.list_(pa.struct([("pos", pa.int64()), ("n", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer(path)
        for batch in batches:
            tokens, lefts, rights = [], [], []
            for place, text in zip(batch.column("place").to_pylist(), batch.column("text").to_pylist(), strict=True):
                base = place * chunk
                found = coder.encode(text, add_special_tokens=False)
                owners, last = found.word_ids, object()
                left, right = [], []
                for n, (begin, _) in enumerate(found.offsets):
                    if owners[n] is not None and owners[n] == last:
                        continue
                    last = owners[n]
                    if begin <= overlap:
                        left.append({"pos": base + begin, "n": n})
                    if chunk <= begin <= len(text) - SETTLED:
                        right.append({"pos": base + begin, "n": n})
                tokens.append(len(owners))
                lefts.append(left)
                rights.append(right)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("place"), pa.array(tokens, pa.int64()), pa.array(lefts, marks),
                 pa.array(rights, marks)], ["row", "place", "n_tokens", "lefts", "rights"])
    return run


def _splice(huge: DataFrame, path: str, overlap: int, chunk: int) -> DataFrame:
    """``row, n_tokens`` of each huge document; null where two neighbouring chunks never align."""
    starts = F.expr(f"sequence(0L, (char_length(text) - 1) div {chunk})")
    chunks = (huge.select("row", "text", F.explode(starts).alias("place"))
              .select("row", "place", F.expr(f"substring(text, int(place * {chunk} + 1), {chunk + overlap})").alias("text"))
              .repartition("row", "place"))
    marked = chunks.mapInArrow(_chunk_marks(path, overlap, chunk),
                               "row long, place long, n_tokens long, lefts array<struct<pos:long,n:long>>, "
                               "rights array<struct<pos:long,n:long>>")
    order = Window.partitionBy("row").orderBy("place")
    pairs = (marked.withColumn("before", F.lag("rights").over(order))
             .withColumn("last", F.lead("place").over(order).isNull())
             .withColumn("common", F.expr("get(filter(lefts, x -> exists(before, y -> y.pos = x.pos)), 0)"))
             .withColumn("earlier", F.expr("get(filter(before, y -> y.pos = common.pos), 0).n")))
    step = F.when(F.col("place") == 0, F.lit(0)).otherwise(F.col("earlier") - F.col("common.n"))
    return (pairs.groupBy("row")
            .agg(F.sum(step + F.when(F.col("last"), F.col("n_tokens")).otherwise(F.lit(0))).alias("n_tokens"),
                 F.bool_or((F.col("place") > 0) & F.col("common").isNull()).alias("failed"))
            .select("row", F.when(~F.col("failed"), F.col("n_tokens")).alias("n_tokens")))


def count_tokens(docs: DataFrame, path: str, huge_chars: int = HUGE_CHARS, chunk: int = CHUNK_CHARS,
                 overlaps: tuple[int, ...] = OVERLAPS) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of every whole text; ``path`` is the tokenizer's file."""
    schema = "doc_id long, n_bytes long, n_tokens long"
    texts = (id_text(docs).withColumn("text", F.coalesce("text", F.lit("")))
             .withColumn("n_bytes", F.octet_length("text").cast("bigint")))
    is_huge = F.char_length("text") > huge_chars
    counted = texts.filter(~is_huge).mapInArrow(_count_whole(path), schema)
    huge = written(texts.filter(is_huge).withColumn("row", F.monotonically_increasing_id()), "op2-huge")
    pending = huge
    for overlap in overlaps:
        if pending.isEmpty():
            return counted
        spliced = written(_splice(pending, path, overlap, chunk), "op2-spliced")
        aligned = spliced.filter(F.col("n_tokens").isNotNull())
        counted = counted.union(huge.join(aligned, "row").select("doc_id", "n_bytes", "n_tokens"))
        pending = huge.join(spliced.filter(F.col("n_tokens").isNull()).select("row"), "row", "left_semi")
    return counted.union(pending.select("doc_id", "text", "n_bytes").mapInArrow(_count_whole(path), schema))
