"""Near-duplicates by SimHash fingerprints, with pigeonring filtering of the candidates.

A document's fingerprint has 64 bits: bit k is one if more than half of its four-word shingles (repeats
counted) have bit k set in their XXH64. Fingerprints link at ``MOST_BITS`` differing bits or fewer.

Pigeonring: the 64 bits are ``SEGMENTS`` segments on a ring. If two fingerprints differ in at most t bits in
all, there is a segment from which every chain of consecutive segments keeps its share of the budget: the
first l segments differ in at most t * l / SEGMENTS bits, for all l at once. (Plain pigeonhole looks at one
segment only.) With 16 segments and 4 bits, a chain has no difference in its first 3 segments, at most one
in 7, two in 11, three in 15. Keys stand for the first two of these: for each of 16 starting segments, the
``HEAD`` segments without one of those in which the one difference may be. Pairs that share a key must keep
the whole chain's budgets before all 64 bits are compared.

Plan:
1. Fingerprints of whole texts in Arrow batches; equal ones collapse to one node, which is the fingerprint
   itself, with its smallest ``doc_id`` (copies are combined before the shuffle).
2. 64 keys a node, as column expressions, shuffled and sorted by Spark once; a key's members stream by in the
   task and are compared there. Only links that join members not yet joined leave it, and members of keys
   with more than ``MOST_MEMBERS`` of them, which pass through unheld.
3. Those are cut by exact pigeonhole on the other bits: of five parts of them at least one is equal in a
   linked pair, so every part's value makes a smaller group; again if need be, until the bits are used up.
   Nothing is capped.
4. Connected components, and the smallest ``doc_id`` of each.

Edge cases: null and empty texts, and texts without words, have the fingerprint zero and are linked like any
other; fewer than four words are one shingle; a null ``doc_id`` counts as the largest and stays null only
where no other row is reachable; rows that repeat a ``doc_id`` are judged each by their own text; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailsync.llm import textbatch as T
from mailsync.llm.components import components
from mailsync.llm.frames import id_text, small_batches, written

SHINGLE_WORDS = 4
SEED = 42
BITS = 64
MOST_BITS = 4
SEGMENTS = 16
SEGMENT = BITS // SEGMENTS
EXACT = (SEGMENTS - 1) // MOST_BITS           # first segments of a chain without a difference
HEAD = (2 * SEGMENTS - 1) // MOST_BITS        # first segments with at most one
MOST_MEMBERS = 16_384
PARTS = MOST_BITS + 1
LAST_ID = (1 << 63) - 1
BLOCK_SHINGLES = 1 << 14


def _chain_budgets() -> list[tuple[int, int]]:
    """(segments, differing bits) at the longest chain of every budget."""
    out = []
    for most in range(MOST_BITS):
        out.append((((most + 1) * SEGMENTS - 1) // MOST_BITS, most))
    return out


CHAIN = _chain_budgets()


def _set_bits(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set."""
    out = np.zeros(BITS, np.int64)
    for s in range(0, len(hashes), BLOCK_SHINGLES):
        block = hashes[s:s + BLOCK_SHINGLES].astype("<u8").view(np.uint8).reshape(-1, 8)
        out += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return out


_BIT = np.uint64(1) << np.arange(BITS, dtype=np.uint64)


def _spans(raw: np.ndarray) -> tuple[bytes, list[int], list[int]]:
    """The words lower-cased and joined by one space, and where every shingle starts and ends in that."""
    space = T.SPACE[raw]
    start = ~space
    start[1:] &= space[:-1]
    end = ~space
    end[:-1] &= space[1:]
    begins, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    if not len(begins):
        return b"", [], []
    keep = ~space
    keep[ends[:-1]] = True
    flat = np.where(space, np.uint8(0x20), T._LOWER[raw])[keep]
    moved = np.cumsum(keep)
    begins, ends = moved[begins] - 1, moved[ends - 1]
    last = max(len(begins) - SHINGLE_WORDS, 0)
    return flat.tobytes(), begins[:last + 1].tolist(), ends[min(SHINGLE_WORDS, len(ends)) - 1:].tolist()


def fingerprint(raw: np.ndarray) -> int:
    """The fingerprint of a text's UTF-8 bytes."""
    text, begins, ends = _spans(raw)
    total, counts = len(begins), np.zeros(BITS, np.int64)
    digest, pairs = xxhash.xxh64_intdigest, zip(begins, ends, strict=True)
    while block := [digest(text[b:e], SEED) for b, e in islice(pairs, BLOCK_SHINGLES)]:
        counts += _set_bits(np.array(block, np.uint64))
    return int(_BIT[2 * counts > total].sum(dtype=np.uint64))


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, at = T.text_bytes(batch.column("text"))
        prints = np.fromiter((fingerprint(raw[s:e]) for s, e in zip(at[:-1], at[1:], strict=True)), np.uint64, len(batch))
        yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(prints.view(np.int64))], ["doc", "fp"])


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _mask(segments: list[int]) -> int:
    """Bits of the segments, as a signed long."""
    return _signed(sum(((1 << SEGMENT) - 1) << (SEGMENT * (s % SEGMENTS)) for s in segments))


# Starting segment of every key, and the bits that it holds equal: the chain's head but for one segment.
PATTERNS = [(start, _mask([start + k for k in range(HEAD) if k != left_out])) for start in range(SEGMENTS) for left_out in range(EXACT, HEAD)]
_LOW = len(PATTERNS) - 1  # the low bits of a key are the number of its pattern


def chain_keys(nodes: DataFrame) -> DataFrame:
    """``key, fp``: every node under each of the patterns."""
    keys = F.array(*[F.xxhash64(F.lit(n), F.col("fp").bitwiseAND(F.lit(mask))).bitwiseAND(F.lit(~_LOW)).bitwiseOR(F.lit(n))
                     for n, (_, mask) in enumerate(PATTERNS)])
    return nodes.select(F.explode(keys).alias("key"), "fp")


def _parts(seen: int) -> list[int]:
    """The bits that are not seen, dealt to ``PARTS`` masks of consecutive bits; none if no bit is left."""
    free = [k for k in range(BITS) if not (seen >> k) & 1]
    return [_signed(sum(1 << int(k) for k in part)) for part in np.array_split(free, PARTS) if len(part)]


def _cut(rows: DataFrame) -> DataFrame:
    """Members ``key, fp, seen`` of large groups in the groups of each part of their other bits."""
    seen = [r.seen for r in rows.select("seen").distinct().collect()]  # masks, a few per pattern: never data
    parts = F.create_map(*[F.lit(x) for s in seen for x in (s, _parts(s & ((1 << BITS) - 1)))])
    each = rows.select("key", "seen", "fp", F.explode(F.element_at(parts, F.col("seen"))).alias("part"))
    key = F.xxhash64("key", "part", F.col("fp").bitwiseAND(F.col("part")))
    return each.select(key.bitwiseAND(F.lit(~_LOW)).bitwiseOR(F.col("key").bitwiseAND(F.lit(_LOW))).alias("key"), "fp",
                       F.col("seen").bitwiseOR(F.col("part")).alias("seen"))


def spanning_links(fps: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all distinct fingerprints that links connect, fewer than there are fingerprints.

    A link keeps the budgets of the chain from ``start`` on and then differs in ``MOST_BITS`` bits or fewer. From
    one fingerprint after the other, those that link to it and were not reached before are reached."""
    masks = [(np.uint64(_mask([start + k for k in range(n)]) & ((1 << BITS) - 1)), most) for n, most in CHAIN]
    us, vs = [], []
    apart = fps  # not reached yet
    while len(apart) > 1:
        waiting, apart = [apart[0]], apart[1:]
        while waiting and len(apart):
            fp = waiting.pop()
            differ = apart ^ fp
            at = np.flatnonzero(np.bitwise_count(differ & masks[0][0]) <= masks[0][1])
            for mask, most in masks[1:]:
                at = at[np.bitwise_count(differ[at] & mask) <= most]
            at = at[np.bitwise_count(differ[at]) <= MOST_BITS]
            if len(at):
                near = apart[at]
                us.append(np.full(len(near), fp))
                vs.append(near)
                waiting.extend(near)
                apart = np.delete(apart, at)
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *us]), np.concatenate([none, *vs])


LINKS = "u long, v long, key long, fp long, seen long"


def _rows(u=(), v=(), key=(), fp=(), seen=()) -> pa.RecordBatch:
    """Links, or members of large groups."""
    n = max(len(u), len(key))
    column = lambda x: pa.array(np.asarray(x, np.int64) if len(x) else [None] * n, pa.int64())
    return pa.RecordBatch.from_arrays([column(x) for x in (u, v, key, fp, seen)], ["u", "v", "key", "fp", "seen"])


def _group_links(keys: np.ndarray, fps: np.ndarray, seen: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    """Links within whole groups of rows in order; groups of more than ``most`` members as they are."""
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sizes = np.diff(np.append(heads, len(keys)))
    us, vs, large = [], [], []
    for head, size in zip(heads[sizes > 1].tolist(), sizes[sizes > 1].tolist(), strict=True):
        if size > most and seen[head] != -1:  # -1: all bits are used up
            large.append(np.arange(head, head + size))
            continue
        u, v = spanning_links(np.unique(fps[head:head + size]).view(np.uint64), PATTERNS[int(keys[head]) & _LOW][0])
        us.append(u.view(np.int64))
        vs.append(v.view(np.int64))
    if us:
        yield _rows(np.concatenate(us), np.concatenate(vs))
    for at in large:
        yield _rows(key=keys[at], fp=fps[at], seen=seen[at])


def _walk(most: int):
    """Groups that arrive in order; at most ``most`` members of the last group are held between batches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.zeros(0, np.int64)] * 3
        passing = None  # the key of a group that is known to be large
        for batch in batches:
            if not len(batch):
                continue
            rows = [batch.column(c).to_numpy() for c in ("key", "fp", "seen")]
            if passing is not None:
                n = int(np.argmax(rows[0] != passing)) if rows[0][-1] != passing else len(batch)
                if n:
                    yield _rows(key=rows[0][:n], fp=rows[1][:n], seen=rows[2][:n])
                rows = [x[n:] for x in rows]
                if not len(rows[0]):
                    continue
                passing = None
            rows = [np.concatenate([x, y]) for x, y in zip(kept, rows, strict=True)]
            cut = len(rows[0]) - int(np.argmax(rows[0][::-1] != rows[0][-1])) if rows[0][0] != rows[0][-1] else 0
            if cut:
                yield from _group_links(*[x[:cut] for x in rows], most)
            kept = [x[cut:] for x in rows]
            if len(kept[0]) > most and kept[2][0] != -1:
                passing = int(kept[0][0])
                yield _rows(key=kept[0], fp=kept[1], seen=kept[2])
                kept = [np.zeros(0, np.int64)] * 3
        if len(kept[0]):
            yield from _group_links(*kept, most)
    return run


def fingerprint_links(nodes: DataFrame, most: int = MOST_MEMBERS) -> DataFrame:
    """Links ``u, v`` among the distinct ``fp`` of ``nodes`` that connect all within ``MOST_BITS`` bits."""
    small_batches(nodes.sparkSession)
    by_pattern = F.create_map(*[F.lit(x) for n, (_, mask) in enumerate(PATTERNS) for x in (n, mask)])
    rows, links = chain_keys(nodes), None
    while True:
        dealt = rows.repartition("key").sortWithinPartitions("key")
        if "seen" not in rows.columns:  # the key says it: not shuffled
            dealt = dealt.withColumn("seen", F.element_at(by_pattern, F.col("key").bitwiseAND(F.lit(_LOW)).cast("int")))
        found = written(dealt.mapInArrow(_walk(most), LINKS), "op13-links")
        own = found.filter("key is null").select("u", "v")
        links = own if links is None else links.union(own)
        large = found.filter("key is not null").select("key", "fp", "seen")
        if large.isEmpty():
            return links
        rows = _cut(large)


def simhash_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every document; the fingerprint as 16 lowercase hex digits."""
    texts = id_text(docs).select(F.coalesce("doc_id", F.lit(LAST_ID)).alias("doc"), "text")
    prints = written(texts.mapInArrow(_fingerprints, "doc long, fp long"), "op13-prints")
    nodes = written(prints.groupBy("fp").agg(F.min("doc").alias("doc")), "op13-nodes")
    found = components(fingerprint_links(nodes.select("fp"))).withColumnRenamed("id", "fp")
    placed = written(nodes.join(found, "fp", "left").select("fp", "doc", F.coalesce("component", "fp").alias("component")), "op13-placed")
    least = placed.groupBy("component").agg(F.min("doc").alias("least"))
    named = placed.join(least, "component").select("fp", "least")
    return (prints.join(named, "fp")
            .select(F.nullif("doc", F.lit(LAST_ID)).alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                    F.nullif("least", F.lit(LAST_ID)).alias("component_id")))
