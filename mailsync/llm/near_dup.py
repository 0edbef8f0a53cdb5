"""Near-duplicates: MinHash signatures, a multi-index Hamming join, exact confirmation, components.

Documents are linked if 100 * (common five-word shingles) >= 75 * (shingles of either). The Jaccard
similarity of all reported links is computed on the full sets.

Signatures have ``SYMBOLS`` MinHash symbols of 16 bits, split into ``CHUNKS`` chunks of ``WIDTH``. Two
signatures that differ in at most ``2 * CHUNKS - 1`` symbols have, by pigeonhole, a chunk in which at
most one symbol differs. One error per chunk is enumerated by leaving out each symbol in turn, so a
document has ``SYMBOLS`` keys and every pair within that distance shares one for certain. At a
similarity of 0.75 exactly, a pair shares a key with a probability of 1 - 5e-6, also if it lies
beyond the distance. Pairs with fewer than ``LEAST_EQUAL`` equal symbols (at 0.75: less than one in
1e8) are not confirmed.

Plan, always linear in the rows but for pairs that really must be told apart:
1. Sketches of all texts; equal shingle sets collapse to one numbered class each, with its smallest
   ``doc_id`` (copies are combined before the shuffle). Classes are the nodes of all that follows, so
   rows that share a ``doc_id``, or have none, are linked by their texts alone; the components' smallest
   ``doc_id`` comes back in the last join.
2. Keys of the representatives; keys of one document fall out.
3. Every key's members are compared with the smallest member only, and confirmed links joined to
   components. Families of near-copies end up in one component without their pairs being made.
4. Keys whose members are in different components are *open*. Up to ``OPEN_MEMBERS`` members travel as one
   row with their signatures and are compared in the task; only pairs across components that are alike
   leave it, each at the first key it shares, and are confirmed on the full sets. The members of larger keys (documents around one common passage) are joined exactly by
   prefix filtering: two sets with similarity t share one of the n - ceil(t * n) + 1 rarest shingles of
   each, which common passages are not. Members of a shingle are compared in the task by size and by what
   is left after it, in tiles of two blocks of about ``OPEN_MEMBERS`` where it has more. Components with more
   than that there are compared by signature, in tiles, with the documents they share a shingle with.
   All pairs that leave are confirmed on the full sets.
5. Components again, with the links of step 4.

Edge cases: null or empty texts and texts without words have no shingle, no links, and are their own
component; one to four words are one shingle; rows that repeat a ``doc_id`` are judged each by their
own text, also by ``drop_near_duplicates`` (of different texts of a component's smallest ``doc_id``, one
stays); a null ``doc_id`` counts as the largest; extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailsync.llm import textbatch as T
from mailsync.llm.components import components
from mailsync.llm.frames import id_text, written

PERCENT = 75
WIDTH, CHUNKS = 6, 16
SYMBOLS = WIDTH * CHUNKS
LEAST_EQUAL = 48
OPEN_MEMBERS = 64
MOST_DF = 256          # sets of a shingle that are counted; with more it is frequent
MOST_SENT = 500_000    # frequent shingles, 4 MB
BROADCAST_IDS = 1_000_000  # 8 MB of ids; more are joined by a shuffle
LAST_ID = (1 << 63) - 1    # stands for a null doc_id
BLOCK_BYTES = 1 << 20
BLOCK_SHINGLES = 1 << 16  # of a block of sets that are compared in a task

_RANDOM = np.random.default_rng(20)
_FACTORS = _RANDOM.integers(0, 1 << 63, SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MASKS = _RANDOM.integers(0, 1 << 63, SYMBOLS, dtype=np.uint64)
_PLACES = _RANDOM.integers(0, 1 << 63, SYMBOLS, dtype=np.uint64) | np.uint64(1)


def signatures(shingles: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows by symbols; every row must have a shingle."""
    out = np.empty((len(offsets) - 1, SYMBOLS), np.uint16)
    for k in range(SYMBOLS):
        least = np.minimum.reduceat((shingles ^ _MASKS[k]) * _FACTORS[k], offsets[:-1])
        out[:, k] = (T.mix(least) >> np.uint64(48)).astype(np.uint16)
    return out


def signature_keys(signature: np.ndarray) -> np.ndarray:
    """Rows by keys: the hash of each chunk without one of its symbols."""
    parts = T.mix((signature.astype(np.uint64) + np.uint64(1)) * _PLACES)
    whole = parts.reshape(len(signature), CHUNKS, WIDTH)
    left = whole.sum(axis=2, keepdims=True, dtype=np.uint64) - whole
    return T.mix(left.reshape(len(signature), SYMBOLS) ^ _PLACES).view(np.int64)


def _shingle_blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    raw, offsets = T.text_bytes(batch.column("text"))
    for s, e in T.blocks(offsets, BLOCK_BYTES):
        words, at = T.word_hashes(raw[offsets[s]:offsets[e]], offsets[s:e + 1] - offsets[s])
        yield s, e, *T.shingle_hashes(words, at)


def _digest(shingles: bytes) -> bytes:
    return blake2b(shingles, digest_size=16).digest()


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for s, e, shingles, at in _shingle_blocks(batch):
            sets = [np.unique(shingles[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
            full = np.flatnonzero(np.diff(at) > 0)
            sketch: list[bytes | None] = [None] * (e - s)
            for i, row in zip(full, signatures(shingles, np.append(at[full], at[-1])) if len(full) else [], strict=True):
                sketch[i] = row.tobytes()
            digests = [_digest(x.tobytes()) if len(x) else None for x in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc").slice(s, e - s), batch.column("text_key").slice(s, e - s),
                 pa.array([len(x) for x in sets], pa.int64()), pa.array(digests, pa.binary()), pa.array(sketch, pa.binary())],
                ["doc", "text_key", "n_shingles", "set_id", "signature"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for s, e, shingles, at in _shingle_blocks(batch):
            sets = [np.unique(shingles[a:b]).tobytes() for a, b in zip(at[:-1], at[1:], strict=True) if a < b]
            yield pa.RecordBatch.from_arrays([pa.array([_digest(x) for x in sets], pa.binary()), pa.array(sets, pa.binary())],
                                             ["set_id", "shingles"])


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), SYMBOLS)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = signature_keys(_matrix(batch.column("signature")))
        yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(batch.column("id").to_numpy(), SYMBOLS))],
                                         ["key", "id"])


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs with enough equal symbols."""
    for batch in batches:
        if len(batch):
            equal = (_matrix(batch.column("su")) == _matrix(batch.column("sv"))).sum(axis=1)
            chosen = pa.array(np.flatnonzero(equal >= LEAST_EQUAL))
            yield pa.RecordBatch.from_arrays([batch.column("u").take(chosen), batch.column("v").take(chosen)], ["u", "v"])


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose full sets reach the similarity."""
    for batch in batches:
        linked = []
        for n, (x, y) in enumerate(zip(batch.column("hu").to_pylist(), batch.column("hv").to_pylist(), strict=True)):
            both = np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True).size
            if 100 * both >= PERCENT * (len(x) // 8 + len(y) // 8 - both):
                linked.append(n)
        chosen = pa.array(linked, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("u").take(chosen), batch.column("v").take(chosen)], ["u", "v"])


def confirmed(pairs: DataFrame, sketches: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``u, v`` that are links."""
    sign = sketches.select("id", "signature")
    alike = (pairs.join(sign.withColumnsRenamed({"id": "u", "signature": "su"}), "u")
             .join(sign.withColumnsRenamed({"id": "v", "signature": "sv"}), "v").mapInArrow(_alike, "u long, v long"))
    return confirmed_sets(alike, sets)


def confirmed_sets(alike: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``u, v`` of alike signatures that are links."""
    return (alike.join(sets.withColumnsRenamed({"id": "u", "shingles": "hu"}), "u")
            .join(sets.withColumnsRenamed({"id": "v", "shingles": "hv"}), "v").mapInArrow(_confirm, "u long, v long"))


def _flat(lists: pa.Array) -> tuple[np.ndarray, list[np.ndarray], pa.Array]:
    """Offsets of lists of structs, the structs' numbers ``id, component, n``, and the structs."""
    flat = lists.flatten()
    offsets = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy())])
    return offsets, [flat.field(c).to_numpy() for c in ("id", "component", "n")], flat


def _apart(one: list[np.ndarray], other: list[np.ndarray]) -> np.ndarray:
    """Pairs of different components whose sizes do not rule a link out."""
    (_, c, n), (_, c2, n2) = one, other
    return ((c[:, None] != c2) & (100 * n[:, None] >= PERCENT * n2) & (100 * n2 >= PERCENT * n[:, None]))


def _pairs_of(us: list[np.ndarray], vs: list[np.ndarray]) -> pa.RecordBatch:
    u, v = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (us, vs))
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], ["u", "v"])


def _first_key(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Number of the first key that two signatures share, row by row; -1 for none."""
    differs = (one != other).reshape(len(one), CHUNKS, WIDTH)
    errors = differs.sum(axis=2)
    chunk = (errors <= 1).argmax(axis=1)
    rows = np.arange(len(one))
    return np.where(errors[rows, chunk] <= 1, chunk * WIDTH + differs[rows, chunk].argmax(axis=1), -1)


def _alike_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Alike pairs among the members of each key, each pair at the first key that it shares."""
    for batch in batches:
        if not len(batch):
            continue
        at, numbers, flat = _flat(batch.column("ours"))
        symbols, keys = _matrix(flat.field("signature")), batch.column("key").to_numpy()
        us, vs = [], []
        for k in range(len(batch)):
            own = slice(at[k], at[k + 1])
            members = [x[own] for x in numbers]
            u, v = np.nonzero(np.triu(_apart(members, members), 1))
            if len(u):
                place = int(np.flatnonzero(signature_keys(symbols[at[k]:at[k] + 1])[0] == keys[k])[0])
                one, other = symbols[own][u], symbols[own][v]
                alike = ((one == other).sum(axis=1) >= LEAST_EQUAL) & (_first_key(one, other) == place)
                us.append(members[0][u[alike]])
                vs.append(members[0][v[alike]])
        yield _pairs_of(us, vs)


def _family_tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For every document on the right of a tile one link to a member on the left, if there is any.

    The members are of one component, so one link says all."""
    for batch in batches:
        us, vs = [], []
        for k in range(len(batch)):
            ours, theirs = batch.column("ours")[k].as_py(), batch.column("theirs")[k].as_py()
            left = [(x["id"], np.frombuffer(x["shingles"], np.uint64)) for x in ours]
            ids = np.array([y["id"] for y in theirs])
            sizes = np.array([len(y["shingles"]) // 8 for y in theirs])
            flat = np.frombuffer(b"".join(y["shingles"] for y in theirs), np.uint64)
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            apart = np.ones(len(ids), bool)
            for u, a in left:
                place = np.searchsorted(a, flat)
                both = np.add.reduceat((a[np.minimum(place, len(a) - 1)] == flat).astype(np.int64), starts)
                linked = apart & (100 * both >= PERCENT * (len(a) + sizes - both))
                if linked.any():
                    us.append(np.full(int(linked.sum()), u))
                    vs.append(ids[linked])
                    apart &= ~linked
        yield _pairs_of(us, vs)


def _sharing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of members of a prefix shingle that it does not rule out; across the sides of a tile of two blocks.

    Nothing before the first shingle that two sets share is common, so they share at most the shorter of what
    is left from there on."""
    for batch in batches:
        if not len(batch):
            continue
        at, numbers, flat = _flat(batch.column("ours"))
        left_over, side = flat.field("left_over").to_numpy(), flat.field("side").to_numpy()
        us, vs = [], []
        for k, two in enumerate(batch.column("two").to_pylist()):
            own = slice(at[k], at[k + 1])
            ids, _, n = members = [x[own] for x in numbers]
            shared = np.minimum(left_over[own][:, None], left_over[own])
            may = _apart(members, members) & ((100 + PERCENT) * shared >= PERCENT * (n[:, None] + n))
            may &= (side[own][:, None] < side[own]) if two else np.triu(np.ones_like(may), 1)
            u, v = np.nonzero(may)
            us.append(ids[u])
            vs.append(ids[v])
        yield _pairs_of(us, vs)


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, c, x in zip(*(batch.column(n).to_pylist() for n in ("id", "component", "shingles")), strict=True):
            values = np.frombuffer(x, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(values), i)), pa.array(np.full(len(values), c)), pa.array(np.full(len(values), len(values))),
                 pa.array(values)], ["id", "component", "n", "shingle"])


def _rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in order of their shingle those whose shingle is in 2 to ``MOST_DF`` sets, with that number as ``df``;
    for a shingle in more sets rows without an ``id``. At most ``MOST_DF`` rows are held between batches."""
    kept, passing = [np.zeros(0, np.int64)] * 2, None
    for batch in batches:
        if not len(batch):
            continue
        ids, shingles = (np.concatenate([x, batch.column(c).to_numpy()]) for x, c in zip(kept, ("id", "shingle"), strict=True))
        heads = np.flatnonzero(np.concatenate([[True], shingles[1:] != shingles[:-1]]))
        sizes = np.diff(np.append(heads, len(shingles)))
        frequent = sizes > MOST_DF
        frequent[0] |= shingles[0] == passing
        cut = len(shingles) if frequent[-1] else int(heads[-1])  # a small last group may go on
        passing = shingles[-1] if frequent[-1] else None
        each = np.repeat(np.where(frequent, 0, sizes), sizes)[:cut]
        yield _counted(ids[:cut][each > 1], shingles[:cut][each > 1], each[each > 1])
        yield _counted(None, shingles[heads[frequent]], np.full(int(frequent.sum()), MOST_DF + 1))
        kept = [ids[cut:], shingles[cut:]]
    if len(kept[0]) > 1:
        yield _counted(*kept, np.full(len(kept[0]), len(kept[0])))


def _counted(ids: np.ndarray | None, shingles: np.ndarray, df: np.ndarray) -> pa.RecordBatch:
    column = pa.nulls(len(shingles), pa.int64()) if ids is None else pa.array(ids)
    return pa.RecordBatch.from_arrays([column, pa.array(shingles), pa.array(df.astype(np.int64))], ["id", "shingle", "df"])


def _prefix_length(n: int) -> int:
    return n - (PERCENT * n + 99) // 100 + 1


def _with_frequent(frequent: np.ndarray):
    """The number of frequent shingles of each set, and as many of them, by hash, as its prefix may hold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, found, first = [], [], []
            for x in batch.column("shingles").to_pylist():
                values = np.frombuffer(x, np.int64)
                own = np.intersect1d(values, frequent, assume_unique=True)
                sizes.append(len(values))
                found.append(len(own))
                first.append(own[:_prefix_length(len(values))].tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("component"), pa.array(sizes, pa.int64()), pa.array(found, pa.int64()),
                 pa.array(first, pa.list_(pa.int64()))], ["id", "component", "n", "n_frequent", "frequent"])
    return run


def _prefixes(sets: DataFrame) -> DataFrame:
    """``id, component, n, prefix, skipped``: the rarest shingles of each of ``id, component, shingles``.

    The order of all shingles is: those of one set alone, which match nothing, so the ``prefix`` is without them
    and ``skipped`` is their number; those in up to ``MOST_DF`` sets by their number; the frequent others by hash.
    Rows are dealt and sorted by shingle once and counted as they stream by; only rare ones go on. Frequent
    shingles are fewer than the rows over ``MOST_DF``; they are sent to all tasks up to ``MOST_SENT``, else joined."""
    rows = sets.mapInArrow(_set_rows, "id long, component long, n long, shingle long").select("id", "shingle")
    counted = written(rows.repartition("shingle").sortWithinPartitions("shingle").mapInArrow(_rare, "id long, shingle long, df long"), "op7-rare")
    frequent = counted.filter("id is null").select("shingle").distinct()
    if frequent.count() <= MOST_SENT:
        sent = np.array([r.shingle for r in frequent.collect()], np.int64)
        own = sets.mapInArrow(_with_frequent(np.sort(sent)), "id long, component long, n long, n_frequent long, frequent array<long>")
    else:
        by_set = rows.join(frequent, "shingle").groupBy("id").agg(F.array_sort(F.collect_list("shingle")).alias("frequent"))
        own = (sets.select("id", "component", (F.octet_length("shingles") / 8).cast("bigint").alias("n")).join(by_set, "id", "left")
               .withColumn("frequent", F.coalesce("frequent", F.array().cast("array<long>")))
               .withColumn("n_frequent", F.size("frequent").cast("bigint")))
    rare = (counted.filter("id is not null").groupBy("id")
            .agg(F.transform(F.array_sort(F.collect_list(F.struct("df", "shingle"))), lambda x: x["shingle"]).alias("rare")))
    own = own.join(rare, "id", "left").withColumn("rare", F.coalesce("rare", F.array().cast("array<long>")))
    skipped = F.col("n") - F.col("n_frequent") - F.size("rare")
    length = F.expr(f"n - ceil({PERCENT} * n / 100) + 1") - skipped
    return (own.withColumn("skipped", skipped).withColumn("length", F.greatest(length, F.lit(0)).cast("int"))
            .select("id", "component", "n", F.slice(F.concat("rare", "frequent"), F.lit(1), F.col("length")).alias("prefix"), "skipped"))


def _small_pairs(rows: DataFrame) -> DataFrame:
    """Pairs of different components that share a prefix shingle and may be links.

    The members of a shingle are one row; those of a frequent one are dealt to blocks, and every two blocks
    are a row, so no row holds more than about twice ``OPEN_MEMBERS``."""
    blocks = (rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
              .select("shingle", F.ceil(F.col("members") / OPEN_MEMBERS).alias("blocks")))
    dealt = (rows.select("shingle", "id", "component", "n", "left_over").join(blocks, "shingle")
             .withColumn("block", F.pmod(F.xxhash64("id"), "blocks"))
             .withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)"))))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    member = F.struct("id", "component", "n", "left_over", (F.col("block") == F.col("high")).cast("int").alias("side"))
    tiles = (dealt.withColumn("low", low).withColumn("high", high).groupBy("shingle", "low", "high")
             .agg(F.collect_list(member).alias("ours")).select("ours", (F.col("low") != F.col("high")).alias("two")))
    return tiles.mapInArrow(_sharing, "u long, v long").distinct()


def _blocks(sizes: str) -> Column:
    """Blocks for all of ``sizes`` shingles, of about ``BLOCK_SHINGLES`` each (a larger set stands alone)."""
    return F.ceil(F.sum(sizes) / BLOCK_SHINGLES)


def _family_links(rows: DataFrame, sets: DataFrame, sizes: DataFrame, families: DataFrame) -> DataFrame:
    """Links between a large component and documents that share a prefix shingle with any of its members.

    Members and documents meet in tiles of two blocks with about ``BLOCK_SHINGLES`` shingles each, spread over
    all tasks by family and block numbers. Sets are compared in the tile, at most one link per document leaves."""
    ours = (rows.join(families.select("component"), "component", "left_semi").groupBy("shingle", F.col("component").alias("family"))
            .agg(F.max("left_over").alias("most_left"), F.min("n").alias("least_n"), F.max("n").alias("most_n")))
    is_family = families.select("component", F.lit(True).alias("large"))
    theirs = (rows.join(is_family, "component", "left")
              .select("shingle", "id", "component", "n", "left_over", F.coalesce("large", F.lit(False)).alias("large")))
    may = (f"100 * n >= {PERCENT} * least_n and 100 * most_n >= {PERCENT} * n "  # for some member, by size and by what is left
           f"and {100 + PERCENT} * least(left_over, most_left) >= {PERCENT} * (n + least_n)")
    near = written(ours.join(theirs, "shingle").filter(f"component != family and (not large or family < component) and {may}")
                   .select("family", "id").distinct(), "op7-near")
    blocks = (sizes.join(families.select("component"), "component", "left_semi").groupBy(F.col("component").alias("family"))
              .agg(_blocks("n").alias("blocks")))
    parts = near.join(sizes, "id").groupBy("family").agg(_blocks("n").alias("parts"))
    member = F.struct("id", "shingles")
    left = (sets.withColumnRenamed("component", "family").join(blocks, "family")
            .withColumn("block", F.pmod(F.xxhash64("id"), "blocks"))
            .groupBy("family", "block").agg(F.collect_list(member).alias("ours")))
    right = (near.join(parts, "family").join(sets.select("id", "shingles"), "id")
             .withColumn("part", F.pmod(F.xxhash64("id"), "parts"))
             .groupBy("family", "part").agg(F.collect_list(member).alias("theirs"))
             .join(blocks, "family").withColumn("block", F.explode(F.expr("sequence(0L, blocks - 1)"))))
    tiles = right.join(left, ["family", "block"])
    return tiles.repartition("family", "block", "part").select("ours", "theirs").mapInArrow(_family_tile, "u long, v long")


def prefix_links(sets: DataFrame, sketches: DataFrame) -> DataFrame:
    """All links across components among ``id, component, shingles``, exactly."""
    prefix = written(_prefixes(sets), "op7-prefix")
    families = written(prefix.groupBy("component").agg(F.count(F.lit(1)).alias("members")).filter(F.col("members") > OPEN_MEMBERS),
                       "op7-families")
    rows = (prefix.select("id", "component", "n", "skipped", F.posexplode("prefix").alias("place", "shingle"))
            .select("id", "component", "n", "shingle", (F.col("n") - F.col("skipped") - F.col("place")).alias("left_over")))
    small = rows.join(families.select("component"), "component", "left_anti")
    links = confirmed(written(_small_pairs(small), "op7-small"), sketches, sets.select("id", "shingles"))
    return links.union(_family_links(rows, sets, prefix.select("id", "component", "n"), families))


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit(""))))


def _judged(docs: DataFrame) -> DataFrame:
    """``doc, text_key, n_shingles, component_id, kept`` of every row, null ids as ``LAST_ID``."""
    texts = id_text(docs).select(F.coalesce("doc_id", F.lit(LAST_ID)).alias("doc"), "text")
    sketches = written(texts.withColumn("text_key", text_key(F.col("text")))
                       .mapInArrow(_sketch, "doc long, text_key binary, n_shingles long, set_id binary, signature binary"), "op7-sketches")
    full = sketches.filter(F.col("set_id").isNotNull())
    classes = written(full.groupBy("set_id").agg(F.min("doc").alias("doc"), F.first("signature").alias("signature"),
                                                 F.first("n_shingles").alias("n"))
                      .withColumn("id", F.monotonically_increasing_id()), "op7-classes")  # numbers are fixed once written

    keys = classes.select("id", "signature").mapInArrow(_keys, "key long, id long")
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    members = written(keys.join(shared, "key"), "op7-members")
    ids = written(classes.select("id", "set_id", "doc").join(members.select("id").distinct(), "id"), "op7-ids")
    n_ids, wanted = ids.count(), ids.select("doc").distinct()
    wanted = F.broadcast(wanted) if n_ids <= BROADCAST_IDS else wanted
    sets = written(texts.join(wanted, "doc", "left_semi").mapInArrow(_sets, "set_id binary, shingles binary")
                   .join(ids.select("set_id", "id"), "set_id").select("id", "shingles"), "op7-sets")
    if sets.count() > n_ids:  # repeated rows
        sets = written(sets.distinct(), "op7-sets")

    pivots = members.groupBy("key").agg(F.min("id").alias("u"))
    stars = written(members.join(pivots, "key").filter("u != id").select("u", F.col("id").alias("v")).distinct(), "op7-stars")
    first = components(confirmed(stars, classes, sets))

    placed = (members.join(first, "id", "left")
              .select("key", "id", "members", F.coalesce("component", "id").alias("component")))
    open_keys = (placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
                 .filter("low != high").select("key"))
    unsure = written(placed.join(open_keys, "key", "left_semi").join(classes.select("id", "n"), "id"), "op7-open")
    few = (unsure.filter(F.col("members") <= OPEN_MEMBERS).join(classes.select("id", "signature"), "id")
           .groupBy("key").agg(F.collect_list(F.struct("id", "component", "n", "signature")).alias("ours")))
    alike = written(few.mapInArrow(_alike_members, "u long, v long"), "op7-pairs")
    many = unsure.filter(F.col("members") > OPEN_MEMBERS).select("id", "component").distinct()
    second = confirmed_sets(alike, sets).union(prefix_links(written(sets.join(many, "id"), "op7-many"), classes))
    final = components(first.select(F.col("id").alias("u"), F.col("component").alias("v")).union(second))

    linked = final.union(final.select(F.col("component").alias("id"), "component").distinct())
    linked = written(linked.join(classes.select("id", "doc", "set_id"), "id"), "op7-linked")
    least = linked.groupBy("component").agg(F.min(F.struct("doc", "set_id")).alias("least"))
    named = linked.join(least, "component").select("id", F.col("least.doc").alias("least_doc"), F.col("least.set_id").alias("least_set"))
    smallest = (classes.select("set_id", "id", F.col("doc").alias("smallest")).join(named, "id", "left")
                .select("set_id", F.coalesce("least_doc", "smallest").alias("smallest"),
                        F.coalesce("least_set", "set_id").alias("least_set")))
    found = sketches.drop("signature").join(smallest, "set_id", "left").withColumn("component_id", F.coalesce("smallest", "doc"))
    return found.withColumn("kept", (F.col("doc") == F.col("component_id")) & F.col("set_id").eqNullSafe(F.col("least_set")))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document."""
    return _judged(docs).select(F.nullif("doc", F.lit(LAST_ID)).alias("doc_id"), "n_shingles",
                                F.nullif("component_id", F.lit(LAST_ID)).alias("component_id"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The smallest document of each component of ``docs``, columns unchanged."""
    stay = (_judged(docs).filter("kept")
            .select(F.nullif("doc", F.lit(LAST_ID)).alias("stay_id"), F.col("text_key").alias("stay_key")).distinct())
    return docs.join(stay, docs["doc_id"].eqNullSafe(stay["stay_id"]) & (text_key(docs["text"]) == stay["stay_key"]), "left_semi")
