"""The trie of conversation prefixes, rolled up by centroid decomposition of its parent edges.

Conversations that begin with the same turns share the nodes of those turns. Every node has the number of
its leaves and the tokens that sharing its subtree saves; both are sums over a subtree.

Rollup (``centroid_rollup``). The forest of parent edges is split again and again. In a component of n nodes
the nodes with more than n / 2 nodes below them (in the component, themselves included) are a path from the
top down to one node, the centroid. Its subtree's total is aggregated, given to the centroid, and added to
all other nodes of that path. Then the centroid goes: each child's subtree is a component and what is left
above is another (the path's sizes shrink by the centroid's), none with more than n / 2 nodes. So a node gets
at most log2(n) additions, however deep the trie is and however many children a node has.

Nodes find their new component by the trie itself: the ancestor of a node at a depth is the place that its
smallest member has there, so one equi-join on (conversation, depth) tells under which child of the
centroid a node lies. The sizes to begin with are one aggregate: smallest members cut the trie into
vertical chains, and below a node lie the whole chains of its members but for the part of its own
smallest member's chain that is above it.

Plan:
1. Turns are ranked in their conversation by a range partition (a conversation with a third of all turns
   spreads over many tasks), its order tagged, and one offset per conversation and task. Texts end here: a
   turn goes on as a 120-bit digest and its number of words.
2. Rebuilt conversations: the first turns of the base conversation, then their own.
3. A place (conversation, depth) has as node id the digest of its depth and the running sums of its turns'
   position-dependent hashes (128 bits): running sums inside blocks of ``BLOCK`` turns plus the sums of the
   blocks before, so no window holds a whole conversation. Places combine to nodes before the shuffle.
4. Components of more than ``MOST_NODES`` nodes are split by Spark, one written table per round; smaller ones
   come whole to a task and go on there with arrays.
5. The ids of the conversations that end in a node are joined to texts of up to ``CHUNK_IDS`` ids by a range
   partition, and a node's texts are hashed as a stream, so equal conversations need no memory.

Edge cases: a null role or text is empty; a null ``turn`` comes first, ties go by role, then text; repeated
rows are turns of their own; rows without a ``conv_id`` belong to no conversation and are left out; a
conversation without rebuilt turns is a member of the root only; extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailsync.llm.frames import written

WORD = r"[^\x20\x09-\x0D]+"
FAMILY = 20         # conversations with the same base
MOST_SHARED = 4     # the shared turns are a hash modulo this
BLOCK = 1024
MOST_NODES = 4_096  # of a component that one task finishes
BUFFER_ROWS = 32_768
CHUNK_IDS = 4_096
STATE = "id binary, parent binary, top binary, rep long, depth long, size long"


def _piece(digest: Column, at: int) -> Column:
    """60 bits of a hex digest."""
    return F.conv(F.substring(digest, at, 15), 16, 10).cast("bigint")


def ranked_turns(turns: DataFrame) -> DataFrame:
    """``conv, r, a, b, words``: rank of each turn, its digest in two numbers, its number of words."""
    spark = turns.sparkSession
    order = ["conv", "turn", "role", "text"]
    rows = turns.select(F.col("conv_id").cast("bigint").alias("conv"), F.col("turn"),
                        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).filter(F.col("conv").isNotNull())
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"), 256)
    tagged = written(
        rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order)
        .select("conv", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("tag"), digest.alias("digest"),
                F.size(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).cast("bigint").alias("words"))
        .select("conv", "part", "tag", _piece(F.col("digest"), 1).alias("a"), _piece(F.col("digest"), 16).alias("b"), "words"), "op11-turns")
    runs = tagged.groupBy("conv", "part").agg(F.min("tag").alias("first"), F.count(F.lit(1)).alias("turns"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per task
    offsets = runs.select("conv", "part", (F.coalesce(F.sum("turns").over(before), F.lit(0)) - F.col("first") + 1).alias("shift"))
    return tagged.join(offsets, ["conv", "part"]).select("conv", (F.col("tag") + F.col("shift")).alias("r"), "a", "b", "words")


def rebuilt(ranked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns ``conv, depth, a, b, words``, and ``conv, turns`` of every conversation."""
    own = written(ranked.groupBy("conv").agg(F.count(F.lit(1)).alias("own")), "op11-own")
    shared = F.crc32(F.col("conv").cast("string").cast("binary")) % MOST_SHARED
    convs = own.select("conv", "own", shared.alias("h"), (F.col("conv") - F.col("conv") % FAMILY).alias("base"))
    of_base = own.select(F.col("conv").alias("base"), F.col("own").alias("base_turns"))
    convs = written(convs.join(of_base, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_turns", F.lit(0)))), "op11-convs")
    heads = ranked.filter(F.col("r") < MOST_SHARED).withColumnRenamed("conv", "base")
    first = convs.filter("taken > 0").select("conv", "base", "taken").join(heads, "base").filter("r <= taken")
    short = convs.filter("taken < h").select("conv", "taken")  # bases that have fewer turns, or none
    rest = (ranked.withColumn("h", shared).filter("r > h").join(short, "conv", "left")
            .select("conv", (F.col("r") - F.col("h") + F.coalesce("taken", "h")).alias("depth"), "a", "b", "words"))
    turns = first.select("conv", F.col("r").alias("depth"), "a", "b", "words").unionByName(rest)
    return turns, convs.select("conv", (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("turns"))


def _node_id(depth: Column, one: Column, two: Column) -> Column:
    return F.unhex(F.md5(F.concat_ws(",", depth.cast("string"), one.cast("string"), two.cast("string")).cast("binary")))


def places(turns: DataFrame) -> DataFrame:
    """``conv, depth, id, parent, words``: the node at every depth of every conversation but the root."""
    wide = "decimal(38,0)"
    rows = turns.select("conv", "depth", "words", F.xxhash64("depth", "a", "b").cast(wide).alias("x"),
                        F.xxhash64("b", "depth", "a", F.lit(1)).cast(wide).alias("y"),
                        F.expr(f"(depth - 1) div {BLOCK}").alias("block"))
    rows = written(rows, "op11-rows")
    of_block = Window.partitionBy("conv", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    run = lambda c: F.sum(c).over(of_block).cast(wide)
    long = rows.filter("block > 0").select("conv").distinct()
    sums = rows.join(long, "conv", "left_semi").groupBy("conv", "block").agg(F.sum("x").alias("sx"), F.sum("y").alias("sy"))
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row per block
    offsets = (sums.select("conv", "block", F.sum("sx").over(before).cast(wide).alias("px"), F.sum("sy").over(before).cast(wide).alias("py"))
               .filter("block > 0"))
    summed = (rows.withColumn("rx", run("x")).withColumn("ry", run("y")).join(offsets, ["conv", "block"], "left")
              .withColumn("rx", (F.col("rx") + F.coalesce("px", F.lit(0))).cast(wide))
              .withColumn("ry", (F.col("ry") + F.coalesce("py", F.lit(0))).cast(wide)))
    above = [(F.col(f"r{c}") - F.col(c)).cast(wide) for c in "xy"]
    return summed.select("conv", "depth", _node_id(F.col("depth"), F.col("rx"), F.col("ry")).alias("id"),
                         _node_id(F.col("depth") - 1, *above).alias("parent"), "words")


def root_id() -> Column:
    return _node_id(F.lit(0), F.lit(0), F.lit(0))


def trie_nodes(at: DataFrame, convs: DataFrame) -> DataFrame:
    """``id, parent, depth, words, rep, n_convs, size`` of every node, ``rep`` being the smallest member."""
    members = [F.min("conv").alias("rep"), F.count(F.lit(1)).alias("n_convs")]
    root = convs.agg(*members).filter("n_convs > 0").select(
        root_id().alias("id"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("bigint").alias("depth"),
        F.lit(0).cast("bigint").alias("words"), "rep", "n_convs")
    nodes = written(at.groupBy("id", "parent", "depth", "words").agg(*members).unionByName(root), "op11-nodes")
    chains = written(nodes.groupBy("rep").agg(F.count(F.lit(1)).alias("owned"), F.min("depth").alias("from_depth")), "op11-chains")
    below = at.select("conv", "id").join(chains.withColumnRenamed("rep", "conv"), "conv").groupBy("id").agg(F.sum("owned").alias("below"))
    below = below.unionByName(chains.agg(F.sum("owned").alias("below")).select(root_id().alias("id"), "below"))
    size = F.col("below") - (F.col("depth") - F.col("from_depth"))
    return nodes.join(below, "id").join(chains.select("rep", "from_depth"), "rep").select(*nodes.columns, size.alias("size"))


def component_totals(parent: np.ndarray, size: np.ndarray, values: np.ndarray, added: np.ndarray) -> np.ndarray:
    """Subtree totals of whole components by centroid decomposition, all components at once.

    ``parent`` has row numbers, -1 at the tops; ``size`` the nodes below in the component; ``added`` what the
    node has got from subtrees that were cut off before."""
    n = len(parent)
    parent, size, added = parent.copy(), size.copy(), added.copy()
    rows = np.arange(n)
    top = _tops(np.where(parent < 0, rows, parent))
    alive = np.ones(n, bool)
    while alive.any():
        heavy = alive & (2 * size > size[top])
        least = np.full(n, np.iinfo(np.int64).max)
        np.minimum.at(least, top[heavy], size[heavy])
        centroid = heavy & (size == least[top])
        of_top = np.full(n, -1)
        of_top[top[centroid]] = rows[centroid]
        child = alive & (parent >= 0) & centroid[parent]
        now = _tops(np.where((parent < 0) | child | centroid | ~alive, rows, parent))
        below = alive & (child[now] | centroid)
        totals = np.zeros_like(values)
        np.add.at(totals, of_top[top[below]], values[below])
        path = heavy & ~centroid
        added[path] += totals[of_top[top[path]]]
        size[path] -= size[of_top[top[path]]]
        added[centroid] += totals[centroid]
        alive &= ~centroid
        parent[child] = -1
        top = now
    return added


def _tops(up: np.ndarray) -> np.ndarray:
    """The last node above every node, by doubling."""
    while True:
        next_up = up[up]
        if np.array_equal(next_up, up):
            return up
        up = next_up


def _finish(table: pa.Table, names: list[str]) -> pa.RecordBatch:
    ids = table.column("id").combine_chunks()
    parent = pc.index_in(table.column("parent").combine_chunks(), value_set=ids).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    is_top = pc.equal(table.column("id"), table.column("top")).to_numpy()
    matrix = lambda cols: np.stack([table.column(c).to_numpy() for c in cols], axis=1)
    totals = component_totals(np.where(is_top, -1, parent), table.column("size").to_numpy(),
                              matrix(names), matrix([f"added_{c}" for c in names]))
    return pa.RecordBatch.from_arrays([ids, *[pa.array(totals[:, k]) for k in range(len(names))]], ["id", *names])


def _finisher(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            kept.append(batch)
            rows += len(batch)
            if rows >= BUFFER_ROWS:
                table = pa.Table.from_batches(kept).combine_chunks()
                last = table.column("top")[-1]
                cut = pc.index(table.column("top"), last).as_py()  # sorted; the last component may go on
                if cut:
                    yield _finish(table.slice(0, cut), names)
                kept, rows = table.slice(cut).to_batches(), len(table) - cut
        if rows:
            yield _finish(pa.Table.from_batches(kept), names)
    return run


def centroid_rollup(nodes: DataFrame, at: DataFrame, values: list[str], root: Column, most: int = MOST_NODES) -> DataFrame:
    """``id`` and the sum of each of ``values`` over the node's subtree.

    ``nodes`` has ``id, parent, rep, depth, size`` and the values (longs); ``at`` the places
    ``conv, depth, id, parent`` of the members."""
    added = [f"added_{c}" for c in values]
    state = nodes.select("id", "parent", root.alias("top"), "rep", "depth", "size", *values, *[F.lit(0).cast("bigint").alias(c) for c in added])
    done, ahead = None, at.select(F.col("conv").alias("rep"), F.col("depth").alias("next_depth"), F.col("id").alias("child"),
                                  F.col("parent").alias("child_of"))
    wanted = [F.col("id"), *[F.col(c) for c in values]]
    while True:
        state = written(state, "op11-state")
        large = written(state.groupBy("top").agg(F.max("size").alias("total")).filter(F.col("total") > most), "op11-large")
        small = state.join(large, "top", "left_anti") if not large.isEmpty() else state
        ended = (small.repartition("top").sortWithinPartitions("top")
                 .mapInArrow(_finisher(values), "id binary, " + ", ".join(f"{c} long" for c in values)))
        done = ended if done is None else done.unionByName(ended)
        if large.isEmpty():
            return done
        active = state.join(large, "top").withColumn("heavy", 2 * F.col("size") > F.col("total"))
        chosen = active.filter("heavy").groupBy("top").agg(F.min(F.struct("size", "depth", "id")).alias("c"))
        chosen = written(chosen.select("top", F.col("c.id").alias("c_id"), F.col("c.size").alias("c_size"), F.col("c.depth").alias("c_depth")),
                         "op11-centroids")
        cut = active.join(chosen, "top").withColumn("next_depth", F.when(F.col("depth") > F.col("c_depth"), F.col("c_depth") + 1))
        cut = written(cut.join(ahead, ["rep", "next_depth"], "left")
                      .withColumn("below", F.coalesce(F.col("child_of") == F.col("c_id"), F.lit(False)))
                      .withColumn("is_centroid", F.col("id") == F.col("c_id")), "op11-cut")
        totals = (cut.filter("below or is_centroid").groupBy("top")
                  .agg(*[F.sum(c).alias(f"sum_{c}") for c in values]))
        cut = cut.join(totals, "top")
        on_path = F.col("heavy")  # the centroid included: its own total, or one of its subtrees'
        step = cut.select("id", "parent", F.when(F.col("below"), F.col("child")).otherwise(F.col("top")).alias("top"), "rep", "depth",
                          F.when(on_path, F.col("size") - F.col("c_size")).otherwise(F.col("size")).alias("size"), *values,
                          *[(F.col(a) + F.when(on_path, F.col(f"sum_{c}")).otherwise(0)).alias(a) for a, c in zip(added, values, strict=True)],
                          "is_centroid")
        step = written(step, "op11-step")
        done = done.unionByName(step.filter("is_centroid").select("id", *[F.col(a).alias(c) for a, c in zip(added, values, strict=True)]).select(*wanted))
        state = step.filter("not is_centroid").drop("is_centroid")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (node, conversation) in order, as texts of consecutive ids."""
    for batch in batches:
        ids, convs = batch.column("id").to_pylist(), batch.column("conv").to_pylist()
        out: list[tuple[bytes, int, str]] = []
        s = 0
        for k in range(1, len(ids) + 1):
            if k == len(ids) or ids[k] != ids[s] or k - s == CHUNK_IDS:
                out.append((ids[s], convs[s], ",".join(map(str, convs[s:k]))))
                s = k
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate((pa.binary(), pa.int64(), pa.string()))],
                                             ["id", "first", "ids"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's texts in order."""
    node, state = None, hashlib.sha256()
    give = lambda rows: pa.RecordBatch.from_arrays(
        [pa.array([x for x, _ in rows], pa.binary()), pa.array([x for _, x in rows], pa.string())], ["id", "ends_sha256"])
    for batch in batches:
        out = []
        for i, ids in zip(batch.column("id").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if i == node:
                state.update(b"," + ids.encode())
            else:
                if node is not None:
                    out.append((node, state.hexdigest()))
                node, state = i, hashlib.sha256(ids.encode())
        yield give(out)
    if node is not None:
        yield give([(node, state.hexdigest())])


def ends_digests(ends: DataFrame) -> DataFrame:
    """``id, ends_sha256`` of ``id, conv``: the digest of a node's conversations in ascending order."""
    n = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = ends.repartitionByRange(n, "id", "conv").sortWithinPartitions("id", "conv").mapInArrow(_chunks, "id binary, first long, ids string")
    return (chunks.repartition("id").sortWithinPartitions("id", "first").mapInArrow(_digests, "id binary, ends_sha256 string"))


def prefix_trie(turns: DataFrame, most: int = MOST_NODES) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations."""
    turns, convs = rebuilt(ranked_turns(turns))
    convs = written(convs, "op11-lengths")
    at = written(places(turns), "op11-places")
    nodes = trie_nodes(at, convs)
    kids = nodes.groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = written(nodes.join(kids, "id", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "op11-trie")
    worth = nodes.select("id", "parent", "rep", "depth", "size", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("bigint").alias("n_leaves"),
                         ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"))
    totals = centroid_rollup(worth, at, ["n_leaves", "saved_tokens"], root_id(), most)
    ends = (convs.withColumnRenamed("turns", "depth").join(at, ["conv", "depth"]).select("id", "conv")
            .unionByName(convs.filter("turns = 0").select(root_id().alias("id"), "conv")))
    parents = nodes.select(F.col("id").alias("parent"), F.col("rep").alias("parent_conv_id"))
    return (nodes.join(totals, "id").join(ends_digests(ends), "id", "left").join(parents, "parent", "left")
            .select(F.col("rep").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")))
