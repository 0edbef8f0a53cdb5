"""Fixture: the server's paging (P13) and page packing, which make the test tenant's landed envelopes.

A chain of a bounded number of items is gathered, sorted and cut in one group. Larger chains are ranked, the
only step here that needs an order per key. A plain ``row_number() OVER (PARTITION BY chain ORDER BY ...)`` puts a whole chain into one task, and a
single mailbox may hold a third of all items. Instead the rank is built skew-safe:

1. range-partition on (chain, order) and sort inside partitions: the sampled bounds split a hot
   chain over many partitions, and each partition holds contiguous runs of its chains;
2. tag rows with ``monotonically_increasing_id`` (increasing in that sorted order) and write the
   result once to the shared checkpoint folder (``checkpoint()``): range bounds come from a
   sample, so the tagged rows must be fixed before they are read twice;
3. per (chain, partition): first tag and size - a small table, at most chains + partitions rows -
   turned into offsets with a running sum per chain, and joined back on (chain, partition).

rank = offset + (tag - first tag of the run) + 1. No group, window or task ever holds more than
one partition's share of a chain. Pages are then built by grouping at most ``page_size`` items.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailsync import constants as C
from mailsync.operators.joins import join_null_safe, sized
from mailsync.session import ensure_checkpoint_dir, written

SMALL_CHAIN = 10_000  # items of a chain that one group may hold: a few megabytes


def rank_within(df: DataFrame, keys: list[str], order: list[str],
                num_partitions: int | None = None, rank_col: str = "rank") -> DataFrame:
    """1-based rank of each row inside its key group by ``order`` (ties broken arbitrarily)."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tagged = (df.repartitionByRange(n, *keys, *order)
              .sortWithinPartitions(*keys, *order)
              .withColumn("_part", F.spark_partition_id())
              .withColumn("_tag", F.monotonically_increasing_id())
              .checkpoint(eager=True))
    runs = tagged.groupBy(*keys, "_part").agg(F.min("_tag").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select(*keys, "_part", "_first",
                          F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (join_null_safe(tagged, offsets, [*keys, "_part"])
            .withColumn(rank_col, F.col("_off") + (F.col("_tag") - F.col("_first")) + 1)
            .drop("_part", "_tag", "_first", "_off"))


def assign_pages(items: DataFrame, keys: list[str], order: list[str],
                 page_size: int = C.MESSAGE_PAGE_SIZE) -> DataFrame:
    """``page_no = (rank - 1) div page_size`` and ``item_pos`` inside the page (0-based)."""
    ranked = rank_within(items, keys, order)
    r0 = F.col("rank") - 1
    return (ranked.withColumn("page_no", F.floor(r0 / F.lit(page_size)).cast("int"))
            .withColumn("item_pos", (r0 % F.lit(page_size)).cast("int"))
            .drop("rank"))


def _links_json(next_link: Column, delta_link: Column) -> Column:
    """``,"@odata.nextLink":"..."`` / ``,"@odata.deltaLink":"..."`` (JSON-escaped), or ''."""
    def one(name, v):
        return F.when(v.isNull(), F.lit("")).otherwise(
            F.concat(F.lit(f',"{name}":'), F.to_json(F.array(v)).substr(F.lit(2), F.length(F.to_json(F.array(v))) - 2)))
    return F.concat(one(C.NEXT_LINK, next_link), one(C.DELTA_LINK, delta_link))


def _envelope(pages: DataFrame, keys: list[str], resource: str, fetched_at: Column | None) -> DataFrame:
    """``keys, page_no, body`` as landed envelopes; envelope columns not among ``keys`` are null."""
    envelope = []
    for c in ["resource", "user_id", "folder_id", "message_id", "request_token"]:
        if c in keys:
            envelope.append(F.col(c).cast("string"))
        elif c == "resource":
            envelope.append(F.lit(resource).alias("resource"))
        else:
            envelope.append(F.lit(None).cast("string").alias(c))
    ts = fetched_at if fetched_at is not None else F.lit("2024-02-01 00:00:00").cast("timestamp")
    return pages.select(*envelope, F.col("page_no").cast("int"), ts.alias("fetched_at"), "body",
                        F.lit(None).cast("string").alias("attempt_id"))


def _body(is_last: Column) -> Column:
    next_link = F.when(~is_last, F.concat(F.lit("next:"), (F.col("page_no") + 1).cast("string")))
    delta_link = F.when(is_last, F.col("delta_link"))
    return F.concat(F.lit('{"value":['), F.array_join("value", ","), F.lit("]"),
                    _links_json(next_link, delta_link), F.lit("}"))


def _pack_spread(items: DataFrame, chains: DataFrame, keys: list[str], order: list[str], page_size: int) -> DataFrame:
    """``keys, page_no, body`` of chains of any size, each spread over tasks."""
    paged = assign_pages(items, keys, order, page_size)
    pages = (paged.groupBy(*keys, "page_no")
             .agg(F.array_sort(F.collect_list(F.struct("item_pos", "item"))).alias("_v"))
             .select(*keys, "page_no", F.transform("_v", lambda e: e["item"]).alias("value")))
    counts = items.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    n = F.coalesce(F.col("_n"), F.lit(0))
    stats = (join_null_safe(chains, counts, keys, how="left")
             .select(*keys, "delta_link", n.alias("_n"),
                     F.greatest(F.ceil(n / F.lit(page_size)) - 1, F.lit(0)).cast("int").alias("_last")))
    empty = (stats.filter(F.col("_n") == 0)
             .select(*keys, F.lit(0).alias("page_no"), F.array().cast("array<string>").alias("value")))
    all_pages = pages.unionByName(empty)
    joined = join_null_safe(all_pages, stats.drop("_n"), keys)
    return joined.select(*keys, "page_no", _body(F.col("page_no") == F.col("_last")).alias("body"))


def _cut(chained: DataFrame, keys: list[str], page_size: int) -> DataFrame:
    """``keys, page_no, body`` of rows ``keys, items`` (``order + item``, any order), ``links`` (of each ask)."""
    s, size = F.col("_s"), F.lit(page_size)
    pages = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.size(s) / size) - 1, F.lit(0)).cast("int")),
                        lambda p: F.slice(s, p * size + 1, size))
    cut = (chained.withColumn("_s", F.sort_array("items"))  # used twice below, so it is not sorted again per page
           .withColumn("_last", F.greatest(F.ceil(F.size("_s") / size) - 1, F.lit(0)).cast("int"))
           # an empty chain that is there k times lands its page k times for each ask, as its spread form does
           .withColumn("links", F.when(F.size("_s") == 0, F.flatten(F.array_repeat("links", F.size("links")))).otherwise(F.col("links")))
           .select(*keys, "links", "_last", F.posexplode(pages).alias("page_no", "_v"))
           .select(*keys, "_last", "page_no", F.transform("_v", lambda e: e["item"]).alias("value"),
                   F.explode("links").alias("_link"))
           .withColumn("delta_link", F.col("_link.delta_link")))
    return cut.select(*keys, "page_no", _body(F.col("page_no") == F.col("_last")).alias("body"))


def pack_chained(chained: DataFrame, keys: list[str], page_size: int, resource: str, fetched_at: Column | None = None) -> DataFrame:
    """Landed pages of chains whose items are gathered: ``keys``, ``items`` (structs of the order and ``item``) and
    ``links`` (a struct with ``delta_link`` per ask). For chains of at most ``SMALL_CHAIN`` items."""
    return _envelope(_cut(chained, keys, page_size), keys, resource, fetched_at)


def crowded(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` of the chains with more than ``SMALL_CHAIN`` rows (numbers only: counted with map-side aggregation)."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > SMALL_CHAIN).select(*keys)


def pack_pages(items: DataFrame, chains: DataFrame, keys: list[str], order: list[str],
               page_size: int, resource: str, fetched_at: Column | None = None) -> DataFrame:
    """Items -> landed page envelopes (one row per page), the shape the API returns.

    ``items``: ``keys + order + item`` (item = JSON text). ``chains``: one row per chain with the
    ``keys`` and ``delta_link`` its last page carries (null for a chain without one). A chain with
    no item still lands one empty page, as the API answers with an empty list.
    Envelope columns not among ``keys`` are null.

    Chains of at most ``SMALL_CHAIN`` items and asks are gathered and cut in one shuffle; the others are
    spread over tasks (:func:`rank_within`).
    """
    entry = F.struct(*order, "item")
    rows = items.select(*keys, entry.alias("_item"), F.lit(None).cast("struct<delta_link:string>").alias("_ask"))
    asks = chains.select(*keys, F.lit(None).cast(rows.schema["_item"].dataType).alias("_item"),
                         F.struct(F.col("delta_link").cast("string").alias("delta_link")).alias("_ask"))
    large = written(crowded(rows.select(*keys).unionByName(asks.select(*keys)), keys), "crowded")
    all_small = large.isEmpty()
    both = rows.unionByName(asks)
    if not all_small:
        both = join_null_safe(both, sized(large), keys, "left_anti")
    chained = both.groupBy(*keys).agg(F.collect_list("_item").alias("items"), F.collect_list("_ask").alias("links"))
    pages = _cut(chained, keys, page_size)
    if not all_small:
        pages = pages.unionByName(_pack_spread(join_null_safe(items, sized(large), keys, "left_semi"),
                                               join_null_safe(chains, sized(large), keys, "left_semi"), keys, order, page_size))
    return _envelope(pages, keys, resource, fetched_at)
