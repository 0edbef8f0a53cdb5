"""Landed page envelopes: write, read and prune, flatten to items (P2, P3), generic responses.

A landed page is one row: ``resource, user_id, folder_id, message_id, request_token, page_no,
fetched_at, body`` where ``body`` is the API page ``{"value": [...], "@odata.nextLink": ...,
"@odata.deltaLink": ...}``. Items are kept as their raw JSON text; typed views parse them with an
explicit (and pruned) DDL, so only the asked-for fields are materialised.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailsync import constants as C
from mailsync import schemas as S
from mailsync.functions.fields import ddl_subset

LANDING_DATE = "landing_date"
BUCKET = "chain_bucket_"  # a partition column: the prefix, then the number of buckets
BUCKETS = 16
ROW_GROUP = 16 << 20


def read_pages(spark: SparkSession, path: str, resource: str | None = None,
               fmt: str = "parquet", since: str | None = None) -> DataFrame:
    """Read landed pages. Parquet landings are expected partitioned by ``resource``, chain bucket and landing
    date, so that the resource, ``since`` (a date: pages fetched from then on) and the chains of some work
    (``of_chains``) prune whole directories; JSON-lines landings are read with the fixed DDL."""
    reader = spark.read.schema(S.ENVELOPE_DDL) if fmt == "json" else spark.read
    df = reader.format(fmt).load(path)
    if "attempt_id" not in df.columns:  # landed before the envelope had it
        df = df.withColumn("attempt_id", F.lit(None).cast("string"))
    if resource is not None:
        df = df.filter(F.col("resource") == resource)
    if since is not None:
        landed = F.col(LANDING_DATE) if LANDING_DATE in df.columns else F.to_date("fetched_at")
        df = df.filter(landed >= F.lit(since).cast("date"))
    return df.drop(LANDING_DATE)


def bucket_of(buckets: int) -> Column:
    """The bucket of a chain: by its user, or by its token where it has none, so that a level's work finds it."""
    owner = F.coalesce(F.col("user_id"), F.concat(F.lit("token:"), F.col("request_token")), F.lit(""))
    return F.pmod(F.xxhash64(owner), F.lit(buckets)).cast("int")


def write_pages(pages: DataFrame, path: str, pages_per_file: int = 20_000, mode: str = "errorifexists", buckets: int = BUCKETS) -> None:
    """Land pages as Parquet partitioned by ``resource``, chain bucket and landing date (the day of ``fetched_at``),
    in files of at most ``pages_per_file`` pages and row groups of ``ROW_GROUP`` bytes: readers then split a landing into many tasks (a
    Parquet file splits only at row-group boundaries), and its number of files stays small. Rows of a bucket are gathered before (large buckets
    stay spread), so that a bucket is a few files, not one per task."""
    column = f"{BUCKET}{buckets}"
    (pages.select(*S.ENVELOPE_DDL_COLS).withColumn(column, bucket_of(buckets)).withColumn(LANDING_DATE, F.to_date("fetched_at"))
     .hint("rebalance", F.col("resource"), F.col(column))
     .write.mode(mode).option("maxRecordsPerFile", pages_per_file).option("parquet.block.size", ROW_GROUP).partitionBy("resource", column, LANDING_DATE).parquet(path))


def of_chains(pages: DataFrame, work: DataFrame) -> DataFrame:
    """``pages`` of the buckets that hold chains of ``work``; all of them where the landing has no buckets.

    Bucket numbers reach the driver, so that they prune directories when the scan is planned."""
    column = next((c for c in pages.columns if c.startswith(BUCKET)), None)
    if column is None:
        return pages
    buckets = int(column[len(BUCKET):])
    for c in ("user_id", "request_token"):
        if c not in work.columns:
            work = work.withColumn(c, F.lit(None).cast("string"))
    wanted = [r.b for r in work.select(bucket_of(buckets).alias("b")).distinct().collect()]  # at most ``buckets`` numbers
    return pages if len(wanted) == buckets else pages.filter(F.col(column).isin(wanted))


def parse_body(body="body") -> Column:
    """The page body as ``STRUCT<value ARRAY<STRING>, nextLink, deltaLink>`` (items keep their text)."""
    b = F.col(body) if isinstance(body, str) else body
    return F.from_json(b, S.PAGE_BODY_DDL)


LINKS_DDL = "`@odata.nextLink` STRING, `@odata.deltaLink` STRING, _corrupt STRING"


def with_links(pages: DataFrame) -> DataFrame:
    """Adds ``next_link``, ``delta_link`` and ``page_ok`` read from the body in one pass that skips
    the item list (only the link fields are in the schema, so the items are never materialised).
    ``page_ok`` is false for a null body or one that is not JSON (its text lands in the corrupt
    record column of the same parse)."""
    p = F.from_json(F.col("body"), LINKS_DDL, {"columnNameOfCorruptRecord": "_corrupt"})
    return (pages.withColumn("_page", p)
            .withColumn("next_link", F.col("_page").getField(C.NEXT_LINK))
            .withColumn("delta_link", F.col("_page").getField(C.DELTA_LINK))
            .withColumn("page_ok", F.col("_page").isNotNull() & F.col("_page._corrupt").isNull())
            .drop("_page"))


def flatten_pages(pages: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """P2 + P3: page -> items, each item's JSON text untouched (tombstones included).

    Null pages, pages that do not parse, and empty lists give no item (``posexplode``, not the
    outer form). ``item_pos`` keeps the order inside a page; (``page_no``, ``item_pos``) is the
    order inside a chain.
    """
    cols = keep if keep is not None else [c for c in pages.columns if c != "body"]
    return pages.select(*cols, F.posexplode(parse_body().getField("value")).alias("item_pos", "item"))


def item_field(name: str, item="item") -> Column:
    """One top-level string field of an item (``id`` for record attributes)."""
    i = F.col(item) if isinstance(item, str) else item
    return F.get_json_object(i, f"$.{name}")


def parse_items(items: DataFrame, ddl: str, fields: str | None = None, item: str = "item",
                keep: list[str] | None = None) -> DataFrame:
    """Typed view of items with only the listed fields parsed (P1 on raw JSON)."""
    sub = ddl_subset(ddl, fields)
    cols = keep if keep is not None else [c for c in items.columns if c != item]
    return items.select(*cols, F.from_json(F.col(item), sub, S.JSON_TS_OPTIONS).alias("_e")).select(
        *cols, "_e.*")


def is_tombstone(item="item") -> Column:
    """A delta-feed removal: the item carries ``@removed``."""
    i = F.col(item) if isinstance(item, str) else item
    return F.get_json_object(i, "$['@removed']").isNotNull()


# ---- generic responses ----------------------------------------------------------------------------

def scan_generic(responses: DataFrame, content: str = "content") -> DataFrame:
    """One response object per request, kept whole; parsed once as ``VARIANT`` for lookups."""
    return responses.withColumn("response", F.try_parse_json(F.col(content)))


def generic_records(requests: DataFrame, responses: DataFrame, on: str = "request_id",
                    content: str = "content") -> DataFrame:
    """S7 as records: each response under its request's attributes, on ``Success``.

    ``requests`` has ``on`` and ``attributes``; a request without a response gives nothing."""
    return (responses.select(on, F.col(content).alias("response")).join(requests.select(on, "attributes"), on=on, how="inner")
            .select(F.lit(C.ROUTE_SUCCESS).alias("route"), "attributes", F.col("response").alias("content"),
                    F.lit(C.EMIT_ITEM).cast("bigint").alias("emit_seq")))
