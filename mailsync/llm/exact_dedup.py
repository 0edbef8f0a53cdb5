"""Exact dedup as a stateful stream, with built-in functions only.

Texts are equal when identical after every run of ``[\\x20\\x09-\\x0D]`` is replaced by one blank;
null counts as empty. Rows stream through a keyed state in RocksDB (on the executors' disks, with
snapshots in the shared folder). The state never expires; per digest it holds the smallest stable
identifier, that row's content locator and the number of rows. A digest that is met again is a
*hit*: the hits' full bytes are then compared with those at the locator, and rows that differ from
them (digests that collide) form groups of their own by their full text.

``land`` adds rows with digest and locator to the stream's source (a locator is the landing's number, which
grows with time, and a row number in it, so rows of any number of landings never share one), ``absorb`` runs
the stream over whatever has landed since its last run and commits each micro-batch as a table of its own
under the batch number, so a batch that is replayed after a failure overwrites itself. ``settle``
compares the bytes of all that has landed. ``exact_dedup`` does all three for one table.

Copies of one text may be a third of all rows: the state's aggregate combines them before the
shuffle, and for the byte check each group's first text is sent once per ``SALT_ROWS`` copies, so
that no task gets a whole group.

Edge cases: rows with the same ``doc_id`` are rows of their own (``group_size`` counts rows; of equal
rows one stays, the first landed); a null ``doc_id`` sorts after all others; extra columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailsync.llm.frames import written
from mailsync.session import scratch_path

SALT_ROWS = 256
BROADCAST_GROUPS = 100_000  # 20 MB of digests that were met again; more are joined by a shuffle
LAST_ID = (1 << 63) - 1  # stands for a null doc_id in comparisons
FILES_PER_BATCH = 1000
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",
    "spark.sql.streaming.stateStore.maintenanceInterval": "10s",  # state of a finished run leaves the executors soon
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # else 4 MB of disk per state partition
}
LOCATOR = "struct<landing:long,row:long>"
LANDED = f"doc_id long, digest string, n_bytes long, locator {LOCATOR}"
FIRST = f"struct<id:long,locator:{LOCATOR},doc_id:long>"
STATE = f"digest string, n_bytes long, first {FIRST}, n long"


def normal_text(text: Column) -> Column:
    """Null as empty, each white-space run as one blank; only runs that change are matched."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")),
                            r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def land(docs: DataFrame, path: str, digest: Callable[[Column], Column] = lambda sha: sha) -> None:
    """Add every row of ``docs`` (as ``row``) with its digest and a locator of its own to the landing.

    ``digest`` makes the state's key from the text's SHA-256; byte checks make any choice exact.
    """
    text = normal_text(F.col("text"))
    (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                 F.sha2(text.cast("binary"), 256).alias("text_sha256"), F.octet_length(text).cast("bigint").alias("n_bytes"),
                 F.struct(F.lit(time.time_ns()).alias("landing"), F.monotonically_increasing_id().alias("row")).alias("locator"))
     .withColumn("digest", digest(F.col("text_sha256"))).write.mode("append").parquet(path))


def absorb(spark: SparkSession, landing: str, state: str) -> DataFrame:
    """Stream what has landed into the keyed state; return the state's rows so far."""
    updates = f"{state}/updates"
    schema = f"{STATE}, batch long"
    spark.createDataFrame([], schema).coalesce(1).write.mode("ignore").partitionBy("batch").parquet(updates)

    def commit(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{updates}/batch={number}")

    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        first = F.struct(F.coalesce("doc_id", F.lit(LAST_ID)).alias("id"), "locator", "doc_id")
        keyed = (spark.readStream.schema(LANDED).option("maxFilesPerTrigger", FILES_PER_BATCH).parquet(landing)
                 .groupBy("digest", "n_bytes").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("n")))
        (keyed.writeStream.outputMode("update").option("checkpointLocation", f"{state}/checkpoint")
         .foreachBatch(commit).trigger(availableNow=True).start().awaitTermination())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    rows = spark.read.schema(schema).parquet(updates)
    return rows.groupBy("digest", "n_bytes").agg(F.min("first").alias("first"), F.max("n").alias("n"))


def settle(landed: DataFrame, groups: DataFrame) -> DataFrame:
    """Every landed row with its group after comparing the full bytes of all hits."""
    keys = ["digest", "n_bytes"]
    rows = landed.select("locator", "doc_id", *keys, "text_sha256").join(groups, keys)
    met_again = groups.filter("n > 1")
    if met_again.count() <= BROADCAST_GROUPS:
        met_again = F.broadcast(met_again)
    hits = written(landed.join(met_again, keys)
                   .select("locator", *keys, "first", F.ceil(F.col("n") / SALT_ROWS).alias("salts"),
                           normal_text(F.col("row.text")).alias("text")), "op4-hits")
    firsts = (hits.filter("locator = first.locator")
              .select(*keys, F.col("text").alias("first_text"), F.explode(F.expr("sequence(0L, salts - 1)")).alias("salt")))
    copies = (hits.filter("locator != first.locator")
              .select(*keys, "text", F.pmod(F.xxhash64("locator"), "salts").alias("salt")))
    differing = written(copies.join(firsts, [*keys, "salt"]).filter("text != first_text").select(*keys).distinct(),
                        "op4-differing")
    columns = ["locator", "doc_id", "text_sha256", "first", "n"]
    if differing.isEmpty():
        return rows.select(columns)
    collided = landed.join(differing, keys, "left_semi").select(
        "locator", "doc_id", "text_sha256", *keys, normal_text(F.col("row.text")).alias("text"))
    first = F.struct(F.coalesce("doc_id", F.lit(LAST_ID)).alias("id"), "locator", "doc_id")
    by_text = collided.groupBy("text").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("n"))
    return (rows.join(differing, keys, "left_anti").select(columns)
            .union(collided.join(by_text, "text").select(columns)))


def _deduplicated(docs: DataFrame, digest: Callable[[Column], Column]) -> tuple[DataFrame, DataFrame]:
    spark = docs.sparkSession
    root = scratch_path(spark, "op4")
    land(docs, f"{root}/landing", digest)
    groups = written(absorb(spark, f"{root}/landing", f"{root}/state"), "op4-groups")
    landed = spark.read.parquet(f"{root}/landing")
    return landed, settle(landed, groups)


def exact_dedup(docs: DataFrame, digest: Callable[[Column], Column] = lambda sha: sha) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    _, settled = _deduplicated(docs, digest)
    return settled.select("doc_id", F.col("first.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
                          (F.col("locator") == F.col("first.locator")).alias("kept"), "text_sha256")


def first_rows(landed: DataFrame, settled: DataFrame) -> DataFrame:
    """The landed rows that are no copies of another, with the columns they were landed with."""
    stay = settled.filter("locator = first.locator").select("locator")
    return landed.join(stay, "locator", "left_semi").select("row.*")


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that are copies of another, columns unchanged."""
    return first_rows(*_deduplicated(docs, lambda sha: sha))
