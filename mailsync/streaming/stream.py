"""The repeated trigger as Structured Streaming over landed page files (and T5 on a stream).

A stream reads the landing (flat, or partitioned as ``write_pages`` does; the file source's own log knows which
files were taken, whatever dates their pages bear), keeps of each page its links and the place where it lies,
and lets the chain state (:mod:`mailsync.streaming.chains`, ``transformWithState``) decide which pages count
and which tokens are new. Each micro-batch writes these decisions once, reads the bodies of the decided pages
from the files named in them, and writes records and tokens under its batch number. No body crosses a
shuffle or lies in the state, so a folder with a third of all pages is small rows in one task and bodies
spread over its files.

Crashes: state, offsets and file log are Spark's own; a batch that is replayed decides the same and overwrites
its own partitions. All state lies on shared storage.

``sync_stream`` follows messages. ``sync_tenant_stream`` runs one stream per level: each takes the records
of the level above as a second source, which makes its entities known (J4), and attachments are a stateful
join of message records and attachment pages. Any order of landing gives the same records.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailsync import constants as C
from mailsync import schemas as S
from mailsync.functions.checks import token_changed
from mailsync.functions.keys import filter_keys, folders_key, messages_key, parse_key, users_key
from mailsync.operators.attempts import with_attempt
from mailsync.operators.joins import sized
from mailsync.operators.routes import union_records
from mailsync.operators.state import token_records
from mailsync.plans import sync as SY
from mailsync.session import written
from mailsync.sources import checkpoints as CK
from mailsync.sources.pages import ROW_GROUP, with_links
from mailsync.streaming.chains import FROM, GIVEN, GROUPS, PACKED, EntityChains, GroupChains

STATE_CONF = {"spark.sql.streaming.stateStore.providerClass":
              "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


class Level(NamedTuple):
    """One resource's entities: the columns that name one, its checkpoint key, and its records."""
    resource: str
    entity: tuple[str, str]     # envelope columns; '' where there is none
    pattern: str
    prefix: str
    key: Callable[[], Column] | None
    records: Callable[[DataFrame], DataFrame]
    route: str


LEVELS = {
    "users": Level("users", ("", ""), C.REGEX_USERS_DEFAULT, C.KEY_USERS, users_key, SY.user_records, C.ROUTE_SUCCESS),
    "folders": Level("folders", ("user_id", ""), C.REGEX_FOLDERS_DEFAULT, C.KEY_FOLDERS_PREFIX,
                     lambda: folders_key("one"), SY.folder_records, C.ROUTE_SUCCESS),
    "messages": Level("messages", ("user_id", "folder_id"), C.REGEX_MESSAGES_DEFAULT, C.KEY_MESSAGES_PREFIX,
                      lambda: messages_key("one", "two"), SY.message_records, C.ROUTE_SUCCESS_MESSAGES),
    "attachments": Level("attachments", ("user_id", "message_id"), "", "", None, SY.attachment_records, C.ROUTE_SUCCESS_ATTACHMENTS),
}


@contextmanager
def _state_store(spark: SparkSession):
    """The session with RocksDB as state store, as it was afterwards."""
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stream_pages(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None,
                 max_bytes_per_trigger: int = 64 << 30) -> DataFrame:
    """Landed page files as a stream (fixed DDL; no inference), bounded by bytes or by files."""
    reader = spark.readStream.schema(S.ENVELOPE_DDL)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    else:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.parquet(landing_dir)


def _entity(level: Level) -> list[Column]:
    return [(F.col(c) if c else F.lit("")).alias(name) for c, name in zip(level.entity, ("one", "two"), strict=True)]


def page_rows(pages: DataFrame, level: Level) -> DataFrame:
    """What the chain state needs of a page, and where the page lies; no body."""
    named = F.lit(True)
    for c in level.entity:
        named = named & (F.col(c).isNotNull() if c else F.lit(True))
    p = pages.filter((F.col("resource") == level.resource) & named).select("*", "_metadata.file_path", "_metadata.row_index")
    p = with_links(with_attempt(p)).filter("page_ok")
    return p.select(F.lit("page").alias("kind"), *_entity(level), F.coalesce("request_token", F.lit("")).alias("token"), "attempt",
                    F.coalesce("page_no", F.lit(0)).alias("page_no"), "at", F.col("next_link").isNull().alias("ends"),
                    F.col("delta_link").alias("link"), F.col("file_path").alias("file"), F.col("row_index").alias("place"))


def _parent_rows(records: DataFrame, level: Level) -> DataFrame:
    """The entities that records of the level above make known."""
    if level.key is None:  # each message record, with its attributes
        found = SY.attachment_parents(records, dedupe=False).select(
            F.col("user_id").alias("one"), F.col("message_id").alias("two"),
            F.to_json(F.array_sort(F.map_entries("parent_attrs"))).alias("link"))
    else:
        key = parse_key(F.col("attributes")[C.ATTR_CACHE_KEY], want_folder=bool(level.entity[1]))
        items = records.filter((F.col("emit_seq") == C.EMIT_ITEM) & key["key_ok"])
        found = items.select(key["user"].alias("one"), (key["folder"] if level.entity[1] else F.lit("")).alias("two"),
                             F.lit(None).cast("string").alias("link"))
    return found.selectExpr("'parent' AS kind", "one", "two", "'' AS token", "'' AS attempt", "0 AS page_no", "0L AS at", "false AS ends",
                            "link", "cast(null AS string) AS file", "0L AS place")


def _stored_tokens(ckpt: DataFrame, level: Level) -> DataFrame:
    """``one, two, token`` of the level's entities that the map knows."""
    keys = filter_keys(ckpt.select("key", "delta"), level.pattern, level.prefix)
    parts = parse_key(F.col("key"), want_folder=bool(level.entity[1]))
    known = SY.work_from(keys.filter(parts["key_ok"]) if level.entity[0] else keys)
    own = [parts["user"] if level.entity[0] else F.lit(""), parts["folder"] if level.entity[1] else F.lit("")]
    return known.select(own[0].alias("one"), own[1].alias("two"), F.col("request_token").alias("token")).dropDuplicates(["one", "two"])


def _group() -> Column:
    return F.pmod(F.xxhash64("one", "two"), F.lit(GROUPS)).cast("int").alias("part")


def _to_group(rows: DataFrame) -> DataFrame:
    """Rows of the columns ``FROM`` as :class:`GroupChains` takes them."""
    names = [c.split()[0] for c in FROM.split(", ")]
    return rows.select(_group(), F.to_json(F.array(*[F.col(c).cast("string") for c in names])).alias("row"))


def _known_to_group(known: DataFrame) -> DataFrame:
    """Stored tokens, a row per group (each row is a call)."""
    return known.groupBy(_group()).agg(F.to_json(F.collect_list(F.array("one", "two", "token"))).alias("row"))


def _from_group(given: DataFrame) -> DataFrame:
    """The decisions of :class:`GroupChains` as rows of ``GIVEN``."""
    rows = given.select(F.explode(F.from_json("given", "array<array<string>>")).alias("g"))
    return rows.select(*[F.col("g")[i].cast(kind).alias(name) for i, (name, kind) in enumerate(c.split() for c in GIVEN.split(", "))])


def _decided_pages(spark: SparkSession, landing_dir: str, decided: DataFrame) -> DataFrame:
    """The landed pages that ``decided`` names, bodies included: only the files that hold one are read."""
    files = [unquote(r.file) for r in decided.select("file").distinct().collect()]  # at most the files of a few batches
    if not files:
        return spark.createDataFrame([], S.ENVELOPE_DDL + ", parent STRING")
    pages = (spark.read.schema(S.ENVELOPE_DDL).option("basePath", landing_dir).parquet(*files)
             .select(*S.ENVELOPE_DDL_COLS, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place")))
    return pages.join(sized(decided.select("file", "place", "parent")), ["file", "place"]).drop("file", "place")


def _write_batch(spark: SparkSession, level: Level, landing_dir: str, state_root: str, out_dir: str, compact_every: int):
    root = f"{state_root}/checkpoints"

    def run(batch: DataFrame, batch_id: int) -> None:
        path = f"{state_root}/decisions/batch={batch_id}"
        _from_group(batch).write.mode("overwrite").parquet(path)  # the state's work is done once
        decided = spark.read.schema(GIVEN).parquet(path)
        pages = _decided_pages(spark, landing_dir, decided.filter("kind = 'page'"))
        if level.key is None:
            entries = F.from_json("parent", "array<struct<key:string,value:string>>")
            records = level.records(pages.withColumn("parent_attrs", F.map_from_entries(entries)))
            records.write.mode("overwrite").parquet(f"{out_dir}/batch={batch_id}")
            return
        tokens = decided.filter("kind = 'token'").select(level.key().alias("key"), F.col("token").alias("delta"), F.col("link").alias("new_delta"))
        union_records(level.records(pages), token_records(tokens, level.route)).write.mode("overwrite").parquet(f"{out_dir}/batch={batch_id}")
        moved = decided.filter((F.col("kind") == "token") & token_changed("token", "link"))
        # the last of the tokens that followed each other is the one no other starts from
        last = moved.join(moved.select("one", "two", F.col("token").alias("link")), ["one", "two", "link"], "left_anti")
        CK.write_delta(last.select(level.key().alias("key"), F.col("link").alias("delta")), root, batch_id + 1)
        if compact_every and (batch_id + 1) % compact_every == 0:
            CK.compact(spark, root)

    return run


def _run_level(spark: SparkSession, level: Level, landing_dir: str, state_root: str, out_dir: str, processor: EntityChains,
               initial_ckpt: DataFrame | None, parents: DataFrame | None = None, max_files_per_trigger: int | None = None,
               compact_every: int = 20) -> None:
    """Run a level's stream over everything there so far (``availableNow``) and return when done."""
    root, initial = f"{state_root}/checkpoints", f"{state_root}/initial"
    if level.key is not None and CK.latest_version(spark, initial) is None:  # attachments have no tokens
        start = initial_ckpt if initial_ckpt is not None else spark.createDataFrame([], S.CHECKPOINT_DDL)
        CK.write_checkpoints(start, root, 0)
        CK.write_checkpoints(CK.scan_checkpoints(spark, root), initial, 0)
    rows = page_rows(stream_pages(spark, landing_dir, max_files_per_trigger), level)
    if parents is not None:
        rows = rows.unionByName(_parent_rows(parents, level))
    # read by the first batch only, also when that is replayed: never the map as that batch has left it
    known = None if level.key is None else _known_to_group(_stored_tokens(CK.scan_checkpoints(spark, initial), level)).groupBy("part")
    with _state_store(spark):
        given = _to_group(rows).groupBy("part").transformWithState(
            GroupChains(processor), outputStructType=PACKED, outputMode="append", timeMode="none", initialState=known)
        query = (given.writeStream.foreachBatch(_write_batch(spark, level, landing_dir, state_root, out_dir, compact_every))
                 .option("checkpointLocation", f"{state_root}/stream").trigger(availableNow=True).start())
        query.awaitTermination()


def sync_stream(spark: SparkSession, landing_dir: str, state_root: str, out_dir: str,
                initial_ckpt: DataFrame | None = None, dedupe: bool = True,
                max_files_per_trigger: int | None = None, compact_every: int = 20) -> None:
    """Messages of every known folder from its token on, and of unknown folders as full loads."""
    _run_level(spark, LEVELS["messages"], landing_dir, state_root, out_dir, EntityChains(dedupe), initial_ckpt,
               max_files_per_trigger=max_files_per_trigger, compact_every=compact_every)


def sync_landing(spark: SparkSession, landing: str, state_root: str, out_dir: str, initial_ckpt: DataFrame | None = None,
                 compact_every: int = 20) -> None:
    """One incremental run over a landing: all files that no earlier run has taken."""
    sync_stream(spark, landing, state_root, out_dir, initial_ckpt, compact_every=compact_every)


def sync_tenant_stream(spark: SparkSession, landing_dir: str, state_root: str, out_dir: str, initial_ckpt: DataFrame | None = None,
                       max_files_per_trigger: int | None = None, compact_every: int = 20) -> None:
    """The whole tenant, a stream per level: users, folders, messages, attachments.

    Users start from their stored token (J2: a full load without one). An entity of a level below is synced if
    the map knows it or a record of the level above names it."""
    above = None
    if initial_ckpt is not None and CK.latest_version(spark, f"{state_root}/level=users/initial") is None:
        initial_ckpt = written(initial_ckpt, "initial")  # computed once, though each level starts from it
    for name, level in LEVELS.items():
        out = f"{out_dir}/level={name}"
        spark.createDataFrame([], S.RECORD_DDL).write.mode("overwrite").parquet(f"{out}/batch=-1")  # for the level below to read
        parents = spark.readStream.schema(S.RECORD_DDL).parquet(above) if above else None
        _run_level(spark, level, landing_dir, f"{state_root}/level={name}", out,
                   EntityChains(waits_for_parent=name != "users", per_parent=name == "attachments"),
                   initial_ckpt, parents, max_files_per_trigger, compact_every)
        above = out


def scan_waiting(spark: SparkSession, state_root: str) -> DataFrame:
    """The pages that wait as of the last commit, from the state store itself: ``one, two, token, attempt, page_no``."""
    with _state_store(spark):
        leaves = spark.read.format("statestore").option("stateVarName", "leaves").load(f"{state_root}/stream")
        k = F.from_json("key", "array<string>")
        return (leaves.select(F.explode(F.map_keys(F.from_json("user_map_value.entries", "map<string,string>"))).alias("key"))
                .select(k.alias("k")).filter("k[0] = 'page'")
                .selectExpr("k[1] AS one", "k[2] AS two", "k[3] AS token", "k[4] AS attempt", "int(k[5]) AS page_no"))


def read_stream_output(spark: SparkSession, out_dir: str) -> DataFrame:
    return spark.read.schema(S.RECORD_DDL + ", batch BIGINT").parquet(out_dir).select("route", "attributes", "content", "emit_seq")


def read_tenant_output(spark: SparkSession, out_dir: str) -> DataFrame:
    return spark.read.schema(S.RECORD_DDL + ", level STRING, batch BIGINT").parquet(out_dir).select("route", "attributes", "content", "emit_seq")


def land_files(pages: DataFrame, landing_dir: str, n_files: int, mode: str = "append") -> None:
    """Write landed pages as ``n_files`` files ranged by page number (later pages, later files),
    the way pages of one chain arrive over several triggers."""
    (pages.select(*S.ENVELOPE_DDL_COLS).repartitionByRange(n_files, "page_no")
     .write.mode(mode).option("parquet.block.size", ROW_GROUP).parquet(landing_dir))
