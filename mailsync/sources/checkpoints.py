"""S8 / T4 storage: the checkpoint map as numbered versions, one Parquet partition each, on shared storage.

Layout under ``root``::

    place=<2n>/      the keys changed (or removed) by version n
    place=<2n + 1>/  the whole map as of version n, where it was compacted

A sync run writes only the tokens it changed. Writing a version again overwrites its partition, so a run or a
micro-batch that is replayed after a failure gives the same map. Readers take the newest row per key with
one aggregate; a removed key is a row with ``removed`` set. ``compact`` writes the whole map and then
deletes what it replaces, the oldest first: if it dies between, the newest rows are still the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailsync import schemas as S

STORED_DDL = S.CHECKPOINT_DDL + ", removed BOOLEAN"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def is_marked(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return fs.exists(p)


def mark(spark: SparkSession, path: str) -> None:
    """Leave an empty file that says that the step of this name is done."""
    p, fs = _fs(spark, path)
    fs.create(p, True).close()


def _places(spark: SparkSession, root: str) -> list[int]:
    path, fs = _fs(spark, root)
    names = [st.getPath().getName() for st in fs.listStatus(path)] if fs.exists(path) else []
    return sorted(int(n.split("=")[1]) for n in names if n.startswith("place="))


def latest_version(spark: SparkSession, root: str) -> int | None:
    places = _places(spark, root)
    return places[-1] // 2 if places else None


def _store(rows: DataFrame, root: str, place: int) -> None:
    rows.select("key", "delta", "version", "removed").write.mode("overwrite").parquet(f"{root.rstrip('/')}/place={place}")


def write_checkpoints(ckpt: DataFrame, root: str, version: int) -> None:
    """Write a map as ``version``. Rows keep their own ``version`` (the one that last changed the key) when they
    carry one; rows without it are stamped with this one."""
    v = F.col("version").cast("bigint") if "version" in ckpt.columns else F.lit(version).cast("bigint")
    _store(ckpt.select("key", "delta", v.alias("version"), F.lit(False).alias("removed")), root, 2 * version)


def write_delta(tokens: DataFrame, root: str, version: int, removed: DataFrame | None = None) -> None:
    """T4 on storage: the changed ``(key, delta)`` pairs, and the ``key``s of ``removed``, as ``version``."""
    latest = latest_version(tokens.sparkSession, root)
    if latest is not None and version < latest:
        raise ValueError(f"version {version} of {root} is older than {latest}")
    rows = tokens.select("key", "delta", F.lit(False).alias("removed"))
    if removed is not None:
        rows = rows.unionByName(removed.select("key", F.lit(None).cast("string").alias("delta"), F.lit(True).alias("removed")))
    _store(rows.withColumn("version", F.lit(version).cast("bigint")), root, 2 * version)


def scan_checkpoints(spark: SparkSession, root: str) -> DataFrame:
    """Every key with its current token: the newest row per key, if it is not a removal.

    Of rows of one key and version a removal wins, then the greatest delta."""
    if not _places(spark, root):
        return spark.createDataFrame([], S.CHECKPOINT_DDL)
    rows = spark.read.schema(STORED_DDL + ", place BIGINT").parquet(root)
    newest = rows.groupBy("key").agg(F.max(F.struct("place", "removed", "delta", "version")).alias("w"))
    return newest.filter(~F.col("w.removed")).select("key", "w.delta", "w.version")


def compact(spark: SparkSession, root: str) -> int | None:
    """Write the whole map as of the latest version and delete the older rows."""
    root, places = root.rstrip("/"), _places(spark, root)
    if not places or len(places) == 1:
        return places[-1] // 2 if places else None
    version = places[-1] // 2
    if places[-1] % 2 == 0:
        _store(scan_checkpoints(spark, root).withColumn("removed", F.lit(False)), root, 2 * version + 1)
    for place in places:
        if place < 2 * version + 1:
            path, fs = _fs(spark, f"{root}/place={place}")
            fs.delete(path, True)
    return version
