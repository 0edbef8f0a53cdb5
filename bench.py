"""Benchmark: the headline sync queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

The tenant's API pages are landed once (Parquet, partitioned by resource), as a deployment would
receive them; the timed queries then read the landing, like the sync jobs do in production.
Each query is run to completion with the ``noop`` sink (no driver collection). Prints one JSON
line: ``{"metric", "value" (sum of query seconds), "unit", "queries", "sf", ...}``.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from mailsync.operators.dedupe import dedupe_replay  # noqa: E402
from mailsync.plans import queries as Q  # noqa: E402
from mailsync.plans import sync as SY  # noqa: E402
from mailsync.plans import testviews as TV  # noqa: E402
from mailsync.session import build_session, scratch_path  # noqa: E402
from mailsync.sources.pages import read_pages, write_pages  # noqa: E402
from mailsync.streaming import stream as STR  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(2 * cpus, 8),
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    root = scratch_path(spark, "bench")
    landing = f"{root}/landing"

    t0 = time.time()
    write_pages(TV.land_all(spark, sf_dir), landing)
    land_sec = time.time() - t0
    pages = read_pages(spark, landing)
    # the checkpoint tables exist before a sync starts: write them once, outside the timings
    TV.checkpoints(spark, sf_dir).write.parquet(f"{root}/checkpoints")
    Q._changes_work(spark, sf_dir).write.parquet(f"{root}/work")
    ckpt, work = spark.read.parquet(f"{root}/checkpoints"), spark.read.parquet(f"{root}/work")

    timings: dict[str, float] = {}

    def timed(name, fn):
        t = time.time()
        fn()
        timings[name] = round(time.time() - t, 3)

    def messages_delta():
        recs, _, _ = SY.sync_messages(pages, work)
        run(Q.message_view(recs))

    def message_attachments():
        run(SY.expand_attachments(SY.scan_message_records(pages), pages))

    def dedupe():
        again = pages.withColumn("fetched_at", F.col("fetched_at") + F.expr("INTERVAL 5 MINUTES"))
        recs, _, _ = SY.sync_messages(pages.unionByName(again), work, dedupe=False)
        run(dedupe_replay(recs))

    def users_delta():
        recs, _ = SY.sync_users(pages, ckpt)
        run(recs)

    def tenant_sync():
        recs, toks, _ = SY.sync_tenant(pages, ckpt)  # writes every level

    def stream_sync():
        sroot = scratch_path(spark, "bench-stream")
        msg = pages.filter((F.col("resource") == "messages") & F.col("folder_id").isNotNull())
        STR.land_files(msg, f"{sroot}/landing", 3)
        ck = work.withColumn("version", F.lit(0).cast("bigint"))
        STR.sync_stream(spark, f"{sroot}/landing", f"{sroot}/state", f"{sroot}/out", initial_ckpt=ck,
                        dedupe=True, max_files_per_trigger=1)

    timed("messages_delta", messages_delta)
    timed("message_attachments", message_attachments)
    timed("dedupe_replay", dedupe)
    timed("users_delta", users_delta)
    timed("tenant_sync", tenant_sync)
    timed("stream_sync", stream_sync)

    out = {"metric": "headline_sync_seconds", "value": round(sum(timings.values()), 3), "unit": "sec",
           "queries": timings, "sf": sf, "cpus": cpus, "landing_sec": round(land_sec, 3)}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
