"""Run every registered query against its oracle: python tests/run_oracles.py [sf_dir] [names...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from compare import compare, duck  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from mailsync.session import build_session  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = build_session("local[8]")
    con = duck(sf_dir)
    qs, orc = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in orc:
                ok, msg = compare(df, con, orc[name])
            else:
                ok, msg = True, f"rows-only: {df.count()} rows"
        except Exception as exc:  # report and continue
            ok, msg = False, f"error: {str(exc)[:600]}"
        bad += 0 if ok else 1
        print(f"{'OK ' if ok else 'BAD'} {name:22s} {time.time() - t:6.1f}s {msg}", flush=True)
    print(f"{bad} failing")


if __name__ == "__main__":
    main()
