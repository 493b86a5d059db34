"""CLI: run queries() against oracle_sql() at a scale factor. Usage:
python tests/run_oracle.py [sf_dir] [name ...]"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle import compare, duck  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from tessera.session import get_session  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = get_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf)
    qs, sql = E.queries(), E.oracle_sql()
    ok = True
    for n in names or list(qs):
        t = time.time()
        try:
            df = qs[n](spark, sf)
            if n in sql:
                probs, rows = compare(df, con, sql[n], types=True)
            else:
                probs, rows = ["(no oracle)"], df.count()
        except Exception as e:  # report and go on
            probs, rows = [f"ERROR {type(e).__name__}: {str(e)[:400]}"], -1
        status = "OK " if not probs else ("-- " if probs == ["(no oracle)"] else "BAD")
        ok &= status != "BAD"
        print(f"{status} {n:22s} rows={rows:<7} {time.time() - t:5.1f}s {'; '.join(probs)}",
              flush=True)
    sys.exit(0 if ok else 1)


if __name__ == "__main__":
    main()
