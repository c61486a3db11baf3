"""Run registered queries in Spark and their oracle SQL in DuckDB; compare
row counts, column names, types and order-insensitive values.

    python scripts/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfwise.plans.catalog import oracle_sql, queries  # noqa: E402
from shelfwise.plans.oracle import compare, duckdb_views  # noqa: E402
from shelfwise.session import build_session  # noqa: E402


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    spark = build_session("local[8]", 8)
    con = duckdb_views(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf_dir)
            if name not in sqls:
                n = sdf.count()
                print(f"ROWS  {name}: {n} rows, spark {time.time() - t0:.1f}s (no oracle)")
                continue
            problems = compare(sdf, sqls[name], con)
        except Exception as e:  # noqa: BLE001
            print(f"FAIL  {name}: {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        bad += bool(problems)
        status = "OK  " if not problems else "DIFF"
        print(f"{status}  {name}: {time.time() - t0:.1f}s {'; '.join(problems)}")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
