"""Run every registered query against its DuckDB oracle (or rows-only) and report.

usage: python tools/check_oracles.py [sf_dir] [name-substring ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from logscope.plans.catalog import all_queries  # noqa: E402
from logscope.plans.compare import compare, duckdb_connection  # noqa: E402
from logscope.session import build_session  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session("local[8]", 8)
    con = duckdb_connection(sf_dir)
    failures = 0
    for name, spec in sorted(all_queries().items()):
        if wanted and not any(w in name for w in wanted):
            continue
        t0 = time.time()
        try:
            df = spec.build(spark, sf_dir)
            if spec.sql:
                out = compare(name, df, con, spec.sql)
                status, detail, rows = ("OK" if out.ok else "FAIL"), out.detail, out.rows
            else:
                rows = df.count()
                status, detail = "ROWS", ""
        except Exception as exc:  # report and continue
            status, detail, rows = "ERROR", f"{type(exc).__name__}: {str(exc)[:400]}", -1
        failures += status in ("FAIL", "ERROR")
        print(f"{status:5s} {name:34s} rows={rows:<7d} {time.time() - t0:6.2f}s {detail}", flush=True)
    print(f"failures: {failures}")
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main())
