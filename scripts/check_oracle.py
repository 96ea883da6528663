"""Run every registered query against its DuckDB oracle and print one line per query.

Usage: python scripts/check_oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sparesledger.plans.compare import compare, duckdb_connection  # noqa: E402
from sparesledger.plans.oracle import ORACLE_SQL  # noqa: E402
from sparesledger.plans.registry import QUERIES  # noqa: E402
from sparesledger.session import local_session  # noqa: E402


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = local_session()
    con = duckdb_connection(sf_dir)
    bad = 0
    for n in names:
        t = time.time()
        try:
            r = compare(spark, n, QUERIES[n], ORACLE_SQL[n], sf_dir, con)
            ok = r.ok
            msg = f"rows={r.spark_rows}/{r.oracle_rows} cols={r.columns_match} values={r.values_match}"
            if not ok:
                msg += " | " + " || ".join(r.detail)
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:600]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {n:28s} {time.time() - t:6.1f}s {msg}", flush=True)
    print(f"{len(names) - bad}/{len(names)} match")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
