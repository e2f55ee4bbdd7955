"""Time the oracle SQL of every registered query on DuckDB (the reference's
engine) on the same tables: the single-node number the Spark runs compare to.

Usage: python scripts/duckdb_baseline.py [sf_dir] [threads]
Prints one JSON line shaped like bench.py's output.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from medallion.flow_queries import FLOW_SQL  # noqa: E402
from medallion.queries import ORACLE_SQL  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    threads = int(sys.argv[2]) if len(sys.argv) > 2 else 8
    con = duckdb.connect()
    con.execute(f"SET threads = {threads}")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")

    def run(sql: str) -> float:
        t0 = time.perf_counter()
        con.sql(sql).fetch_arrow_table()
        return time.perf_counter() - t0

    times = {}
    for name, sql in {**ORACLE_SQL, **FLOW_SQL}.items():
        run(sql)
        times[name] = round(statistics.median(run(sql) for _ in range(3)), 4)
    print(json.dumps({"metric": "total_query_sec", "value": round(sum(times.values()), 4), "unit": "sec",
                      "engine": f"duckdb {duckdb.__version__}", "threads": threads, "queries": times,
                      "sf": sf_dir.rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
