"""Time the DuckDB oracle SQL per key on one scale factor (single-node reference point).

    python tools/duck_timing.py /root/testdata/sf0.1
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerline.oracle.sql import oracle_sql  # noqa: E402
from tools.check_oracle import duck_connect  # noqa: E402


def main(sf_dir: str, runs: int = 3) -> None:
    con = duck_connect(sf_dir)
    times = {}
    for name, sql in oracle_sql().items():
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            con.execute(f"SELECT count(*) FROM ({sql})").fetchall()
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
    print(json.dumps({"engine": "duckdb", "sf_dir": sf_dir, "total": round(sum(times.values()), 3),
                      "queries": times}))


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
