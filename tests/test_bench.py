"""bench.py prints one JSON line with the fields the driver records."""

from __future__ import annotations

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_RUNS="1",
               BENCH_QUERIES="budget_base,date_dims", BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=600, check=True).stdout.strip().splitlines()
    record = json.loads(out[-1])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(record)
    assert record["unit"] == "sec" and record["sf"] == 0.001
    assert set(record["queries"]) == {"budget_base", "date_dims"} and not record["errors"]
    assert abs(record["value"] - sum(record["queries"].values())) < 0.01
