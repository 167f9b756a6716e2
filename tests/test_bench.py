"""bench.py contract: one JSON line with metric, value, unit, queries, sf."""

from __future__ import annotations

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(
        os.environ,
        BENCH_SF_DIR="/root/testdata/sf0.001",
        BENCH_CPUS="2",
        BENCH_REPEATS="1",
        BENCH_KEYS="monthly_sales_trend,overall_kpis",
        BENCH_DRIVER_MEMORY="2g",
        BENCH_WARMUP_ROUNDS="0",
    )
    out = subprocess.run(
        [sys.executable, os.path.join(ROOT, "bench.py")],
        env=env, capture_output=True, text=True, timeout=600, check=True,
    ).stdout.strip().splitlines()
    assert len(out) == 1
    result = json.loads(out[0])
    assert result["unit"] == "sec" and result["sf"] == 0.001
    assert set(result["queries"]) == {"monthly_sales_trend", "overall_kpis"}
    assert result["value"] == round(sum(result["queries"].values()), 3)
