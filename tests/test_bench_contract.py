"""bench.py prints exactly one JSON line with the driver's keys."""

import json
import os
import subprocess
import sys


def test_bench_prints_one_json_line():
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2",
               BENCH_REPEAT="1", BENCH_QUERIES="pickup_cells,trending_pickup_grid")
    r = subprocess.run([sys.executable, "bench.py"], cwd=repo, env=env, capture_output=True,
                       text=True, timeout=600)
    assert r.returncode == 0, r.stderr[-2000:]
    lines = [ln for ln in r.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    out = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(out)
    assert out["unit"] == "sec" and out["sf"] == 0.001
    assert set(out["queries"]) == {"pickup_cells", "trending_pickup_grid"}
