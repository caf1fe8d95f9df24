"""bench.py prints one JSON line with the fields the driver records."""

import json
import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line(small_dir):
    env = dict(os.environ, BENCH_SF_DIR=small_dir, BENCH_CPUS="2", BENCH_QUERIES="select_priority,usage_daily")
    r = subprocess.run([sys.executable, "bench.py"], cwd=REPO, env=env, capture_output=True, text=True, timeout=600)
    assert r.returncode == 0, r.stderr[-2000:]
    lines = [ln for ln in r.stdout.splitlines() if ln.startswith("{")]
    assert len(lines) == 1
    out = json.loads(lines[0])
    assert out["unit"] == "sec" and out["metric"] and out["value"] > 0
    assert set(out["queries"]) == {"select_priority", "usage_daily"} and out["sf"] == 0.001
