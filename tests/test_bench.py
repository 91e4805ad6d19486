"""bench.py prints one JSON line on stdout, with the driver's fields."""

import json
import os
import subprocess
import sys

from conftest import SF_SMALL

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line(tmp_path):
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2", BENCH_REPEAT="1", BENCH_QUERIES="q4_trips_per_route")
    out = subprocess.run(
        [sys.executable, os.path.join(REPO, "bench.py")], cwd=tmp_path, env=env,
        capture_output=True, text=True, timeout=600, check=True,
    ).stdout.strip().splitlines()
    assert len(out) == 1
    result = json.loads(out[0])
    assert result["unit"] == "sec" and result["sf"] == 0.001
    assert set(result["queries"]) == {"q4_trips_per_route"} and result["value"] > 0
