"""bench.py prints exactly one JSON line with the driver's keys."""

import json
import os
import subprocess
import sys

import pytest

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF, BENCH_CPUS="2", BENCH_QUERIES="contains_counts")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=600, check=True).stdout.strip().splitlines()
    assert len(out) == 1
    b = json.loads(out[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(b)
    assert b["unit"] == "sec" and b["sf"] == 0.001 and set(b["queries"]) == {"contains_counts"}
