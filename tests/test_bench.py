"""bench.py prints one JSON line with the fields the driver records."""

from __future__ import annotations

import json
import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF, BENCH_CPUS="2",
               BENCH_QUERIES="year_bounds,avg_price", BENCH_DRIVER_MEM="2g")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env,
                         capture_output=True, text=True, timeout=600, check=True).stdout
    lines = [ln for ln in out.splitlines() if ln.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["sf"] == "0.001" and d["metric"]
    assert set(d["queries"]) == {"year_bounds", "avg_price"}
    assert d["value"] == pytest.approx(sum(d["queries"].values()), abs=0.01)
    assert "failed" not in d
