"""Driver contract: bench.py prints exactly one JSON line."""

import json
import os
import subprocess
import sys

import pytest

from conftest import ROOT

SF0001 = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF0001), reason="test data missing")
def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF0001, BENCH_CPUS="4")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "topk", "mvp_for_team"],
                         capture_output=True, text=True, env=env, timeout=600, cwd="/tmp")
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert out.returncode == 0 and len(lines) == 1
    result = json.loads(lines[0])
    assert result["metric"] == "total_query_seconds" and result["unit"] == "sec" and result["sf"] == 0.001
    assert set(result["queries"]) == {"views", "fit", "topk", "mvp_for_team"}
    assert result["value"] == pytest.approx(sum(result["queries"].values()), abs=0.01)
