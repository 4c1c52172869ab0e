"""bench.py prints one JSON line with the fields the driver records."""

from __future__ import annotations

import json
import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2",
               BENCH_ONLY="q_bool_label,q_unpivot_attributes", BENCH_REPS="1")
    out = subprocess.run([sys.executable, str(ROOT / "bench.py")], env=env, capture_output=True, text=True,
                         timeout=600, check=True).stdout.strip().splitlines()
    rec = json.loads(out[-1])
    assert rec["unit"] == "sec" and rec["sf"] == 0.001 and rec["failed"] == {}
    assert set(rec["queries"]) == {"q_bool_label", "q_unpivot_attributes"}
    assert abs(rec["value"] - sum(rec["queries"].values())) < 1e-6
