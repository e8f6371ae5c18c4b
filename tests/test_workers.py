"""Python workers on a cluster do not have this package on their path."""

import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]

SCRIPT = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
import __spark_entry__ as entry_points
from tablemend.plans import build_session
spark = build_session(master="local[2]", settings={{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2"}})
for name in ("html_unescape", "asset_presence", "asset_publish_counts"):
    print(name, entry_points.queries()[name](spark, "/root/testdata/sf0.001").count())
"""


def test_worker_functions_need_nothing_of_this_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    command = [sys.executable, "-c", SCRIPT]
    done = subprocess.run(command, cwd=tmp_path, capture_output=True, text=True, timeout=300, env=env)
    assert done.returncode == 0, done.stderr[-2000:]
    assert len(done.stdout.split()) == 6
