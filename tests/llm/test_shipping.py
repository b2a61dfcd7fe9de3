"""Queries run where only the driver finds the package: task code travels with the job."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
import __spark_entry__ as entry
from tallyboard.session import build_session
spark = build_session("local[4]", 4)
for name, query in entry.queries().items():
    if name.startswith("op"):
        print(name, query(spark, "/root/testdata/sf0.001").count())
"""


def test_tasks_need_no_installed_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT, REPO], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-3000:]
    assert {line.split()[0].split("_")[0] for line in done.stdout.splitlines() if line.startswith("op")} == {f"op{n}" for n in range(1, 14)}
