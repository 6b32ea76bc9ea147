"""The driver contract in a session, a folder and a path that are not ours."""

import os
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[1]
PROGRAM = f"""
import importlib.util
from pyspark.sql import SparkSession

spark = (
    SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "2").getOrCreate()
)
spec = importlib.util.spec_from_file_location("entry", {str(REPO / "__spark_entry__.py")!r})
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
assert entry.entry(spark).count() > 0
# Its tasks run Python functions of the package, which workers cannot import here.
assert entry.queries()["dedup_alerts"](spark, "/root/testdata/sf0.001").count() > 0
print("done")
"""


def test_entry_and_python_tasks_in_a_plain_session(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    ran = subprocess.run(
        [sys.executable, "-c", PROGRAM], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600
    )
    assert ran.stdout.strip().endswith("done"), ran.stderr[-3000:]
