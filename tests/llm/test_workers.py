"""Python tasks of the operators where workers cannot import the package."""

import os
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[2]
PROGRAM = f"""
import sys
from pyspark.sql import SparkSession

spark = (
    SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "2").getOrCreate()
)
sys.path.insert(0, {str(REPO)!r})
from strata.llm.queries import QUERIES

for name in (
    "op1_ngram_join", "op2_quality", "op5_nearest", "op6_line_dedup", "op7_substring_dedup", "op9_bpe",
    "op11_ranked_search", "op12_collocations", "op13_html_extraction",
):
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
print("done")
"""


def test_workers_need_no_copy_of_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    ran = subprocess.run(
        [sys.executable, "-c", PROGRAM], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900
    )
    assert ran.stdout.strip().endswith("done"), ran.stderr[-3000:]
