import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.showConsoleProgress", "false").getOrCreate()
import __spark_entry__ as e
print("ROWS", e.queries()["match_rouge_parts"](spark, "/root/testdata/sf0.001").count())
spark.stop()
"""


def test_queries_run_from_a_foreign_directory(tmp_path):
    """Python workers import the package shipped with addPyFile, whatever the driver's cwd."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True,
                         timeout=600)
    assert "ROWS" in out.stdout, out.stderr[-2000:]
