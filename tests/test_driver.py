"""The entry points as a driver calls them: a plain session, another
working directory, queries that use Python workers."""

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
import __spark_entry__ as E
print("entry", len(E.entry(spark).collect()))
q = E.queries()
for name in ("tukey_cold", "mannwhitney_pairs"):
    print(name, len(q[name](spark, "/root/testdata/sf0.001").collect()))
spark.stop()
"""


def test_udf_queries_run_from_another_directory():
    cwd = tempfile.mkdtemp(prefix="moodcast-driver-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True, text=True,
                         timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = dict(line.split() for line in out.stdout.splitlines() if line.count(" ") == 1)
    assert lines == {"entry": "3", "tukey_cold": "3", "mannwhitney_pairs": "3"}
