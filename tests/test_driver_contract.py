"""The driver contract in a fresh process with a plain session in a non-UTC zone."""

from __future__ import annotations

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys, tempfile
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "8").config("spark.checkpoint.dir", tempfile.mkdtemp()).getOrCreate()
import __spark_entry__ as e
from tests.oracle_check import compare, duck
assert e.entry(spark).count() > 0
sf = "/root/testdata/sf0.01"
con = duck(sf)
qs, sql = e.queries(), e.oracle_sql()
for name in ["A2", "I2", "I4", "M3", "M6", "ST2", "P1_orders"]:
    r = compare(spark, name, qs[name], sql[name], sf, con)
    assert "error" not in r, r
print("contract ok")
"""


def test_plain_session_in_another_time_zone():
    env = dict(os.environ, TZ="America/Los_Angeles")
    out = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(repo=REPO)], cwd=REPO, env=env, capture_output=True, text=True, timeout=600
    )
    assert out.returncode == 0, out.stderr[-3000:]
    assert "contract ok" in out.stdout
