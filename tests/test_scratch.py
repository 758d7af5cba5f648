"""Tables below the shared folder go when their application does."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
JOB = """
import sys
from pyspark.sql import SparkSession
from quotewright.functions.skew import join_counted_keys
spark = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", sys.argv[1]).getOrCreate())
rows = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
kept = join_counted_keys(rows, rows.groupBy("k").count().filter("count > 1"), ["k"], "count")
print("rows", kept.count(), kept.count())
spark.stop()
"""


def test_stored_keys_last_as_long_as_the_application(tmp_path):
    done = subprocess.run(
        [sys.executable, "-c", JOB, str(tmp_path)], cwd=ROOT, capture_output=True, text=True, timeout=120
    )
    assert "rows 2 2" in done.stdout, done.stderr
    assert not list(tmp_path.rglob("*.parquet"))
