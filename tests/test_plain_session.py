"""The library in a Spark session without any configuration of its own."""

import os
import subprocess
import sys

SCRIPT = """
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config(
    "spark.sql.shuffle.partitions", "2").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
from fleetstream.plans import catalog
for name in ("window_exact_alerts", "flush_batches", "device_replay", "latest_valid_run", "stream_window_counts"):
    assert catalog.QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0, name
from fleetstream.session import own_dir, remove_own_tables
import os
assert os.path.isdir(own_dir(spark).removeprefix("file:"))
remove_own_tables(spark)
assert not os.path.isdir(own_dir(spark).removeprefix("file:"))
print("fine")
"""


def test_plain_session(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": root}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=600
    )
    assert done.stdout.strip().endswith("fine"), done.stderr[-3000:]
