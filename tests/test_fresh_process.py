"""The entry point in a fresh process whose Spark has no checkpoint folder configured."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import importlib.util
from pyspark.sql import SparkSession
spec = importlib.util.spec_from_file_location("spark_entry", {os.path.join(REPO, "__spark_entry__.py")!r})
E = importlib.util.module_from_spec(spec); spec.loader.exec_module(E)
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
assert spark.conf.get("spark.checkpoint.dir", None) is None
assert E.entry(spark).count() > 0
q = E.queries()
assert q["positional_join"](spark, "/root/testdata/sf0.001").count() == 150
assert q["append_by_name"](spark, "/root/testdata/sf0.001").count() == 1500
print("FRESH-OK")
"""


def test_entry_without_checkpoint_folder():
    env = dict(os.environ, SPARK_CONF_DIR=tempfile.mkdtemp(prefix="rl-empty-conf-"))
    run = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tempfile.gettempdir(), env=env,
                         capture_output=True, text=True, timeout=600)
    assert "FRESH-OK" in run.stdout, run.stderr[-3000:]
