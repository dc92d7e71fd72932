"""The entry point runs in a fresh local session that names no checkpoint folder."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys
sys.path.insert(0, %r)
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.driver.host", "127.0.0.1").config("spark.sql.shuffle.partitions", "4").getOrCreate())
assert spark.sparkContext.getConf().get("spark.checkpoint.dir", None) is None
import __spark_entry__ as E
print("ROWS", E.entry(spark).count())
""" % REPO


def test_entry_without_checkpoint_setting():
    env = dict(os.environ, SPARK_CONF_DIR=tempfile.mkdtemp(prefix="playlab-noconf-"))
    out = subprocess.run([sys.executable, "-c", SCRIPT], env=env, capture_output=True, text=True, timeout=600,
                         cwd=tempfile.mkdtemp(prefix="playlab-elsewhere-"))
    assert out.returncode == 0, out.stderr[-2000:]
    rows = [ln for ln in out.stdout.splitlines() if ln.startswith("ROWS")]
    assert rows and int(rows[0].split()[1]) > 0
