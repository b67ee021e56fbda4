"""Scratch folders: the application's own go with it, others' only when their lease is old."""

import glob
import os
import subprocess
import sys
import time

from tessera.session import LEASE, SCRATCH, scratch_path, shared_dir, sweep

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
JOB = """
import sys
from pyspark.sql import SparkSession
from tessera.operators import written
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", sys.argv[1]).getOrCreate())
assert written(spark.range(5), "a").count() == 5
import glob
assert glob.glob(sys.argv[1] + "/*/tessera/*/a/*/*.parquet")
"""


def test_the_folder_is_empty_after_the_application(tmp_path):
    done = subprocess.run([sys.executable, "-c", JOB, str(tmp_path)], cwd=ROOT, capture_output=True, text=True,
                          timeout=300, env=dict(os.environ, PYTHONPATH=ROOT))
    assert done.returncode == 0, done.stderr[-2000:]
    assert glob.glob(f"{tmp_path}/*/{SCRATCH}/*") == []


def test_sweep_removes_idle_applications_and_no_others(spark):
    mine = scratch_path(spark, "test/lease")
    base = shared_dir(spark).removeprefix("file:")
    other, idle, alien = (f"{os.path.dirname(base)}/{n}/{SCRATCH}/local-1" for n in ("sweep-live", "sweep-idle", "sweep-none"))
    for folder in (other, idle, alien):
        os.makedirs(f"{folder}/a")
        open(f"{folder}/a/rows", "w").close()
    for folder, age in ((other, 60), (idle, 7200)):
        open(f"{folder}/{LEASE}", "w").close()
        os.utime(f"{folder}/{LEASE}", (time.time() - age,) * 2)
    removed = sweep(spark, idle_hours=1)
    assert [r.removeprefix("file:") for r in removed] == [idle]
    assert not os.path.exists(idle)
    assert os.path.exists(f"{other}/a/rows") and os.path.exists(f"{alien}/a/rows")
    assert os.path.exists(f"{base}/{SCRATCH}/{spark.sparkContext.applicationId}/{LEASE}")
    assert spark.sparkContext.applicationId in mine
