"""Queries on executors that do not have this package: the driver finds it, Python workers don't."""

from __future__ import annotations

import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark import cloudpickle

from premiumlake.llm import _text

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = """
import sys
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
spark.range(1).rdd.map(lambda x: x).collect()  # the Python workers start without the package
sys.path.insert(0, sys.argv[1])
import __spark_entry__
for name in sys.argv[2:]:
    print(name, __spark_entry__.queries()[name](spark, "/root/testdata/sf0.001").count(), flush=True)
"""


@pytest.mark.parametrize("names", [["op3_decontamination", "op5_license_scan", "op10_url_filter", "op11_token_efficiency", "op13_cross_tokenizer", "pipeline"]])
def test_workers_need_no_package(tmp_path, names):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = tmp_path / "job.py"
    script.write_text(SCRIPT)
    done = subprocess.run([sys.executable, str(script), REPO, *names], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-3000:]
    assert [line.split()[0] for line in done.stdout.splitlines()[-len(names) :]] == names


def test_jobs_leave_the_powers_of_the_driver_behind():
    data, start, end = np.frombuffer(b"one two one", np.uint8), np.array([0, 4, 8]), np.array([3, 7, 11])
    found = _text.span_hashes(data, start, end)  # on the driver, as for benchmark items and licence texts
    job = cloudpickle.dumps(lambda: _text.span_hashes(data, start, end))
    assert len(job) < 1 << 16  # Spark broadcasts jobs of over 1 MB, and those files stay on the disks
    again = cloudpickle.loads(job)()
    assert (again == found).all() and found[0] == found[2] != found[1]
