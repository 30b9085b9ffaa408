"""Every llm operator runs in workers that cannot import this package."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCRIPT = """
import sys, tempfile
sys.path.insert(0, {root!r})  # of the driver alone: workers get the environment, which does not name it
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local-cluster[1,2,1500]" if {cluster} else "local[2]").config("spark.ui.enabled", "false")
    .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tests-")).config("spark.sql.shuffle.partitions", "2").getOrCreate())
spark.sparkContext.setLogLevel("ERROR")

def known(batches):
    import importlib.util
    found = importlib.util.find_spec("edupipe") is not None
    yield from (b.slice(0, 0) for b in batches)
    assert not found, "the worker can import the package"

spark.range(2).mapInArrow(known, "id long").collect()
from edupipe.llm.queries import QUERIES
for name in {names!r}:
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0, name
print("all ran")
"""


@pytest.mark.parametrize("names", [["op5_decontaminate", "op6_language_id"], ["op10_line_dedup", "op11_cross_tokenizer", "op12_simhash", "op13_filter_audit"]])
def test_workers_without_the_package(tmp_path, names):
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    code = SCRIPT.format(root=ROOT, names=names, cluster=False)
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=600)
    assert "all ran" in run.stdout, run.stderr[-3000:]
