"""The entry module loaded by path, from another folder and without PYTHONPATH."""

import os
import subprocess
import sys

from conftest import ROOT

CODE = """
import importlib.util, sys
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").getOrCreate())
spec = importlib.util.spec_from_file_location("entry_by_path", sys.argv[1])
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
for name in ("scan_price_xml_files", "expect_drop"):
    print("ROWS", name, entry.queries()[name](spark, "/root/testdata/sf0.001").count())
"""


def test_workers_get_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", CODE, str(ROOT / "__spark_entry__.py")], cwd=tmp_path, env=env,
                          capture_output=True, text=True, timeout=300)
    assert [x.split()[1] for x in done.stdout.splitlines() if x.startswith("ROWS")] == [
        "scan_price_xml_files", "expect_drop"], done.stderr[-3000:]
