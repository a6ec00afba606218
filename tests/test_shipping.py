"""Queries with Python inside tasks run from a folder that has nothing to do with the package."""

import os
import subprocess
import sys

import pyarrow as pa

from riskloom.functions.session import ship

BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.driver.host", "localhost").getOrCreate()
from riskloom.plans import all_queries
queries = all_queries()[0]
for name in ("ks_p_values", "silhouette_points", "correlation_matrix"):
    assert queries[name](spark, "/root/testdata/sf0.001").count() > 0, name
print("done")
"""


def test_workers_find_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "SPARK_LOCAL_DIRS")}
    out = subprocess.run([sys.executable, "-c", CODE], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0 and "done" in out.stdout, out.stderr[-2000:]


def test_an_unset_batch_size_is_lowered(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.num_rows], "size": [b.nbytes]})

    other = spark.newSession()
    other.conf.unset(BATCH)
    ship(other)
    # 24 MB of text in one partition: with Spark's default it is a single batch.
    texts = other.range(0, 3000, 1, 1).selectExpr("repeat(md5(cast(id AS string)), 250) AS text")
    got = texts.mapInArrow(sizes, "n long, size long").collect()
    assert sum(r["n"] for r in got) == 3000
    assert max(r["size"] for r in got) < 10_000_000


def test_a_chosen_batch_size_is_kept(spark):
    other = spark.newSession()
    other.conf.set(BATCH, "2m")
    ship(other)
    assert other.conf.get(BATCH) == "2m"
