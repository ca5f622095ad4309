"""The operators with workers that have no copy of the package on their path."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCRIPT = """
import os, sys
sys.path.insert(0, {repo!r})
import __spark_entry__ as entry
from civicflow import session
spark = session.build("local[4]", shuffle_partitions=4, extra={{"spark.checkpoint.dir": os.getcwd() + "/checkpoints"}})
absent = spark.sparkContext.parallelize([0], 1).map(lambda _: __import__("importlib.util").util.find_spec("civicflow") is None).first()
assert absent, "workers see the package: nothing is tested"
for name, query in entry.queries().items():
    if name.startswith("op") or name == "pipeline":
        assert query(spark, "/root/testdata/sf0.001").count() > 0, name
        print("ran", name)
"""


def test_workers_without_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYTHONDONTWRITEBYTECODE": "1"}
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=REPO)], cwd=tmp_path, env=env, capture_output=True,
                          text=True, timeout=1200)
    assert done.returncode == 0, done.stderr[-3000:]
    assert done.stdout.count("ran ") >= 11
