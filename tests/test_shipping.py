import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys, tempfile
sys.path.insert(0, sys.argv[1])
import __spark_entry__ as contract
from roentra.session import build_session
spark = build_session("shipping", "local[2]", **{"spark.sql.shuffle.partitions": "2",
                      "spark.checkpoint.dir": tempfile.mkdtemp()})
for name in ("parsed_headers", "pixels_resize", "batch_scores"):
    assert contract.queries()[name](spark, "/root/testdata/sf0.001").count() > 0
print("shipped")
"""


def test_python_tasks_need_no_installed_package(tmp_path):
    """Workers start in a folder from which the package cannot be imported."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, ROOT], cwd=tmp_path, env=env, capture_output=True,
        text=True, timeout=300,
    )
    assert done.stdout.strip().endswith("shipped"), done.stderr[-2000:]
