"""Python-worker queries run from any working directory (code ships by value)."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
import __spark_entry__ as e
n = e.queries()["zip_join_write_ttl"](spark, "/root/testdata/sf0.001").count()
m = e.queries()["win_apply_udf"](spark, "/root/testdata/sf0.001").count()
print("COUNTS", n, m)
"""


def test_worker_code_ships_without_repo_on_path():
    cwd = tempfile.mkdtemp(prefix="tm-cwd-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run(
        [sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True, text=True, timeout=600
    )
    assert "COUNTS" in out.stdout, out.stderr[-2000:]


def test_entry_without_the_training_data_package():
    """The event-time queries and their SQL work where the optional package is absent."""
    code = (
        "import sys; sys.modules['tidemark.llm'] = sys.modules['corpus_pipeline'] = None\n"
        "import __spark_entry__ as entry\n"
        "names = set(entry.queries())\n"
        "assert 'process_tracking' in names and 'stream_process_tracking' in names\n"
        "assert not [n for n in names if n.startswith('op') or n == 'pipeline']\n"
        "assert set(entry.oracle_sql()) == names\n"
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root, timeout=120)
