"""The registered queries run from a driver whose executors cannot import
the package (it is only on the driver's sys.path), as on a cluster without
the library installed on the workers."""

import os
import subprocess
import sys
import textwrap

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_queries_run_without_package_on_workers(tmp_path):
    script = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {REPO!r})
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
        import __spark_entry__ as E
        n = E.queries()["word_count_partition_tally"](spark, "/root/testdata/sf0.001").count()
        print("ROWS", n)
    """)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    res = subprocess.run([sys.executable, "-c", script], cwd=str(tmp_path), env=env,
                         capture_output=True, text=True, timeout=600)
    assert "ROWS 4250" in res.stdout, res.stderr[-2000:]
