import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
import __spark_entry__ as E
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
spark.sparkContext.setLogLevel("OFF")
print("rows", E.queries()["html_clean"](spark, "/root/testdata/sf0.001").count())
"""


def test_workers_import_the_package_from_anywhere(tmp_path):
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(root=str(ROOT))], cwd=tmp_path, capture_output=True, text=True, timeout=200)
    assert "rows" in out.stdout, out.stderr[-2000:]
