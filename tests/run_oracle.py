"""Print one line per query: `python tests/run_oracle.py [sf] [query ...]`."""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from compare import differences, duck
from pyspark.sql import SparkSession

import __spark_entry__ as e

sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
d = f"/root/testdata/sf{sf}"
names = sys.argv[2:]
spark = (
    SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
    .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "12g").getOrCreate()
)
spark.sparkContext.setLogLevel("ERROR")
con, sql = duck(d), e.oracle_sql()
bad = 0
for name, run in e.queries().items():
    if names and name not in names:
        continue
    t = time.time()
    try:
        df = run(spark, d)
        note = differences(df, con, sql[name]) if name in sql else f"rows only: {df.count()}"
    except Exception as x:
        note = f"FAILED {type(x).__name__}: {str(x)[:600]}"
    bad += bool(note) and not note.startswith("rows only")
    print(f"{name:28s} {time.time() - t:6.2f}s  {note or 'same'}", flush=True)
print("differing:", bad)
