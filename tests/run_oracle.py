"""Run registered queries against their SQL: ``python tests/run_oracle.py SF_DIR [words…]``."""

import sys
import time
import traceback

sys.path.insert(0, "/root/repo")
sys.path.insert(0, "/root/repo/tests")

from compare import compare, duck  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

sf_dir, words = sys.argv[1], sys.argv[2:]
spark = (
    SparkSession.builder.master("local[8]")
    .config("spark.sql.shuffle.partitions", "8")
    .config("spark.ui.enabled", "false")
    .config("spark.driver.memory", "12g")
    .config("spark.sql.session.timeZone", "UTC")
    .getOrCreate()
)
spark.sparkContext.setLogLevel("ERROR")
plans, sql = entry.queries(), entry.oracle_sql()
bad = 0
for name, plan in plans.items():
    if words and not any(w in name for w in words):
        continue
    start = time.time()
    try:
        df = plan(spark, sf_dir)
        if name in sql:
            verdict = compare(df, duck(sf_dir), sql[name])
        else:
            n = len(df.collect())
            verdict = None if n else "no rows"
            name += " (rows only)"
    except Exception as error:
        verdict = f"{type(error).__name__}: {str(error)[:600]}"
        if "-v" in words:
            traceback.print_exc()
    bad += verdict is not None
    print(f"{'FAIL' if verdict else 'ok  '} {time.time() - start:6.2f}s {name} {verdict or ''}", flush=True)
print("bad", bad)
