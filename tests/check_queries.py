"""Run all queries against their SQL: ``python tests/check_queries.py [folder] [name ...]``."""

import os
import sys
import time

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from pyspark.sql import SparkSession  # noqa: E402

from oracle import connect, difference  # noqa: E402

import __spark_entry__ as e  # noqa: E402
from tidemark.session import local_session  # noqa: E402

if __name__ == "__main__":
    root = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    # PLAIN=1: a session with Spark's own defaults, as a caller may bring it.
    plain = SparkSession.builder.master("local[8]").config("spark.ui.showConsoleProgress", "false")
    spark = plain.getOrCreate() if os.environ.get("PLAIN") else local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(root)
    bad = 0
    for name, fn in e.queries().items():
        if wanted and name not in wanted:
            continue
        began = time.time()
        try:
            df = fn(spark, root)
            sql = e.oracle_sql().get(name)
            message = difference(df, con, sql) if sql else f"no SQL, {df.count()} rows"
        except Exception as ex:  # noqa: BLE001
            message = f"{type(ex).__name__}: {str(ex)[:600]}"
        bad += message is not None
        print(f"{name:28s} {time.time() - began:6.2f}s {'ok' if message is None else message[:900]}", flush=True)
    print("bad:", bad)
