"""Run catalog queries against their SQL: python tests/check_queries.py [sf] [name-part ...]"""

import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

from hazardloom.plans import compare  # noqa: E402
from hazardloom.plans.catalog import CATALOG  # noqa: E402
from hazardloom.plans.session import session  # noqa: E402

ROOT = "/root/testdata"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    parts = sys.argv[2:]
    folder = f"{ROOT}/sf{sf}"
    spark = session(master="local[8]", partitions=8, spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__driver__memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    db = duckdb.connect()
    for t in TABLES:
        db.sql(f"create view {t} as select * from '{folder}/{t}.parquet'")
    bad = 0
    for name, q in CATALOG.items():
        if parts and not any(p in name for p in parts):
            continue
        t0 = time.time()
        try:
            got = q.run(spark, folder).toArrow()
            t1 = time.time()
            if q.sql is None:
                note = f"rows-only {got.num_rows}"
            else:
                want = db.sql(q.sql).to_arrow_table()
                diff = compare.difference(got, want)
                note = f"ok {got.num_rows}" if diff is None else f"DIFF {diff[:600]}"
                bad += diff is not None
            print(f"{name:28s} {t1 - t0:6.2f}s sql {time.time() - t1:5.2f}s {note}", flush=True)
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"{name:28s} ERROR {type(e).__name__}: {str(e)[:700]}", flush=True)
            if os.environ.get("TRACE"):
                traceback.print_exc()
    print("failures:", bad)


if __name__ == "__main__":
    main()
