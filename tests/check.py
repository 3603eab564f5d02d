"""Compare registered queries with their SQL: `python tests/check.py [sf] [part of a name ...]`."""

import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

import oracle  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from seriesmill.session import build_session  # noqa: E402

if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    wanted = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = oracle.connect(sf_dir), entry.oracle_sql()
    failed = 0
    for name, fn in entry.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            wrong = oracle.compare(df, con, sql[name]) if name in sql else f"no SQL, {df.count()} rows"
        except Exception as e:
            wrong = f"{type(e).__name__}: {str(e)[:1500]}"
        failed += wrong is not None and name in sql
        print(f"{'ok  ' if wrong is None else 'DIFF'} {name} {time.time() - start:.2f}s {wrong or ''}", flush=True)
    print(f"{failed} failed")
