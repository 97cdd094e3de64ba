"""Run registered queries against their SQL: check_queries.py SF_DIR [name ...]."""

import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

import __spark_entry__ as entry  # noqa: E402
import oracle  # noqa: E402
from listinglake.session import build_session  # noqa: E402


def main(sf_dir, *names):
    spark = build_session(
        "check", master="local[8]",
        extra={"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
               "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle.connect(sf_dir)
    sql = entry.oracle_sql()
    failed = 0
    for name, fn in entry.queries().items():
        if names and not any(n in name for n in names):
            continue
        start = time.time()
        try:
            if name in sql:
                count, problems = oracle.compare(fn(spark, sf_dir), con, sql[name])
            else:
                count, problems = len(fn(spark, sf_dir).collect()), []
        except Exception as e:  # report and go on with the next query
            count, problems = -1, [f"{type(e).__name__}: {str(e)[:700]}"]
        failed += bool(problems)
        note = "" if name in sql else " (rows only)"
        print(f"{'FAIL' if problems else 'ok  '} {name:32s} {count:8d} rows {time.time() - start:6.2f}s{note}")
        for p in problems:
            print("     ", p[:900])
    print("failed:", failed)
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(*sys.argv[1:]) else 0)
