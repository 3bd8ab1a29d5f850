"""Compare registered queries with their SQL: run_catalogue.py [sf_dir] [name ...]."""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from compare import compare, duck  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry_point  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    queries, oracles = entry_point.queries(), entry_point.oracle_sql()
    bad = 0
    for name, query in queries.items():
        if wanted and name not in wanted:
            continue
        start = time.perf_counter()
        try:
            if name in oracles:
                problems = compare(spark, con, query, oracles[name], sf_dir)
                note = "ok" if not problems else "; ".join(problems)
            else:
                note = f"rows only: {query(spark, sf_dir).count()}"
                problems = []
        except Exception as exc:  # report and go on
            problems = [1]
            note = f"{type(exc).__name__}: {str(exc)[:1500]}"
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'pass'} {time.perf_counter() - start:6.2f}s {name}: {note}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
