"""Compare registered queries with their SQL: ``check_answers.py FOLDER [QUERY ...]``."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as registered  # noqa: E402
from tests.duck import connect, difference, duck_rows, spark_rows  # noqa: E402


def main(folder: str, names: list[str]) -> int:
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    queries, answers = registered.queries(), registered.oracle_sql()
    print("without SQL:", sorted(set(queries) - set(answers)), "without query:", sorted(set(answers) - set(queries)))
    failed = 0
    for name in names or queries:
        start = time.time()
        try:
            columns, actual = spark_rows(queries[name](spark, folder))
            spent = time.time() - start
            with connect(folder) as con:
                wanted, expected = duck_rows(con, answers[name])
            good = columns == wanted and actual == expected
            print("ok  " if good else "FAIL", name, f"{spent:.2f}s", f"rows {sum(actual.values())}",
                  "" if good else f"{columns} {wanted} {difference(actual, expected)}", flush=True)
            failed += not good
        except Exception as error:
            failed += 1
            print("ERR ", name, str(error)[:1500], flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
