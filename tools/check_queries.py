"""Run queries beside their SQL on DuckDB and compare rows, names and values.

Usage: python tools/check_queries.py [-s SF] [name or module ...]
"""

from __future__ import annotations

import argparse
import collections
import glob
import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from workload import catalog  # noqa: E402


def plain(value) -> str:
    if value is None or value != value:
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float) and math.isfinite(value):
        return f"{value:.12g}"
    return str(value)


def multiset(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return collections.Counter(tuple(plain(row[i]) for i in order) for row in rows)


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("-s", "--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    options = parser.parse_args()
    folder = f"/root/testdata/sf{options.sf}"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    failures = 0
    for name, q in catalog.QUERIES.items():
        module = q.run.__module__.split(".")[-1]
        if options.names and name not in options.names and module not in options.names:
            continue
        started = time.monotonic()
        try:
            result = q.run(spark, folder)
            ours = result.collect()
            seconds = time.monotonic() - started
            plan = result._jdf.queryExecution().executedPlan().toString()
            for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
                if word in plan:
                    print(f"  plan of {name} has {word}")
            if q.sql is None:
                print(f"ROWS {name} {len(ours)} rows {seconds:.2f}s", flush=True)
                continue
            cursor = con.execute(q.sql)
            names = [d[0] for d in cursor.description]
            odd = [f"{n} {t}" for n, t in result.dtypes if t.startswith(("date", "decimal"))]
            odd += [f"{d[0]} {d[1]}" for d in cursor.description if str(d[1]).startswith(("HUGEINT", "DATE", "DECIMAL"))]
            if odd:
                print("  types to avoid in results:", odd)
            theirs = cursor.fetchall()
            columns = sorted(result.columns)
            if columns != sorted(names):
                raise AssertionError(f"columns {columns} != {sorted(names)}")
            left, right = multiset(result.columns, ours), multiset(names, theirs)
            if left != right:
                raise AssertionError(
                    f"{len(ours)} rows vs {len(theirs)}\n  {columns}\n  only spark {list((left - right).items())[:3]}"
                    f"\n  only sql   {list((right - left).items())[:3]}"
                )
            print(f"OK   {name} {len(ours)} rows {seconds:.2f}s", flush=True)
        except Exception as failure:
            failures += 1
            print(f"FAIL {name} {type(failure).__name__}: {str(failure)[:1500]}", flush=True)
    print("failures:", failures)
    return failures


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
