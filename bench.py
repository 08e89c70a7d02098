"""Time the headline queries: one warm-up, then the median of three runs each.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (names separated by commas, or ``all``).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
import zipfile

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "file_verdict",
    "accepted_orders",
    "all_error_rows",
    "distinct_bad_values",
    "file_metadata",
    "duplicate_keys",
    "duplicate_line_tolerance",
    "merge_upsert",
    "full_snapshot_ingest",
    "incremental_csv_load",
    "archive_expansion",
    "keyed_row_statuses",
    "column_match_rates",
    "overall_verdict",
]


#: Reference scenarios: files in one archive, rows per file.
SCENARIOS = [(10, 1000), (50, 500)]


def landing_seconds(spark: SparkSession, files: int, rows: int) -> float:
    """Seconds from an archive in a landing folder to accepted rows and a log."""
    from datetime import datetime

    from millrace.plans.ingest import ingest_table
    from millrace.plans.landing import land_archives
    from millrace.rules import ColumnRule, TableRule
    from millrace.sinks.tables import TableStore

    folder = tempfile.mkdtemp(prefix="millrace-bench-", dir="/tmp")
    with zipfile.ZipFile(f"{folder}/load.zip", "w", zipfile.ZIP_DEFLATED) as bundle:
        for n in range(files):
            bundle.writestr(f"site_20250115_{n:06d}.csv", "code,label,amount\n" + "".join(f"{i},name {i},{i}.50\n" for i in range(rows)))
    store, at = TableStore(spark, f"{folder}/store"), datetime(2025, 1, 15, 10, 30)
    rules = (ColumnRule("code", 1, "LONG", merge_key=True), ColumnRule("label", 2), ColumnRule("amount", 3, "DECIMAL(15,2)"))
    started = time.monotonic()
    land_archives(spark, folder, {"site": ["code", "label", "amount"]}, store, at)
    log = ingest_table(store.read("site_raw"), TableRule("site"), rules, store, at).collect()
    assert len(log) == files and all(r.status == "SUCCESS" for r in log)
    return time.monotonic() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from workload import catalog

    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(catalog.QUERIES) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE
    seconds = {}
    for name in names:
        runs = []
        for number in range(4):
            started = time.monotonic()
            catalog.QUERIES[name].run(spark, folder).write.format("noop").mode("overwrite").save()
            if number:
                runs.append(time.monotonic() - started)
        seconds[name] = round(statistics.median(runs), 3)
    for files, rows in SCENARIOS if not chosen else []:
        seconds[f"land_{files}x{rows}"] = round(statistics.median([landing_seconds(spark, files, rows) for _ in range(4)][1:]), 3)
    spark.stop()
    sf = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }))


if __name__ == "__main__":
    main()
