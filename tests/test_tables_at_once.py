"""Tables of a run that load at the same time."""

import threading
import time
from datetime import datetime

from pyspark.sql import functions as F

from millrace.names import FILE
from millrace.plans.ingest import run
from millrace.rules import ColumnRule, RuleBook, TableRule
from millrace.sinks.tables import TableStore
from millrace.sources.files import RawScan

AT = datetime(2025, 1, 15, 10, 30)
RULES = (ColumnRule("c", 0, "INTEGER", merge_key=True),)


def raw(spark, name, bad=0):
    cells = [(f"{name}.csv", "x" if i < bad else str(i), 2025, 1, 1) for i in range(10)]
    return spark.createDataFrame(cells, f"{FILE} string, c string, yyyy int, mm int, dd int")


def book(*names):
    return RuleBook(tuple(TableRule(n, mode="full_snapshot") for n in names), {n: RULES for n in names})


def contents(store, names):
    found = {n: sorted((r["c"] for r in store.read(f"{n}_all").collect()), key=str) for n in names if store.exists(f"{n}_all")}
    log = store.read("execution_log").select("table_name", "filename", "row_count", "error_count", "error_message")
    return found, sorted(map(str, log.collect()))


def test_the_same_log_and_tables_as_one_after_another(spark, tmp_path):
    names = ["a", "b", "broken", "absent", "d"]

    def scan(rule):
        if rule.name == "broken":
            raise OSError("no such disk")
        return RawScan("ABSENT") if rule.name == "absent" else RawScan("READY", raw(spark, rule.name, bad=2 if rule.name == "b" else 0))

    results, orders = [], []
    for at_once in (1, 4):
        store = TableStore(spark, str(tmp_path / str(at_once)))
        log = run(spark, book(*names), store, AT, scan=scan, fail_fast_percent=None, at_once=at_once)
        orders.append([r["table_name"] for r in log.coalesce(1).collect()])
        results.append(contents(store, names))
    assert results[0] == results[1] and set(results[0][0]) >= {"a", "d"}
    assert list(dict.fromkeys(orders[0])) == list(dict.fromkeys(orders[1])) == ["a", "b", "broken", "d"]


def test_tables_load_at_the_same_time(spark, tmp_path):
    together = threading.Barrier(3)

    def scan(rule):
        together.wait(timeout=60)  # passes only if three tables load at once
        return RawScan("READY", raw(spark, rule.name))

    names = [f"t{i}" for i in range(6)]
    store = TableStore(spark, str(tmp_path))
    run(spark, book(*names), store, AT, scan=scan, at_once=3)
    found, log = contents(store, names)
    assert found == {n: list(range(10)) for n in names} and len(log) == 6


def test_a_stopped_table_leaves_nothing_and_its_jobs_end(spark, tmp_path):
    started, begun = threading.Event(), time.monotonic()

    def scan(rule):
        if rule.name == "a":
            started.wait(timeout=60)
            return RawScan("READY", raw(spark, "a", bad=1))
        if rule.name == "slow":
            started.set()
            spark.range(1).select(F.expr("java_method('java.lang.Thread', 'sleep', 300000L + id)")).collect()
        return RawScan("READY", raw(spark, rule.name))

    names = ["a", "b", "slow", "waiting"]
    store = TableStore(spark, str(tmp_path))
    log = run(spark, book(*names), store, AT, scan=scan, at_once=3)
    assert {r["table_name"] for r in log.collect()} == {"a"}
    assert set(contents(store, names)[0]) == {"a"} and len(contents(store, names)[1]) == 1
    assert time.monotonic() - begun < 200
    # The same run again, with the first table mended, takes what was stopped.
    later = run(spark, book(*names[1:2]), store, AT, scan=lambda rule: RawScan("READY", raw(spark, rule.name)))
    assert {r["table_name"] for r in later.collect()} == {"b"} and contents(store, names)[0]["b"] == list(range(10))
