"""Files that arrive in parts: marks, timeouts and late rows over several runs of one stream."""

import time

import pytest

from millrace.names import FILE
from millrace.rules import ColumnRule, TableRule
from millrace.streaming.partial_files import judge_parts, mark_stream, part_stream, verdicts_of_parts

RULES = (ColumnRule("k", 1, "LONG"), ColumnRule("v", 2, "INTEGER"))
RULE = TableRule("clients", file_tolerance="10%")


@pytest.fixture
def run(spark, tmp_path):
    parts, marks = tmp_path / "parts", tmp_path / "marks"
    parts.mkdir()
    marks.mkdir()

    def put(name, start, stop, bad=()):
        lines = "".join(f"{k},{'x' if k in bad else k}\n" for k in range(start, stop))
        (parts / f"{name}.csv").write_text("k,v\n" + lines)

    def mark(name, rows):
        (marks / f"{name}.csv").write_text(f"file,expected\n{name},{rows}\n")

    def go(timeout_ms=3_600_000):
        rows = part_stream(spark, str(parts), ["k", "v"], files_per_batch=1)
        found = verdicts_of_parts(rows, mark_stream(spark, str(marks)), RULE, RULES, timeout_ms)
        judge_parts(found, str(tmp_path / "out"), str(tmp_path / "state"))
        rows = spark.read.parquet(str(tmp_path / "out")).collect()
        return {(r[FILE], r["reason"]): (r["total_rows"], r["status"], r["accepted_rows"]) for r in rows}

    return put, mark, go


def test_parts_and_marks_in_any_order(run):
    put, mark, go = run
    put("a_20250101_000000~1", 0, 10, bad=(1,))
    put("b_20250101_000000~1", 0, 5)
    mark("b_20250101_000000", 8)
    assert go() == {}
    put("b_20250101_000000~2", 5, 8, bad=(6, 7))
    put("a_20250101_000000~2", 10, 40, bad=(12,))
    mark("a_20250101_000000", 40)
    # 2 of 40 bad cells are within the tolerance, 2 of 8 are not.
    right = {("a_20250101_000000", "COMPLETE"): (40, "SUCCESS", 40), ("b_20250101_000000", "COMPLETE"): (8, "REJECTED", 0)}
    assert go() == right
    put("a_20250101_000000~3", 40, 43)
    assert go() == right | {("a_20250101_000000", "LATE"): (3, "SUCCESS", 3)}


def test_a_file_without_a_mark_is_judged_after_the_timeout(run):
    put, mark, go = run
    put("a_20250101_000000~1", 0, 10)
    mark("empty_20250101_000000", 0)
    go(timeout_ms=1000)
    time.sleep(2)
    put("b_20250101_000000~1", 0, 3)
    mark("b_20250101_000000", 3)
    right = {("a_20250101_000000", "TIMEOUT"): (10, "SUCCESS", 10), ("b_20250101_000000", "COMPLETE"): (3, "SUCCESS", 3)}
    assert go(timeout_ms=1000) == right | {("empty_20250101_000000", "COMPLETE"): (0, "SUCCESS", 0)}
