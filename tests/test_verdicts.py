"""Typing, verdicts, line rejection and error rows on small files with known answers."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.names import CORRUPT, FILE
from millrace.operators import error_rows as err
from millrace.operators.quality import duplicate_keys, format_violations, mandatory_nulls
from millrace.operators.typing import type_columns
from millrace.operators.verdict import accepted_rows, file_counts, file_verdict
from millrace.plans.ingest import judge
from millrace.rules import ColumnRule, TableRule, spark_type


def raw_file(spark, rows, columns, file="f1"):
    schema = ", ".join(f"{c} string" for c in columns)
    return spark.createDataFrame([tuple(r) for r in rows], schema).withColumn(FILE, F.lit(file))


def dated(spark, bad, total=10, **fields):
    rows = [("a", "b", "2025-13-45" if i < bad else "2025-11-15") for i in range(total)]
    rules = [ColumnRule("x", 1), ColumnRule("y", 2), ColumnRule("d", 3, "DATE", pattern="YYYY-MM-DD", **{"action": "REJECT", **fields})]
    return judge(raw_file(spark, rows, ["x", "y", "d"]), TableRule("t", file_tolerance="50%"), rules)


@pytest.mark.parametrize("bad,status,accepted,errors", [(8, "REJECTED", 0, 8), (2, "SUCCESS", 8, 2), (5, "SUCCESS", 5, 5)])
def test_line_threshold_on_dates(spark, bad, status, accepted, errors):
    """80% bad dates at 50% refuse the file; 20% lose their rows; exactly 50% is accepted."""
    judged = dated(spark, bad)
    verdict = judged.verdict.first()
    assert (verdict.status, verdict.accepted_rows) == (status, accepted)
    assert judged.accepted().count() == accepted
    assert sum(e.error_count for e in judged.errors().collect()) == errors
    if status == "REJECTED":
        assert verdict.message == "Column 'd': RLK tolerance exceeded: 80.00% > 50.00%"


def test_three_files_one_refused(spark):
    rules = [ColumnRule("id", 1, "INTEGER")]
    raw = raw_file(spark, [("x",)] * 3, ["id"], "f1").unionByName(raw_file(spark, [("1",)] * 3, ["id"], "f2"))
    verdicts = {r[FILE]: r for r in judge(raw, TableRule("t", file_tolerance="20%"), rules).verdict.collect()}
    assert (verdicts["f1"].status, verdicts["f1"].error_no) == ("REJECTED", "000000009")
    assert (verdicts["f2"].status, verdicts["f2"].accepted_rows) == ("SUCCESS", 3)


def test_first_column_in_field_order_decides(spark):
    rules = [ColumnRule("b", 2, "INTEGER"), ColumnRule("a", 1, "INTEGER")]
    assert judge(raw_file(spark, [("x", "x")], ["a", "b"]), TableRule("t"), rules).verdict.first().failing_column == "a"


def test_absolute_tolerance(spark):
    rules = [ColumnRule("a", 1, "INTEGER")]
    for bad, status in ((2, "SUCCESS"), (3, "REJECTED")):
        rows = [("x",)] * bad + [("1",)] * (100 - bad)
        assert judge(raw_file(spark, rows, ["a"]), TableRule("t", file_tolerance="2"), rules).verdict.first().status == status


@pytest.mark.parametrize("columns,limit", [(5, 1), (19, 1), (20, 2), (29, 2)])
def test_line_limit(spark, columns, limit):
    names = [f"c{i}" for i in range(columns)]
    rules = [ColumnRule(c, i, "INTEGER") for i, c in enumerate(names)]
    rows = [["x" if j == i else "1" for j in range(columns)] for i in range(columns)]
    rows += [["x" if j < n else "1" for j in range(columns)] for n in (1, 2, 3)]
    judged = judge(raw_file(spark, rows, names), TableRule("t", file_tolerance="100%"), rules)
    verdict = judged.verdict.first()
    assert (verdict.flagged_columns, verdict.line_limit) == (columns, limit)
    assert verdict.rejected_lines == sum(1 for n in (1, 2, 3) if n > limit)
    assert judged.accepted().count() == verdict.accepted_rows == len(rows) - verdict.rejected_lines


def test_unflagged_columns_do_not_raise_the_limit(spark):
    """Thirty columns of which two have bad cells: the limit stays at one."""
    names = [f"c{i}" for i in range(30)]
    rules = [ColumnRule(c, i, "INTEGER") for i, c in enumerate(names)]
    rows = [["x", "x"] + ["1"] * 28] + [["1"] * 30 for _ in range(9)]
    verdict = judge(raw_file(spark, rows, names), TableRule("t", file_tolerance="20%"), rules).verdict.first()
    assert (verdict.flagged_columns, verdict.line_limit, verdict.rejected_lines) == (2, 1, 1)


def test_counts_balance_per_file(spark):
    """accepted + removed + rejected lines + corrupt = total, and accepted rows agree with the verdict."""
    rng = random.Random(7)
    pick = lambda *values: rng.choice(values)
    rows = [
        (pick("1", "2", "x"), pick("1.5", "y", ""), pick("20250101", "20251345", None), None if rng.random() < 0.95 else "broken", f"f{rng.randrange(4)}")
        for _ in range(400)
    ]
    raw = spark.createDataFrame(rows, f"a string, b string, d string, {CORRUPT} string, {FILE} string")
    rules = [ColumnRule("a", 1, "INTEGER"), ColumnRule("b", 3, "DOUBLE"), ColumnRule("d", 2, "DATE", pattern="YYYYMMDD", action="REJECT")]
    judged = judge(raw, TableRule("t", file_tolerance="60%"), rules)
    accepted = Counter(r[FILE] for r in judged.accepted().collect())
    expected = brute_force(rows)
    for v in judged.verdict.collect():
        assert v.status == "SUCCESS"
        assert v.accepted_rows + v.dropped_rows + v.rejected_lines + v.corrupt_rows == v.total_rows
        assert v.accepted_rows == accepted[v[FILE]] == expected[v[FILE]]


def brute_force(rows):
    kept = {}
    for a, b, d, corrupt, file in rows:
        if corrupt is None and d != "20251345":
            kept.setdefault(file, []).append((a == "x") + (b == "y"))
    return {file: sum(1 for flags in found if flags <= 1) for file, found in kept.items()}


def test_later_columns_ignore_removed_rows(spark):
    rules = [ColumnRule("d", 1, "DATE", pattern="YYYYMMDD", action="REJECT"), ColumnRule("a", 2, "INTEGER")]
    rows = [("20251345", "x"), ("20251345", "1"), ("20250101", "x")] + [("20250101", "1")] * 7
    typed = type_columns(raw_file(spark, rows, ["d", "a"]), rules)
    counts = file_counts(typed, TableRule("t")).first()
    assert (counts.total_rows, counts.bad_d, counts.bad_a, counts.dropped_rows) == (10, 2, 1, 2)


def test_actions(spark):
    rows = [("x", "x", "x", "x", "2025-1-5")] + [("1", "1", "1", "1", "2025-01-05")] * 9
    rules = [
        ColumnRule("rej", 1, "INTEGER", action="REJECT"), ColumnRule("ict", 2, "INTEGER"),
        ColumnRule("log", 3, "INTEGER", action="LOG_ONLY"), ColumnRule("nul", 4, "INTEGER", nullable=True),
        ColumnRule("day", 5, "DATE", pattern="YYYY-MM-DD", action="LOG_ONLY", nullable=True),
    ]
    judged = judge(raw_file(spark, rows, ["rej", "ict", "log", "nul", "day"]), TableRule("t", file_tolerance="10%"), rules)
    assert judged.accepted().count() == 10
    errors = {r.column_name: r for r in judged.errors().collect()}
    assert set(errors) == {"rej", "ict", "log", "day"}
    assert errors["rej"].error_message == "COLUMN REJECTED: rej. Expected type: INTEGER, 1 invalid values of 10 rows (10.0%). Value: x"
    assert errors["ict"].error_message == "ICT_DRIVEN: 1/10 invalid (10.0%)"
    assert errors["log"].error_message == "LOG_ONLY: 1/10 invalid (10.0%)"
    assert (errors["day"].error_no, errors["day"].raw_value) == ("000000004", "2025-1-5")


def test_every_bad_text_is_listed_with_its_count(spark):
    """Far more bad cells than any list used to hold: one row per text, exact numbers."""
    texts = [f"bad{i:04d}" for i in range(1500)] * 2
    typed_rules = [ColumnRule("a", 1, "INTEGER", action="REJECT"), ColumnRule("b", 2, "INTEGER", action="LOG_ONLY")]
    judged = judge(raw_file(spark, [(t, t) for t in texts], ["a", "b"]), TableRule("t", file_tolerance="100%"), typed_rules)
    got = judged.errors().filter("column_name in ('a', 'b')").collect()
    assert Counter((r.column_name, r.raw_value) for r in got) == Counter((c, t) for c in "ab" for t in texts[:1500])
    assert {r.error_count for r in got} == {2}


def test_corrupt_lines_fail_a_file(spark):
    rules = [ColumnRule("a", 1)]
    for corrupt, status in ((2, "SUCCESS"), (3, "FAILED")):
        rows = [("v", "broken" if i < corrupt else None) for i in range(20)]
        raw = raw_file(spark, rows, ["a", CORRUPT])
        judged = judge(raw, TableRule("t", file_tolerance="10%"), rules)
        verdict = judged.verdict.first()
        assert (verdict.status, verdict.corrupt_rows) == (status, corrupt)
        errors = judged.errors().collect()
        assert {e.error_no for e in errors} == {"000000007"}
        assert sum(e.error_count for e in errors) == (corrupt if status == "SUCCESS" else 3) and len(errors) == 1


def test_mandatory_nulls(spark):
    rows = [(None,)] * 2 + [("S",)] * 8
    judged = judge(raw_file(spark, rows, ["SITE_CODE"]), TableRule("t"), [ColumnRule("SITE_CODE", 1)])
    found = mandatory_nulls(accepted_rows(judged.typed, judged.verdict), judged.typed, "t").collect()
    assert [r.column_name for r in found] == ["SITE_CODE"] * 2
    assert judged.errors().count() == 2


def test_uniqueness_and_format(spark):
    keys = [(str(i % 95),) for i in range(100)]
    assert duplicate_keys(raw_file(spark, keys, ["k"]), ["k"]).count() == 5
    assert duplicate_keys(raw_file(spark, [(None,)] * 3, ["k"]), ["k"]).count() == 0
    mails = raw_file(spark, [("test@example.com",), ("invalid-email",), ("another@test.fr",)], ["EMAIL"])
    assert [r.EMAIL for r in format_violations(mails, "EMAIL", r"^[^@\s]+@[^@\s]+\.[^@\s]+$").collect()] == ["invalid-email"]


def test_blank_cells_are_no_errors(spark):
    rows = [("", "  ", None)]
    rules = [ColumnRule("a", 1, "INTEGER"), ColumnRule("d", 2, "DATE", pattern="YYYYMMDD"), ColumnRule("t", 3, "BOOLEAN")]
    verdict = judge(raw_file(spark, rows, ["a", "d", "t"]), TableRule("t", file_tolerance="0%"), rules).verdict.first()
    assert (verdict.status, verdict.bad_a, verdict.bad_d, verdict.null_rows) == ("SUCCESS", 0, 0, 1)


def test_declared_types():
    assert [spark_type(t) for t in ("DATE", "integer", "LONG", "DECIMAL(10,2)")] == ["timestamp", "int", "bigint", "decimal(10,2)"]
    with pytest.raises(ValueError):
        spark_type("NUMBERISH")
    assert ColumnRule("a", action="IGNORE").problem() == "unknown error action: IGNORE"


def test_verdict_takes_one_shuffle_and_one_scan(spark):
    """Twenty columns, any number of files: still one aggregate."""
    names = [f"c{i}" for i in range(20)]
    raw = raw_file(spark, [["1"] * 20], names)
    typed = type_columns(raw, [ColumnRule(c, i, "INTEGER") for i, c in enumerate(names)])
    verdict = file_verdict(file_counts(typed, TableRule("t")), typed, TableRule("t"))
    plan = verdict._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_every_cell_is_parsed_once(spark, tmp_path):
    path = str(tmp_path / "raw")
    raw_file(spark, [("1", "20250101")], ["a", "d"]).write.parquet(path)
    rules = [ColumnRule("a", 1, "INTEGER"), ColumnRule("d", 2, "DATE", pattern="YYYYMMDD", action="REJECT")]
    judged = judge(spark.read.parquet(path), TableRule("t"), rules)
    for frame in (judged.accepted(), err.bad_values(judged.typed)):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("gettimestamp(") == 1
