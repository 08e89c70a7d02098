"""Whole runs: rules, files, streams, archives, target tables and comparisons."""

import json
import json
import os
import zipfile
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.names import CORRUPT, FILE
from millrace.operators import baseline as base
from millrace.operators.metrics import run_counters, run_wide_stop
from millrace.operators.skew import latest_per_key
from millrace.plans.compare import compare_tables
from millrace.plans.ingest import ingest_table, run
from millrace.rules import ColumnRule, RuleBook, TableRule
from millrace.sinks.ingestion import merge_upsert
from millrace.sinks.tables import TableStore
from millrace.sources import archives as arc
from millrace.sources import files as src
from millrace.sources.files import RawScan
from millrace.sources.rule_tables import load_rules
from millrace.streaming.loader import file_stream, load_new_files

AT = datetime(2025, 1, 15, 10, 30)


def raw_table(spark, files, columns=2):
    """``files``: name -> number of bad rows out of ten."""
    rows = [
        (name, *("x" if i < bad else str(i) for _ in range(columns)), 2025, 1, day)
        for day, (name, bad) in enumerate(files.items(), 1) for i in range(10)
    ]
    names = ", ".join(f"c{i} string" for i in range(columns))
    return spark.createDataFrame(rows, f"{FILE} string, {names}, yyyy int, mm int, dd int")


def rules_of(columns=2):
    return tuple(ColumnRule(f"c{i}", i, "INTEGER", merge_key=i == 0) for i in range(columns))


def jobs_of(spark, action):
    group = f"count-{id(action)}"
    spark.sparkContext.setJobGroup(group, group)
    action()
    spark.sparkContext.setJobGroup("other", "other")
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_jobs_do_not_grow_with_files_or_columns(spark, tmp_path):
    counts = []
    for number, (files, columns) in enumerate([(2, 2), (12, 9)]):
        raw = raw_table(spark, {f"f{i}": 3 if i == 0 else 0 for i in range(files)}, columns)
        store = TableStore(spark, str(tmp_path / str(number)))
        rule = TableRule("t", mode="full_snapshot")
        counts.append(jobs_of(spark, lambda: ingest_table(raw, rule, rules_of(columns), store, AT)))
    assert abs(counts[0] - counts[1]) <= 2, counts


def test_run_writes_tables_logs_and_quarantine(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    scans = {
        "good": RawScan("READY", raw_table(spark, {"a": 0, "b": 1, "c": 9})),
        "gone": RawScan("ABSENT"), "void": RawScan("EMPTY"),
        "odd": RawScan("READY", raw_table(spark, {"z": 0}).drop("c1")),
        "lost": RawScan("FAILED", message="RAW table read error: no such file"),
    }
    book = RuleBook(tuple(TableRule(n, mode="full_snapshot") for n in scans), {n: rules_of() for n in scans})
    log = run(spark, book, store, AT, scan=lambda rule: scans[rule.name], fail_fast_percent=None)
    got = {(r.table_name, r.filename): (r.status, r.error_message) for r in log.collect()}
    assert got[("good", "a")] == ("SUCCESS", None)
    assert got[("good", "b")][0] == "SUCCESS"
    assert got[("good", "c")] == ("REJECTED", "[000000009] REJECTED - Column 'c0': RLK tolerance exceeded: 90.00% > 10.00%")
    assert got[("odd", "z")] == ("FAILED", "Missing columns")
    assert got[("lost", "N/A")] == ("FAILED", "RAW table read error: no such file")
    assert len(store.read("execution_log").columns) == 18 and store.read("execution_log").count() == 5
    # One row of b has two bad cells of two flagged columns: rejected as a line.
    assert store.read("good_all").groupBy(FILE).count().orderBy(FILE).collect() == [("a", 10), ("b", 9)]
    assert store.read("good_last").groupBy(FILE).count().orderBy(FILE).collect() == [("a", 10), ("b", 9)]
    assert store.read("quarantine").count() == 10
    errors = store.read("quality_errors")
    assert errors.filter("error_no = '000000010'").count() == 1
    assert run_counters(log).first().outcome_code == 1
    assert run_counters(log.filter("filename = 'c'")).first().outcome_code == 2


def test_wrong_rules_fail_a_table(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    for rule, rules in ((TableRule("t", file_tolerance="abc%"), rules_of()), (TableRule("t"), (ColumnRule("c0", action="IGNORE"),))):
        log = ingest_table(raw_table(spark, {"a": 0}), rule, rules, store, AT).collect()
        assert [r.status for r in log] == ["FAILED"]
    assert not store.exists("t_all")


def test_earlier_errors_stop_the_run(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    raw = raw_table(spark, {"a": 1})
    book = RuleBook((TableRule("one"), TableRule("two")), {"one": rules_of(), "two": rules_of()})
    log = run(spark, book, store, AT, scan=lambda rule: RawScan("READY", raw))
    assert {r.table_name for r in log.collect()} == {"one"}
    tables = spark.createDataFrame([(1, 10, 100), (2, 0, 1000), (3, 0, 5)], "table_index int, errors bigint, processed bigint")
    assert [r.stopped for r in run_wide_stop(tables).orderBy("table_index").collect()] == [False, True, True]


def test_merge_keeps_one_row_per_key(spark, tmp_path):
    store, rule = TableStore(spark, str(tmp_path)), TableRule("t", mode="merge")
    for day, file in enumerate("ab"):
        ingest_table(raw_table(spark, {file: 0}), rule, rules_of(), store, AT + timedelta(days=day))
    assert store.read("t_all").count() == 10 and {r[FILE] for r in store.read("t_all").collect()} == {"b"}
    assert [n for n, _ in store.snapshots("t_all")] == [1, 2]
    assert store.read("t_all", 1).count() == 10


def test_merge_never_drops_rows_without_a_key(spark):
    target = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    source = spark.createDataFrame([(1, "c"), (2, "d"), (None, "e")], "k int, v string")
    merged = sorted(merge_upsert(target, source, ["k"]).collect(), key=str)
    assert merged == sorted([(1, "c"), (2, "d"), (None, "b"), (None, "e")], key=str)


def test_group_limits_reach_below_the_shuffle(spark):
    rows = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    assert "WindowGroupLimit" in latest_per_key(rows, ["k"], [F.col("v").desc()])._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.v for r in latest_per_key(rows, ["k"], [F.col("v").desc()]).collect()) == [997, 998, 999]


def test_rule_tables_with_every_blank_form(spark, tmp_path):
    tables = [{"Delta Table Name": "t", "Ingestion Mode": "MERGE", "Rejected line per file tolerance": "20%", "Trim": "false"},
              {"Delta Table Name": "u", "Rejected line per file tolerance": "nan"}]
    columns = [
        {"Delta Table Name": "t", "Column Name": "b", "Field Order": "2", "Field type": "date", "Transformation pattern": "NaN", "Error action": "None"},
        {"Delta Table Name": "t", "Column Name": "a", "Field Order": "1", "Field type": " integer ", "Is Nullable": "True",
         "Regex replacement": "null", "Error action": " reject ", "Is Special": "isMergeKey"},
    ]
    for name, rows in (("tables", tables), ("columns", columns)):
        (tmp_path / f"{name}.json").write_text(json.dumps(rows))
    book = load_rules(spark, str(tmp_path / "tables.json"), str(tmp_path / "columns.json"), "json")
    t, u = book.tables
    assert (t.mode, t.file_tolerance, t.trim, t.last_table_name) == ("merge", "20%", False, "t_last")
    assert (u.file_tolerance, u.trim, u.input_format) == ("20%", True, "csv")
    a, b = book.columns_of("t")
    assert (a.name, a.type, a.nullable, a.action, a.replacement) == ("a", "int", True, "REJECT", None)
    assert (b.pattern, b.date_pattern, b.action) == (None, "yyyy-MM-dd", "ICT_DRIVEN")
    assert book.merge_keys("t") == ["a"]


def test_rfc4180_lines(spark, tmp_path):
    lines = [f"k{i},plain" for i in range(8)] + ["k8,a,b", 'k9,"a,b"']
    (tmp_path / "data.csv").write_text("\n".join(lines) + "\n")
    raw = src.read_csv(spark, str(tmp_path), ["a", "b"], header=False)
    assert raw.filter(F.col(CORRUPT).isNull()).count() == 9
    assert raw.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT).collect() == [("k8,a,b",)]
    assert raw.filter("a = 'k9'").first().b == "a,b"


def test_too_many_or_too_few_fields_are_corrupt(spark, tmp_path):
    (tmp_path / "data.csv").write_text("a,b\n1,2,3\n1\n1,2\n")
    raw = src.read_csv(spark, str(tmp_path), ["a", "b"])
    assert raw.agg(F.count_if(F.col(CORRUPT).isNotNull())).first()[0] == 2
    assert raw.count() == 3


def test_incremental_load_takes_each_file_once(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    target, state = str(tmp_path / "raw"), str(tmp_path / "state")

    def arrive(numbers):
        for i in numbers:
            (landing / f"data_202511{i + 10}.csv").write_text("a,b\n1,2\n3,4\n")

    loaded = []
    for numbers in (range(5), range(5, 8), ()):
        arrive(numbers)
        loaded.append(load_new_files(file_stream(spark, str(landing), "csv", ["a", "b"], run_ts=AT), target, state))
    assert loaded == [10, 6, 0]
    rows = spark.read.parquet(target)
    assert rows.select(FILE).distinct().count() == 8
    assert rows.filter(f"{FILE} = 'data_20251112'").select("yyyy", "mm", "dd").distinct().collect() == [(2025, 11, 12)]


def test_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "five.zip", "w", zipfile.ZIP_DEFLATED) as bundle:
        for i in range(5):
            bundle.writestr(f"t{i}_20250101_000000.csv", "a,b\n" + "\n".join(f"{n},v" for n in range(100)) + "\n")
    (tmp_path / "broken.zip").write_bytes(os.urandom(500))
    good = (tmp_path / "five.zip").read_bytes()
    (tmp_path / "cut.zip").write_bytes(good[: len(good) // 2])
    paths = [f"{tmp_path}/{n}.zip" for n in ("five", "broken", "cut", "nowhere")]
    expanded = arc.expand_archives(spark.createDataFrame([(p,) for p in paths], "archive string"))
    errors = {os.path.basename(r.archive): r.error for r in arc.expanded_errors(expanded).collect()}
    assert set(errors) == {"broken.zip", "cut.zip", "nowhere.zip"}
    assert "not found" in errors["nowhere.zip"] and "corrupt" in errors["broken.zip"]
    rows = arc.records_as_csv(arc.sound_records(expanded), ["b", "a"])
    tables = rows.withColumn("t", src.table_of_file(F.col("path"))).groupBy("t").count().collect()
    assert sorted(tables) == [(f"t{i}", 100) for i in range(5)]


def test_flat_files(spark, tmp_path):
    for name, size in (("image1.tif", 10), ("data.xml", 20), ("config.json", 30)):
        (tmp_path / name).write_bytes(b"x" * size)
    found = src.flat_inventory(src.flat_files(spark, str(tmp_path))).agg(F.sum("files"), F.sum("bytes")).first()
    assert tuple(found) == (3, 60)


def test_snapshots_ignore_uncommitted_writes(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    for n in (1, 2, 3):
        store.replace("t", spark.range(n), AT + timedelta(days=n))
    os.remove(tmp_path / "t" / "snapshot_id=3" / "snapshot_ts=20250118T103000" / "_SUCCESS")
    assert [n for n, _ in store.snapshots("t")] == [1, 2]
    assert store.read("t").count() == 2 and store.read("t", 1).count() == 1


@pytest.fixture
def sides(spark):
    baseline = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0), (4, None, 4.0)], "k int, v string, x double")
    actual = spark.createDataFrame([(1, "a", 1.0), (2, "B", 2.0), (4, None, 4.0), (5, "e", 5.0)], "k int, v string, x double")
    return actual, baseline


def test_keyed_comparison(sides):
    statuses = {r.k: r.row_status for r in base.compare_rows(*sides, ["k"]).collect()}
    assert statuses == {1: "IDENTICAL", 2: "DIFFERENT", 3: "MISSING", 4: "IDENTICAL", 5: "EXTRA"}
    rates = {r.column_name: (r.matched, r.baseline_rows, r.ok) for r in base.match_rates(*sides, ["k"], {"v": 0.6, "x": 0.7}).collect()}
    assert rates == {"v": (2, 4, False), "x": (3, 4, True)}


def test_hot_keys_are_not_paired(spark):
    """A key with many rows on both sides stays linear and is compared as a whole."""
    hot = spark.range(20000).select(F.lit(1).alias("k"), (F.col("id") % 7).alias("v"))
    changed = hot.unionByName(spark.createDataFrame([(1, 99)], "k int, v bigint"))
    plan = base.compare_rows(changed, hot, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert [r.row_status for r in base.compare_rows(hot, hot, ["k"]).collect()] == ["IDENTICAL"]
    assert [r.row_status for r in base.compare_rows(changed, hot, ["k"]).collect()] == ["DIFFERENT"]
    assert base.match_rates(changed, hot, ["k"], {"v": 1.0}).first().match_rate == 1.0


def test_verdict_row(spark, sides, tmp_path):
    actual, baseline = sides
    store = TableStore(spark, str(tmp_path))
    assert compare_tables(baseline, baseline, "same", AT, store, ["k"]).passed
    failed = compare_tables(actual.drop("x"), baseline, "less", AT, store)
    row = failed.verdict.first()
    assert not failed.passed and row.schema.missing_columns == ["x"] and row.row_count.diff == 0 and row.null_check.ok
    assert store.read("validation_results").count() == 2


def test_row_count_tolerance(spark):
    for rows, ok in ((95, True), (94, False), (105, True), (106, False)):
        profiled = base.profile(spark.range(rows), spark.range(100))
        assert base.row_count_diff(profiled).first().ok == ok
    assert base.row_count_diff(base.profile(spark.range(3), spark.range(0))).first().diff_pct == 0.0


def test_datasets_against_specs(spark):
    specs = spark.createDataFrame(
        [("site", 1000, 5.0, ["SITE_CODE"], 0.95), ("activite", 5000, 3.0, ["ACTIVITE_ID"], 0.98), ("absent", 10, 2.0, ["A"], 0.9)],
        "dataset string, expected_rows bigint, tolerance_pct double, mandatory_columns array<string>, quality_floor double",
    )
    outputs = spark.createDataFrame(
        [("site", 950, ["SITE_CODE"], 0.95), ("activite", 5000, ["OTHER"], 0.9)],
        "dataset string, row_count bigint, columns array<string>, quality_score double",
    )
    compared = base.compare_with_specs(specs, outputs)
    got = {r.dataset: (r.status, r.quality_ok) for r in compared.collect()}
    assert got == {"site": ("PASSED", True), "activite": ("FAILED", False), "absent": ("SKIPPED", None)}
    report = base.consolidated_report(compared, F.lit(AT)).first()
    assert (report.datasets_tested, report.datasets_passed, report.datasets_failed) == (3, 1, 1)


def test_regressions(spark):
    now = spark.createDataFrame([("site", 10), ("other", 0)], "dataset string, errors bigint")
    before = spark.createDataFrame([("site", 0), ("other", 0)], "dataset string, errors bigint")
    assert {r.dataset: r.status for r in base.quality_regressions(now, before).collect()} == {"site": "REGRESSION", "other": "SUCCESS"}


def dated_table(spark, days, bad=0):
    """One file of ten rows per day; keys are the same in every file."""
    rows = [(f"f_{d:%Y%m%d}", "x" if i < bad else str(i), d.year, d.month, d.day) for d in days for i in range(10)]
    return spark.createDataFrame(rows, f"{FILE} string, c0 string, yyyy int, mm int, dd int")


def test_each_file_is_taken_once_and_new_ones_are_added(spark, tmp_path):
    store, rule = TableStore(spark, str(tmp_path)), TableRule("t")
    days = [AT + timedelta(days=n) for n in range(8)]
    for n, upto in enumerate((5, 8, 8)):
        ingest_table(dated_table(spark, days[:upto]), rule, rules_of(1), store, AT + timedelta(hours=n))
        assert store.read("t_all").count() == 10 * upto
    assert store.read("execution_log").filter("status = 'SUCCESS'").count() == 8
    assert {r.dd for r in store.read("t_last").collect()} == {days[7].day}


@pytest.mark.parametrize("mode", ["", "full_snapshot", "merge"])
@pytest.mark.parametrize("step", ["append:t_all", "merge:t_all", "replace:t_last", "append:quality_errors", "append:quarantine", "append:loaded_files", "append:execution_log", "finish"])
def test_a_run_that_failed_anywhere_can_be_repeated(spark, tmp_path, monkeypatch, mode, step):
    kind, _, target = step.partition(":")
    if (mode == "merge") != (kind == "merge") and target == "t_all":
        pytest.skip("this mode does not write the table in this way")
    raw = raw_table(spark, {"a": 1, "b": 9})
    rule = TableRule("t", mode=mode)
    store, original = TableStore(spark, str(tmp_path / "s")), getattr(TableStore, kind)

    def fails(self, name, *args, **kwargs):
        done = original(self, name, *args, **kwargs) if kind != "finish" else None
        if kind == "finish" or name == target:
            raise OSError("the executor is gone")
        return done

    monkeypatch.setattr(TableStore, kind, fails)
    with pytest.raises(OSError):
        ingest_table(raw, rule, rules_of(), store, AT)
    monkeypatch.undo()
    assert not store.exists("t_all") and not store.exists("execution_log")
    for _ in range(2):
        assert sorted(r.status for r in ingest_table(raw, rule, rules_of(), store, AT).collect()) == ["REJECTED", "SUCCESS"]
    assert store.read("t_all").count() == store.read("t_last").count() == 9
    assert store.read("quarantine").count() == 10 and store.read("execution_log").count() == 2
    assert store.read("loaded_files").count() == 2
    assert store.read("quality_errors").count() == len({tuple(r) for r in store.read("quality_errors").collect()})


def test_a_failing_table_does_not_end_the_run(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    book = RuleBook((TableRule("one", mode="merge"), TableRule("two")), {"one": (ColumnRule("c0", 0, "INTEGER"),), "two": rules_of(1)})
    log = run(spark, book, store, AT, scan=lambda rule: RawScan("READY", dated_table(spark, [AT])))
    got = {r.table_name: r for r in log.collect()}
    assert got["one"].status == "FAILED" and "no merge key" in got["one"].error_message
    assert got["two"].status == "SUCCESS" and not store.exists("one_all")


def test_a_full_snapshot_is_the_whole_delivery(spark, tmp_path):
    store, rule = TableStore(spark, str(tmp_path)), TableRule("t", mode="FULL_SNAPSHOT")
    ingest_table(dated_table(spark, [AT, AT + timedelta(days=1)]), rule, rules_of(1), store, AT)
    assert store.read("t_last").count() == store.read("t_all").count() == 20


def test_last_never_goes_back_and_merge_is_unique(spark, tmp_path):
    for mode in ("", "full_snapshot", "merge"):
        store, rule = TableStore(spark, str(tmp_path / (mode or "append"))), TableRule("t", mode=mode)
        for n, day in enumerate((AT, AT - timedelta(days=3))):
            ingest_table(dated_table(spark, [day]), rule, rules_of(1), store, AT + timedelta(hours=n))
        assert {r.dd for r in store.read("t_last").collect()} == {AT.day}
    for name in ("t_all", "t_last"):
        assert store.read(name).count() == store.read(name).select("c0").distinct().count() == 10


def test_a_merge_rewrites_touched_buckets_only(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    rows = lambda ids, v: ids.select("id", F.lit(v).alias("v"), F.lit(2025).alias("yyyy"), F.lit(1).alias("mm"), F.lit(1).alias("dd"))
    store.merge("t", rows(spark.range(1000), "old"), ["id"], AT)
    parts = lambda: json.loads(store._get(store._folders("t")[-1][2] + "/_buckets.json"))["parts"]
    before = parts()
    store.merge("t", rows(spark.range(3, 4), "new"), ["id"], AT + timedelta(days=1))
    after = parts()
    assert sum(before[b] != after[b] for b in before) == 1 and len(before) == 8
    assert store.read("t").filter("v = 'new'").collect()[0].id == 3 and store.read("t").count() == 1000
    assert store.read("t", 1).filter("v = 'new'").count() == 0
    store.merge("t", rows(spark.range(2).select(F.lit(None).cast("bigint").alias("id")), "none"), ["id"], AT + timedelta(days=2))
    assert store.read("t").count() == 1002


@pytest.mark.parametrize("name", ["named", "null", "none"])
def test_quarantine_keeps_every_row(spark, tmp_path, name):
    store = TableStore(spark, str(tmp_path))
    raw = raw_table(spark, {"a": 9})
    raw = {"named": raw, "null": raw.withColumn(FILE, F.lit(None).cast("string")), "none": raw.drop(FILE)}[name]
    assert ingest_table(raw, TableRule("t"), rules_of(), store, AT).first().status == "REJECTED"
    found = store.read("quarantine")
    assert found.count() == 10 and found.first().quarantined_table == "t" and found.first().attempt_date is not None


def test_raw_rows_are_scanned_once_per_run(spark, tmp_path):
    path = str(tmp_path / "raw")
    raw_table(spark, {"a": 1, "b": 9}).write.parquet(path)
    read = spark.sparkContext.accumulator(0)
    for mode in ("", "full_snapshot", "merge"):
        raw = spark.read.parquet(path)
        counted = raw.mapInArrow(_counting(read), raw.schema)
        read.value = 0
        ingest_table(counted, TableRule("t", mode=mode), rules_of(), TableStore(spark, str(tmp_path / f"s{mode}")), AT)
        assert read.value <= 2 * 20, mode  # once to type, once for the refused rows


def _counting(total):
    def count(batches):
        for batch in batches:
            total.add(batch.num_rows)
            yield batch

    return count


def test_an_interrupted_first_write_does_not_block_a_table(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    (tmp_path / "t" / "snapshot_id=1" / "snapshot_ts=20250115T103000").mkdir(parents=True)
    (tmp_path / "u" / "run_id=auto-1").mkdir(parents=True)
    assert not store.exists("t") and not store.exists("u")
    store.replace("t", spark.range(3), AT)
    assert store.read("t").count() == 3


def test_counts_hold_beyond_the_progress_history(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    for i in range(5):
        (landing / f"d_2025010{i + 1}.csv").write_text("a\n1\n")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        stream = file_stream(spark, str(landing), "csv", ["a"], run_ts=AT, files_per_batch=1)
        assert load_new_files(stream, str(tmp_path / "out"), str(tmp_path / "state")) == 5
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


def test_the_run_stops_on_exact_counts(spark, tmp_path):
    """Half of 4,000 cells are bad, each text different: far above the limit of 10 %."""
    rows = [("a", f"bad{i}" if i % 2 else str(i), 2025, 1, 1) for i in range(4000)]
    raw = spark.createDataFrame(rows, f"{FILE} string, c0 string, yyyy int, mm int, dd int")
    book = RuleBook(tuple(TableRule(n, file_tolerance="60%") for n in ("one", "two")), {n: (ColumnRule("c0", 0, "INTEGER", action="REJECT"),) for n in ("one", "two")})
    store = TableStore(spark, str(tmp_path))
    log = run(spark, book, store, AT, scan=lambda rule: RawScan("READY", raw)).collect()
    assert [(r.table_name, r.error_count) for r in log] == [("one", 2000)] or [(r.table_name, r.error_count) for r in log] == [("one", 4000)]
    assert "errors" in log[0].error_message


def refused(spark, tmp_path, rule, rules, rows, columns):
    store = TableStore(spark, str(tmp_path))
    raw = spark.createDataFrame(rows, f"{FILE} string, {columns}, yyyy int, mm int, dd int")
    return {r.filename: (r.status, r.error_message) for r in ingest_table(raw, rule, rules, store, AT).collect()}, store


def test_limits_of_a_rule_refuse_files(spark, tmp_path):
    rows = [("a", "x" if i < 6 else str(i), 2025, 1, 1) for i in range(100)] + [("b", str(i), 2025, 1, 1) for i in range(100)]
    rules = (ColumnRule("c0", 0, "INTEGER"),)
    for n, (field, value) in enumerate([("stop_percent", 6.0), ("invalid_percent", 50.0), (None, None), ("stop_percent", 7.0)]):
        rule = TableRule("t", file_tolerance="50%", **({field: value} if field else {}))
        got, store = refused(spark, tmp_path / str(n), rule, rules, rows, "c0 string")
        assert got["b"][0] == "SUCCESS"
        assert got["a"][0] == ("REJECTED" if n < 2 else "SUCCESS"), field
        assert store.exists("quarantine") == (n < 2)


def test_repeated_keys_and_critical_errors_refuse_files(spark, tmp_path):
    rows = [("a", str(i // 2), "1", 2025, 1, 1) for i in range(20)] + [("b", str(i), "1" if i else "x", 2025, 1, 1) for i in range(20)]
    rules = (ColumnRule("c0", 0, "INTEGER", merge_key=True), ColumnRule("c1", 1, "INTEGER", action="LOG_ONLY"))
    got, store = refused(spark, tmp_path / "d", TableRule("t", duplicate_tolerance="20%"), rules, rows, "c0 string, c1 string")
    assert got["a"][0] == "REJECTED" and "RLD" in got["a"][1] and got["b"][0] == "SUCCESS"
    assert {r[FILE] for r in store.read("t_all").collect()} == {"b"}
    got, store = refused(spark, tmp_path / "c", TableRule("t", critical_errors=("000000009",)), rules, rows, "c0 string, c1 string")
    assert got["b"][0] == "REJECTED" and "critical" in got["b"][1]
