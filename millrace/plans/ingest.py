"""From raw tables to history, latest load, error table and execution log."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import Future, ThreadPoolExecutor, wait
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.tolerances import FAIL_FAST_PERCENT, is_tolerance_text
from millrace.names import EXECUTION_LOG_SCHEMA, FAILED, FILE, MISSING_COLUMN_ERROR, PROCESSED_AT, SUCCESS, col, sum_of
from millrace.operators.error_rows import bad_values, cell_and_column_errors, file_errors, line_errors, union_errors
from millrace.operators.gates import critical_gate, duplicate_gate, threshold_gates
from millrace.operators.metrics import execution_log
from millrace.operators.quality import duplicate_key_errors, mandatory_nulls
from millrace.operators.shape import missing_columns, presence_errors
from millrace.operators.typing import TypedTable, type_columns, with_file_name
from millrace.operators.verdict import accepted_rows, bad_count_name, file_counts, file_verdict, latest_files
from millrace.rules import ColumnRule, RuleBook, TableRule
from millrace.session import materialize
from millrace.sinks.ingestion import apply_ingestion_mode, quarantine, write_quality_errors
from millrace.sinks.tables import TableStore
from millrace.sources.files import RawScan, run_columns, scan_raw, source_files

#: Table of the files that finished runs have taken.
LOADED_FILES = "loaded_files"
#: So many tables of a run load at the same time.
TABLES_AT_ONCE = 4


@dataclass(frozen=True)
class Outcome:
    """Files accepted and refused, and what the accepted ones hold."""

    passed: int
    refused: int
    bad_cells: int
    null_rows: int


@dataclass(frozen=True)
class JudgedTable:
    """A typed raw table and the written verdict on each of its files."""

    rule: TableRule
    typed: TypedTable
    verdict: DataFrame

    def accepted(self) -> DataFrame:
        """Typed and system columns of the accepted rows."""
        return self.typed.values(accepted_rows(self.typed, self.verdict))

    def latest(self) -> DataFrame:
        """Accepted rows of the files with the most recent date."""
        return self.typed.values(accepted_rows(self.typed, latest_files(self.verdict)))

    def outcome(self) -> Outcome:
        """What the verdict says about the work left to do; reads one row per file."""
        bad = sum_of([col(bad_count_name(r)) for r in self.typed.checked if r.reported])
        passed = F.col("status") == SUCCESS
        row = self.verdict.agg(
            F.count_if(passed).alias("passed"),
            F.count_if(~passed).alias("refused"),
            F.sum(F.when(passed, bad + F.col("corrupt_rows"))).alias("bad_cells"),
            F.sum(F.when(passed, F.col("null_rows"))).alias("null_rows"),
        ).first()
        return Outcome(row.passed, row.refused, row.bad_cells or 0, row.null_rows or 0)

    def errors(self, merge_keys: Sequence[str] = (), outcome: Outcome | None = None) -> DataFrame:
        """All error rows of the table; passes over the rows that cannot find any are left out."""
        left = outcome or self.outcome()
        frames = [file_errors(self.verdict, self.rule), line_errors(self.verdict, self.rule)]
        rows = accepted_rows(self.typed, self.verdict)
        if left.bad_cells:
            passed = self.verdict.filter(F.col("status") == SUCCESS)
            values = materialize(bad_values(self.typed, passed), "bad-values")
            frames.append(cell_and_column_errors(values, self.verdict, self.typed, self.rule))
        if left.null_rows:
            frames.append(mandatory_nulls(rows, self.typed, self.rule.name))
        if merge_keys and left.passed:
            frames.append(duplicate_key_errors(rows, merge_keys, self.rule.name))
        return union_errors(frames)


def judge(raw: DataFrame, rule: TableRule, rules: Sequence[ColumnRule], *, fill_defaults: bool = False) -> JudgedTable:
    """Type a raw table and decide on every file: one job, however many files and columns."""
    typed = type_columns(raw, rules, trim=rule.trim, fill_defaults=fill_defaults)
    verdict = materialize(file_verdict(file_counts(typed, rule), typed, rule), "verdict")
    return JudgedTable(rule, typed, verdict)


def _failure_log(
    files: DataFrame, rule: TableRule, message: str, run_ts: Column, env: str, error_no: str | None = None
) -> DataFrame:
    """FAILED log rows; ``files`` has the file name and its rows."""
    failed = files.select(
        FILE, "total_rows", F.lit(FAILED).alias("status"), F.lit(error_no).cast("string").alias("error_no"),
        F.lit(None).cast("string").alias("message"),
    )
    no_errors = files.sparkSession.createDataFrame([], "filename string, error_count int")
    log = execution_log(failed, no_errors, rule, 0, run_ts, env)
    return log.withColumn("error_message", F.lit(message))


def rule_problems(rule: TableRule, rules: Sequence[ColumnRule]) -> list[str]:
    """What is wrong with a table's rules; a table with a wrong rule is not loaded."""
    problems = [f"{r.name}: {r.problem()}" for r in rules if r.problem()]
    if not is_tolerance_text(rule.file_tolerance):
        problems.append(f"invalid tolerance: {rule.file_tolerance}")
    return problems


def run_name(table: str, run_ts: datetime) -> str:
    """Name of a table's run: the same for a repeated attempt."""
    return f"{table}-{run_ts:%Y%m%dT%H%M%S}"


def _gated_verdict(typed: TypedTable, rule: TableRule, merge_keys: Sequence[str]) -> DataFrame:
    """The written verdict on each file, after the limits and gates that the rule names."""
    verdict = materialize(threshold_gates(file_verdict(file_counts(typed, rule), typed, rule), typed, rule), "verdict")
    if rule.duplicate_tolerance and merge_keys:
        verdict = materialize(duplicate_gate(verdict, typed, rule, merge_keys), "verdict")
    if rule.critical_errors:
        errors = JudgedTable(rule, typed, verdict).errors(merge_keys)
        verdict = materialize(critical_gate(verdict, errors, rule.critical_errors), "verdict")
    return verdict


def _deliveries(raw: DataFrame) -> DataFrame:
    """The files of a raw table, each with the time it was processed, if known."""
    time = F.col(PROCESSED_AT).cast("string") if PROCESSED_AT in raw.columns else F.lit(None).cast("string")
    return with_file_name(raw).select(FILE, time.alias("delivered"))


def new_files(raw: DataFrame, rule: TableRule, store: TableStore) -> DataFrame:
    """Rows of files that no finished run has taken. A file delivered again has a new processing time."""
    if not store.exists(LOADED_FILES):
        return raw
    loaded = store.read(LOADED_FILES).filter(F.col("loaded_table") == rule.name).select(
        F.col(FILE).alias("__file"), F.col("delivered").alias("__delivered")
    ).distinct()
    named = with_file_name(raw)
    time = F.col(PROCESSED_AT).cast("string") if PROCESSED_AT in raw.columns else F.lit(None).cast("string")
    known = (F.col(FILE) == F.col("__file")) & time.eqNullSafe(F.col("__delivered"))
    return named.join(loaded, known, "left_anti")


def ingest_table(
    raw: DataFrame, rule: TableRule, rules: Sequence[ColumnRule], store: TableStore, run_ts: datetime, env: str = "dev", finish: bool = True
) -> DataFrame:
    """Load the new files of one raw table and return their execution-log rows.

    Accepted rows, error rows, refused files and the log are written; a refused
    file never stops the others. Raw rows are read and typed once, into a written
    table that all later steps read with the columns they need. Everything is
    written under the name of the run and counts when the run is finished, so a
    run that failed anywhere is simply repeated; a file is taken by one run only.
    Without ``finish`` the caller finishes the run, named :func:`run_name`, in the store.
    """
    run_label = run_name(rule.name, run_ts)
    started = time.monotonic()
    ts, _ = run_columns(run_ts)
    if store.is_finished(run_label):
        return store.read_run("execution_log", run_label)
    problems = rule_problems(rule, rules)
    required = [r.name for r in rules if not r.nullable]
    missing = missing_columns(raw, required)
    fresh = new_files(raw, rule, store)
    if problems or missing:
        files = materialize(source_files(fresh), "files")
        if missing:
            write_quality_errors(store, presence_errors(files, missing, rule.name), rule.zone, ts, run_label)
        message = "; ".join(problems) if problems else "Missing columns"
        number = None if problems else MISSING_COLUMN_ERROR
        return _log(store, _failure_log(files, rule, message, ts, env, number), run_label, finish)

    typed = type_columns(fresh, rules, trim=rule.trim, fill_defaults=True)
    typed = replace(typed, frame=materialize(typed.frame, "typed"))
    merge_keys = [r.name for r in rules if r.merge_key]
    judged = JudgedTable(rule, typed, _gated_verdict(typed, rule, merge_keys))
    accepted = judged.accepted()
    outcome = judged.outcome()
    if outcome.passed:
        apply_ingestion_mode(store, accepted, judged.latest(), rule, merge_keys, run_ts, run_label)
    errors = write_quality_errors(store, judged.errors(merge_keys, outcome), rule.zone, ts, run_label)
    if outcome.refused:
        quarantine(store, fresh, judged.verdict, rule.name, run_ts, run_label)
    files = _deliveries(typed.frame).distinct().withColumn("loaded_table", F.lit(rule.name))
    store.append(LOADED_FILES, files, ("loaded_table",), run_label)
    seconds = round(time.monotonic() - started, 2)
    return _log(store, execution_log(judged.verdict, errors, rule, len(accepted.columns), ts, env, seconds), run_label, finish)


def _log(store: TableStore, log: DataFrame, run_label: str, finish: bool) -> DataFrame:
    """Write the log of a run, the last thing it does."""
    store.append("execution_log", log, run=run_label)
    if finish:
        store.finish(run_label)
    return store.read_run("execution_log", run_label).select(*(col(f.name) for f in EXECUTION_LOG_SCHEMA))


def run(
    spark: SparkSession,
    book: RuleBook,
    store: TableStore,
    run_ts: datetime,
    env: str = "dev",
    scan: Callable[[TableRule], RawScan] | None = None,
    fail_fast_percent: float | None = FAIL_FAST_PERCENT,
    at_once: int = TABLES_AT_ONCE,
) -> DataFrame:
    """Load all tables of the rule book and return the log of the run.

    Tables load ``at_once`` at a time, as jobs of one session, and count in the order of
    the book: errors of earlier tables can stop the run before the next one. Then jobs
    that still run are cancelled, and what later tables had written does not count. So the
    log and the tables do not depend on ``at_once``. Tables that
    are absent or empty are skipped. A table whose load fails is logged as FAILED,
    and the next one loads; what it had written does not count, and the
    next run takes its files again.
    """
    open_raw = scan or (lambda rule: scan_raw(spark, rule.raw_table_name))
    ts, _ = run_columns(run_ts)
    tag = f"run-{uuid.uuid4().hex}"

    def load(rule: TableRule) -> tuple[DataFrame | None, str | None]:
        """The log of a table that is loaded but not finished, or why there is none."""
        spark.sparkContext.addJobTag(tag)
        spark.sparkContext.setInterruptOnCancel(True)
        try:
            found = open_raw(rule)
            if found.status in ("ABSENT", "EMPTY"):
                return None, None
            if found.frame is None:
                return None, found.message
            return ingest_table(found.frame, rule, book.columns_of(rule.name), store, run_ts, env, finish=False), None
        except Exception as problem:  # noqa: BLE001 - whatever stops a table must not stop the run
            return None, f"{type(problem).__name__}: {problem}".splitlines()[0]

    logs: list[DataFrame] = []
    errors = processed = 0
    pool = ThreadPoolExecutor(max(1, at_once))
    # Each load inherits the caller's job settings; its own tag stays in its thread.
    loads = [pool.submit(inheritable_thread_target(spark)(load), rule) for rule in book.tables]
    try:
        for rule, loading in zip(book.tables, loads):
            if fail_fast_percent is not None and errors and errors / max(processed, 1) * 100 >= fail_fast_percent:
                break
            log, failure = loading.result()
            if failure is not None:
                nothing = spark.createDataFrame([("N/A", 0)], f"{FILE} string, total_rows bigint")
                log = materialize(_failure_log(nothing, rule, failure, ts, env), "log")
                store.append("execution_log", log)
            elif log is None:
                continue
            else:
                store.finish(run_name(rule.name, run_ts))
            logs.append(log)
            sums = log.agg(
                F.coalesce(F.sum("error_count"), F.lit(0)).alias("errors"),
                F.coalesce(F.sum("row_count"), F.lit(0)).alias("processed"),
            ).first()
            errors, processed = errors + sums.errors, processed + sums.processed
    finally:
        _end(spark, pool, loads, tag)
    if not logs:
        return spark.createDataFrame([], EXECUTION_LOG_SCHEMA)
    result = logs[0]
    for log in logs[1:]:
        result = result.unionByName(log)
    return result


def _end(spark: SparkSession, pool: ThreadPoolExecutor, loads: Sequence[Future], tag: str) -> None:
    """Drop loads that wait and cancel the jobs of those that run, until none does: a load may start a job after a cancel."""
    pool.shutdown(wait=False, cancel_futures=True)
    while wait([f for f in loads if not f.cancelled()], timeout=0).not_done:
        spark.sparkContext.cancelJobsWithTag(tag)
        wait([f for f in loads if not f.cancelled()], timeout=0.5)
