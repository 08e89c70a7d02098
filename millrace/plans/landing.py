"""From a landing folder of archives to raw tables, each archive once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.filenames import received_name
from millrace.names import FAILED, FILE, REJECTED, SUCCESS
from millrace.operators.arrivals import judge_file_dates, judge_registered_names
from millrace.operators.error_rows import normalized, union_errors
from millrace.operators.shape import presence_errors
from millrace.plans.ingest import run_name
from millrace.session import materialize
from millrace.sinks.ingestion import write_quality_errors
from millrace.sinks.tables import TableStore
from millrace.sources.archives import archives, expand_archives, expanded_errors, records_as_csv, sound_records
from millrace.sources.files import run_columns, table_of_file, with_file_metadata

LANDED = "landed_archives"
LOG = "landing_log"
UNKNOWN_TABLE = "no table for this file"


def _judged(files: DataFrame, expected: date | None, days: int, registry: DataFrame | None) -> DataFrame:
    """``status`` and ``error_no`` of each file name: registered pattern first, then the expected date."""
    judged = files.withColumns({"status": F.lit(SUCCESS), "error_no": F.lit(None).cast("string")})
    if registry is not None:
        named = judge_registered_names(files, "member", registry)
        judged = named.select(*files.columns, "status", "error_no")
    if expected is not None:
        dated = judge_file_dates(judged.withColumnsRenamed({"status": "__status", "error_no": "__error_no"}), F.col("member"), F.lit(expected), days)
        refused = F.col("__status") == REJECTED
        judged = dated.withColumns({"error_no": F.when(refused, F.col("__error_no")).otherwise(F.col("error_no")), "status": F.when(refused, REJECTED).otherwise(F.col("status"))})
    return judged.select(*files.columns, "status", "error_no")


def _errors(log: DataFrame, damaged: DataFrame) -> DataFrame:
    """Error rows of damaged archives and refused files."""
    broken = damaged.select(F.lit("N/A").alias("table_name"), F.col("archive").alias("filename"), F.lit("filename").alias("column_name"), F.col("error").alias("error_message"))
    refused = log.filter(F.col("status") != SUCCESS).select("table_name", "filename", F.lit("filename").alias("column_name"), F.col("message").alias("error_message"), "error_no")
    return union_errors([normalized(broken), normalized(refused)])


def land_archives(
    spark: SparkSession,
    folder: str,
    tables: Mapping[str, Sequence[str]],
    store: TableStore,
    run_ts: datetime,
    *,
    expected_date: date | None = None,
    tolerance_days: int = 0,
    registry: DataFrame | None = None,
) -> DataFrame:
    """Load the new archives of a folder into the raw tables ``<table>_raw`` of the store; return one log row per member.

    ``tables``: the columns of each table; a member belongs to the table its name
    begins with. Columns are bound by the member's header, a missing one is an
    error row and NULL. Damaged archives and refused names are errors and do not stop
    the others. Members are read once, into a written table. Row counts are those
    of the records that were written. An archive is taken by one finished run
    only; a run that failed is repeated under its name and leaves the same tables.
    """
    label = run_name("landing", run_ts)
    if store.is_finished(label):
        return store.read_run(LOG, label)
    ts, _ = run_columns(run_ts)
    found = archives(spark, folder)
    if store.exists(LANDED):
        found = found.join(store.read(LANDED).select("archive").distinct(), "archive", "left_anti")
    found = materialize(found, "new-archives")
    expanded = materialize(expand_archives(found), "expanded")
    damaged = materialize(expanded_errors(expanded), "damaged-archives")
    sound = sound_records(expanded)
    counted = sound.groupBy("archive", "member").agg(
        F.max("header").alias("header"), F.count_if((F.col("line_no") > 1) & (F.trim("line") != "")).alias("row_count")
    )
    table = table_of_file(F.col("member"))
    judged = _judged(counted, expected_date, tolerance_days, registry)
    known = table.isin(list(tables))
    log = materialize(
        judged.select(
            "archive", "member", table.alias("table_name"), received_name(F.col("member")).alias("filename"), "header",
            F.when(known, F.col("status")).otherwise(FAILED).alias("status"), "error_no",
            F.when(~known, UNKNOWN_TABLE).when(F.col("status") != SUCCESS, F.concat(F.lit("refused file name: "), F.col("member"))).alias("message"),
            F.when(known & (F.col("status") == SUCCESS), F.col("row_count")).otherwise(0).alias("row_count"), ts.alias("log_ts"),
        ),
        "landing-files",
    )
    errors = [_errors(log, damaged)]
    for name, columns in tables.items():
        mine = log.filter((F.col("table_name") == name) & (F.col("status") == SUCCESS))
        if mine.isEmpty():
            continue
        records = sound.join(mine.select("archive", "member"), ["archive", "member"], "left_semi")
        rows = with_file_metadata(records_as_csv(records, columns), F.col("path"), run_ts).drop("path")
        store.append(f"{name}_raw", rows, run=label)
        errors += _missing(mine, columns, name)
    write_quality_errors(store, union_errors(errors), "landing", ts, label)
    store.append(LANDED, found.withColumn("landed_at", ts), (), label)
    store.append(LOG, log.drop("header"), (), label)
    store.finish(label)
    return store.read_run(LOG, label)


def _missing(files: DataFrame, columns: Sequence[str], table: str) -> list[DataFrame]:
    """Error rows of the columns that the members' headers lack, one frame per kind of header."""
    import csv

    frames = []
    for kind in files.select("header").distinct().collect():
        names = {n.strip().lower() for n in next(csv.reader([kind.header or ""]), [])}
        if lacking := [c for c in columns if c.lower() not in names]:
            same = files.filter(F.col("header").eqNullSafe(F.lit(kind.header))).select(F.col("filename").alias(FILE))
            frames.append(presence_errors(same, lacking, table))
    return frames
