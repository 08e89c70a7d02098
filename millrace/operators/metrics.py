"""Metrics, execution log and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.messages import numbered, partial_load
from millrace.functions.tolerances import FAIL_FAST_PERCENT, percent_of
from millrace.names import (
    EXECUTION_LOG_SCHEMA, FAILED, FILE, PARTITIONS, REJECTED, SUCCESS, col, sum_of,
)
from millrace.rules import TableRule


def error_totals(errors: DataFrame) -> DataFrame:
    """Sum of error counts per file."""
    return errors.groupBy(F.col("filename").alias(FILE)).agg(F.sum("error_count").alias("anomalies_total"))


def final_metrics(verdict: DataFrame, errors: DataFrame) -> DataFrame:
    """Corrupt rows, anomalies and clean rows per file."""
    return (
        verdict.join(error_totals(errors), FILE, "left")
        .select(
            FILE,
            "total_rows",
            "corrupt_rows",
            F.coalesce("anomalies_total", F.lit(0)).cast("bigint").alias("anomalies_total"),
            F.col("accepted_rows").cast("bigint").alias("cleaned_rows"),
        )
    )


def error_summary(errors: DataFrame) -> DataFrame:
    return errors.groupBy("table_name", "column_name").agg(
        F.sum("error_count").alias("errors"), F.count(F.lit(1)).alias("error_rows")
    )


def execution_log(
    verdict: DataFrame, errors: DataFrame, rule: TableRule, column_count: int, run_ts: Column, env: str, duration: float = 0.0
) -> DataFrame:
    """One 18-column log row per file, for all outcomes at once."""
    totals = verdict.join(error_totals(errors), FILE, "left")
    status = F.col("status")
    found = F.coalesce("anomalies_total", F.lit(0))
    message = (
        F.when(status == REJECTED, numbered(F.col("error_no"), F.col("message")))
        .when(status == FAILED, "Too many corrupt lines")
        .when(found > 0, F.concat(found.cast("string"), F.lit(" errors")))
    )
    values = {
        "table_name": F.lit(rule.name),
        "filename": F.col(FILE),
        "input_format": F.when(status == REJECTED, rule.input_format).otherwise("staging"),
        "ingestion_mode": F.lit(rule.mode),
        "output_zone": F.lit(rule.zone),
        "row_count": F.col("total_rows"),
        "column_count": F.when(status == REJECTED, 0).otherwise(column_count),
        "masking_applied": F.lit(False),
        "error_count": F.when(status == SUCCESS, found).otherwise(0),
        "error_message": message,
        "error_no": F.col("error_no"),
        "status": status,
        "duration": F.lit(duration),
        "env": F.lit(env),
        "log_ts": run_ts,
        "yyyy": F.year(run_ts),
        "mm": F.month(run_ts),
        "dd": F.dayofmonth(run_ts),
    }
    return totals.select(*(values[f.name].cast(f.dataType).alias(f.name) for f in EXECUTION_LOG_SCHEMA))


def run_counters(log: DataFrame) -> DataFrame:
    """Files by outcome, with the outcome code of the run.

    1 when any file failed, 2 when every file was rejected, else 0.
    """
    counted = log.agg(
        F.count_if(F.col("status") == SUCCESS).alias("files_succeeded"),
        F.count_if(F.col("status") == REJECTED).alias("files_rejected"),
        F.count_if(F.col("status") == FAILED).alias("files_failed"),
        F.count(F.lit(1)).alias("files_total"),
    )
    none_passed = (F.col("files_rejected") > 0) & (F.col("files_succeeded") == 0)
    return counted.withColumn(
        "outcome_code", F.when(F.col("files_failed") > 0, 1).when(none_passed, 2).otherwise(0)
    )


def run_report(log: DataFrame) -> DataFrame:
    """Processed and failed files and the time spent, per table."""
    return log.groupBy("table_name").agg(
        F.count_if(F.col("status") == SUCCESS).alias("files_processed"),
        F.count_if(F.col("status").isin(FAILED, REJECTED)).alias("files_failed"),
        F.sum("duration").alias("duration"),
    )


def rejected_files(log: DataFrame) -> DataFrame:
    return log.filter(F.col("status") == REJECTED).orderBy(F.col("log_ts").desc(), "filename")


def fail_fast_errors(errors: DataFrame) -> DataFrame:
    return errors.filter(F.col("error_message").contains("FAIL FAST")).orderBy(F.col("log_ts").desc(), "filename")


def latest(results: DataFrame, count: int = 10, by: str = "timestamp") -> DataFrame:
    """The most recent results; other columns break ties."""
    ties = [col(c) for c in results.columns if c != by]
    return results.orderBy(col(by).desc(), *ties).limit(count)


def load_messages(verdict: DataFrame) -> DataFrame:
    lost = F.col("total_rows") - F.col("accepted_rows")
    return verdict.select(FILE, "status", partial_load(F.col("accepted_rows"), lost).alias("load_message"))


def dataset_metrics(df: DataFrame, dataset: str, columns: Sequence[str], created: Column, is_clean: Column | None = None) -> DataFrame:
    """Rows, NULLs and the share of clean rows of a dataset; clean means no NULL unless given."""
    nulls = sum_of([col(c).isNull().cast("bigint") for c in columns])
    clean = is_clean if is_clean is not None else nulls == 0
    measured = df.select(nulls.alias("__nulls"), clean.alias("__clean")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.coalesce(F.sum("__nulls"), F.lit(0)).alias("null_count"),
        F.count_if(F.col("__clean")).alias("__good"),
    )
    score = F.when(F.col("row_count") > 0, F.col("__good") / F.col("row_count").cast("double")).otherwise(0.0)
    return measured.select(
        F.lit(dataset).alias("dataset"), "row_count", "null_count", score.alias("quality_score"),
        created.cast("date").alias("date_created"),
    )


def run_wide_stop(tables: DataFrame, percent: float = FAIL_FAST_PERCENT) -> DataFrame:
    """Tables of a run in order, marked when earlier errors stop the run before them.

    ``tables`` has one row per configured table: table_index, errors, processed.
    """
    before = Window.orderBy("table_index").rowsBetween(Window.unboundedPreceding, -1)
    sums = tables.withColumns(
        {
            "errors_before": F.coalesce(F.sum("errors").over(before), F.lit(0)),
            "processed_before": F.coalesce(F.sum("processed").over(before), F.lit(0)),
        }
    )
    reached = (F.col("errors_before") > 0) & (
        percent_of(F.col("errors_before"), F.col("processed_before")) >= percent
    )
    ever = Window.orderBy("table_index").rowsBetween(Window.unboundedPreceding, 0)
    return sums.withColumn("stopped", F.max(reached).over(ever))


def partition_values(rows: DataFrame) -> DataFrame:
    """Partition values of each file: its smallest complete date triple."""
    triple = F.struct(*PARTITIONS)
    known = F.col("yyyy").isNotNull() & F.col("mm").isNotNull() & F.col("dd").isNotNull()
    return rows.groupBy(FILE).agg(F.min(F.when(known, triple)).alias("__parts")).select(FILE, "__parts.*")
