"""Thresholds and gates of a file beyond its tolerance: they refuse files the verdict accepted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.tolerances import invalid_columns_ok, percent_of, rejected_lines_ok, stops_ingestion
from millrace.names import ERROR_NUMBERS, FAILED_QUALITY, FILE, REJECTED, SUCCESS, col, sum_of
from millrace.operators.quality import duplicate_shares, quality_gate
from millrace.operators.typing import TypedTable
from millrace.operators.verdict import accepted_rows, bad_count_name
from millrace.rules import TableRule


def _refuse(verdict: DataFrame, when: Column, number: Column, message: Column, ratio: Column) -> DataFrame:
    """Accepted files for which the condition holds are rejected with the given reason."""
    hit = (F.col("status") == SUCCESS) & F.coalesce(when, F.lit(False))
    changed = {
        "error_no": F.when(hit, number).otherwise(F.col("error_no")), "message": F.when(hit, message).otherwise(F.col("message")),
        "failing_ratio": F.when(hit, ratio).otherwise(F.col("failing_ratio")),
        "rejected_lines": F.when(hit, 0).otherwise(F.col("rejected_lines")), "accepted_rows": F.when(hit, 0).otherwise(F.col("accepted_rows")),
        "status": F.when(hit, REJECTED).otherwise(F.col("status")),
    }
    return verdict.withColumns(changed)


def _percent_text(name: str, part: Column, total: Column, limit: float) -> Column:
    return F.concat(F.lit(f"{name}: "), F.format_string("%.2f%%", percent_of(part, total)), F.lit(f", allowed are {limit:.2f}%"))


def threshold_gates(verdict: DataFrame, table: TypedTable, rule: TableRule) -> DataFrame:
    """Per-file shares of bad cells, rejected lines and invalid columns against the limits that the rule names.

    All of them come from the counts of the verdict; no row is read again.
    """
    total = F.col("total_rows")
    flagged = [r for r in table.checked if r.reported]
    bad = sum_of([col(bad_count_name(r)) for r in flagged]) if flagged else F.lit(0)
    cells = total * max(len(flagged), 1)
    lost = F.col("corrupt_rows") + F.col("dropped_rows") + F.col("rejected_lines")
    checks = [
        (rule.stop_percent, lambda p: stops_ingestion(bad, cells, p), "bad cells", bad, cells, "RLK"),
        (rule.rejected_percent, lambda p: ~rejected_lines_ok(lost, total, p), "rejected lines", lost, total, "RLI"),
        (rule.invalid_percent, lambda p: ~invalid_columns_ok(F.col("flagged_columns"), F.lit(max(len(flagged), 1)), p), "invalid columns",
         F.col("flagged_columns"), F.lit(max(len(flagged), 1)), "RLK"),
    ]
    for percent, exceeds, name, part, whole, kind in checks:
        if percent is not None:
            verdict = _refuse(verdict, exceeds(percent), F.lit(ERROR_NUMBERS[kind]), _percent_text(name, part, whole, percent), percent_of(part, whole) / 100.0)
    return verdict


def duplicate_gate(verdict: DataFrame, table: TypedTable, rule: TableRule, keys: Sequence[str]) -> DataFrame:
    """Files whose share of repeated keys exceeds the rule's tolerance are refused."""
    if not rule.duplicate_tolerance or not keys:
        return verdict
    shares = duplicate_shares(accepted_rows(table, verdict), keys, rule.duplicate_tolerance).filter(F.col("status") == REJECTED)
    found = shares.select(F.col(FILE).alias("__file"), F.col("error_no").alias("__error"), F.col("message").alias("__text"), "duplicate_ratio")
    joined = verdict.join(found, F.col(FILE) == F.col("__file"), "left")
    return _refuse(joined, F.col("__file").isNotNull(), F.col("__error"), F.col("__text"), F.col("duplicate_ratio")).drop("__file", "__error", "__text", "duplicate_ratio")


def critical_gate(verdict: DataFrame, errors: DataFrame, critical: Sequence[str]) -> DataFrame:
    """Files with an error of a critical number are refused and not written."""
    gate = quality_gate(verdict.select(FILE), errors, critical).filter(F.col("gate") == FAILED_QUALITY)
    found = gate.select(F.col(FILE).alias("__file"), F.col("critical_errors").alias("__n"))
    joined = verdict.join(found, F.col(FILE) == F.col("__file"), "left")
    text = F.concat(F.lit("quality gate: "), F.col("__n").cast("string"), F.lit(" critical errors"))
    share = F.col("__n") / F.greatest(F.col("total_rows"), F.lit(1)).cast("double")
    return _refuse(joined, F.col("__n").isNotNull(), F.lit(critical[0]), text, F.least(share, F.lit(1.0))).drop("__file", "__n")
