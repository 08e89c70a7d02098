"""Texts of error rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.names import DEFAULT_ERROR_NUMBER, ERROR_NUMBERS


def error_number(kind: Column) -> Column:
    """Error number of a tolerance kind; the default for an unknown kind."""
    chosen = F.lit(DEFAULT_ERROR_NUMBER)
    for name, number in ERROR_NUMBERS.items():
        chosen = F.when(kind == name, number).otherwise(chosen)
    return chosen


def percent_text(ratio: Column, digits: int = 2) -> Column:
    return F.format_string(f"%.{digits}f%%", ratio * 100.0)


def tolerance_exceeded(kind: Column, actual: Column, threshold: Column, column: Column) -> Column:
    """``Column 'c': RLK tolerance exceeded: 100.00% > 10.00%``; no prefix for a NULL column."""
    body = F.concat(kind, F.lit(" tolerance exceeded: "), percent_text(actual), F.lit(" > "), percent_text(threshold))
    prefix = F.when(column.isNotNull(), F.concat(F.lit("Column '"), column, F.lit("': ")))
    return F.concat(F.coalesce(prefix, F.lit("")), body)


def numbered(number: Column, message: Column) -> Column:
    """Text of an execution-log entry for a rejected file."""
    return F.concat(F.lit("["), number, F.lit("] REJECTED - "), message)


def invalid_summary(action: Column, bad: Column, total: Column) -> Column:
    """``ICT_DRIVEN: 3/100 invalid (3.0%)``"""
    share = F.when(total > 0, bad / total.cast("double")).otherwise(0.0)
    return F.concat(
        action, F.lit(": "), bad.cast("string"), F.lit("/"), total.cast("string"),
        F.lit(" invalid ("), percent_text(share, 1), F.lit(")"),
    )


def rejected_cell(column: Column, declared: Column, bad: Column, total: Column, value: Column) -> Column:
    share = F.when(total > 0, bad / total.cast("double")).otherwise(0.0)
    return F.concat(
        F.lit("COLUMN REJECTED: "), column, F.lit(". Expected type: "), declared, F.lit(", "),
        bad.cast("string"), F.lit(" invalid values of "), total.cast("string"), F.lit(" rows ("),
        percent_text(share, 1), F.lit("). Value: "), value,
    )


def date_failure(pattern: Column, value: Column) -> Column:
    return F.concat(F.lit("DATE_PARSE_ERROR: Pattern '"), pattern, F.lit("' does not match. Value: "), value)


def partial_load(accepted: Column, rejected: Column) -> Column:
    return F.format_string("%d rows integrated, %d rejected", accepted, rejected)
