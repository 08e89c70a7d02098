"""Checks on typed rows: mandatory values, uniqueness, formats, row counts, gates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.messages import tolerance_exceeded
from millrace.functions.tolerances import tolerance_ratio, within_count
from millrace.names import (
    ERROR_NUMBERS, FAILED, FAILED_QUALITY, FILE, PASSED, REJECTED, SUCCESS, any_of, col,
)
from millrace.operators.typing import TypedTable
from millrace.operators.verdict import mandatory_null


def mandatory_nulls(rows: DataFrame, table: TypedTable, name: str) -> DataFrame:
    """One error per NULL in a mandatory column.

    A cell that is NULL because its text was invalid has its own error already.
    """
    required = [rule for rule in table.rules if not rule.nullable]
    nulls = [mandatory_null(rule) for rule in required]
    pairs = [part for rule, null in zip(required, nulls) for part in (F.lit(rule.name), null)] or [F.lit(""), F.lit(False)]
    melted = rows.select(FILE, F.stack(F.lit(len(pairs) // 2), *pairs).alias("column_name", "__null")).filter("__null")
    return melted.select(
        F.lit(name).alias("table_name"),
        F.col(FILE).alias("filename"),
        "column_name",
        F.lit("Mandatory column is NULL").alias("error_message"),
        F.lit(None).cast("string").alias("raw_value"),
        F.lit(ERROR_NUMBERS["RLK"]).alias("error_no"),
        F.lit(1).alias("error_count"),
    )


def duplicate_keys(rows: DataFrame, keys: Sequence[str], by: Sequence[str] = (FILE,)) -> DataFrame:
    """Complete key values that occur more than once, with their number of rows."""
    complete = ~any_of([col(k).isNull() for k in keys])
    return rows.filter(complete).groupBy(*(col(c) for c in [*by, *keys])).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def duplicate_key_errors(rows: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    key_text = F.concat_ws("|", *(col(k).cast("string") for k in keys))
    return duplicate_keys(rows, keys).select(
        F.lit(name).alias("table_name"),
        F.col(FILE).alias("filename"),
        F.lit("|".join(keys)).alias("column_name"),
        F.concat(F.lit("Duplicate key: "), F.col("n").cast("string"), F.lit(" rows")).alias("error_message"),
        key_text.alias("raw_value"),
        F.lit(ERROR_NUMBERS["RLD"]).alias("error_no"),
        F.col("n").cast("int").alias("error_count"),
    )


def duplicate_shares(rows: DataFrame, keys: Sequence[str], tolerance: str) -> DataFrame:
    """Share of repeated lines per file and whether it exceeds the tolerance.

    Counted per key first, so the rows of one file spread over its keys.
    """
    per_key = rows.groupBy(FILE, *(col(k) for k in keys)).agg(F.count(F.lit(1)).alias("n"))
    repeats = F.when(any_of([col(k).isNull() for k in keys]), 0).otherwise(F.col("n") - 1)
    files = per_key.groupBy(FILE).agg(F.sum("n").alias("total_rows"), F.sum(repeats).alias("duplicate_rows"))
    ratio = F.col("duplicate_rows") / F.col("total_rows").cast("double")
    limit = tolerance_ratio(F.lit(tolerance), F.col("total_rows"))
    exceeded = ratio > limit
    none = F.lit(None).cast("string")
    return files.withColumns(
        {
            "duplicate_ratio": ratio,
            "status": F.when(exceeded, REJECTED).otherwise(SUCCESS),
            "error_no": F.when(exceeded, ERROR_NUMBERS["RLD"]),
            "message": F.when(exceeded, tolerance_exceeded(F.lit("RLD"), ratio, limit, none)),
        }
    )


def format_violations(rows: DataFrame, column: str, pattern: str) -> DataFrame:
    """Rows whose filled value does not match the pattern."""
    return rows.filter(col(column).isNotNull() & ~col(column).rlike(pattern))


def row_count_check(counts: DataFrame, actual: Column, expected: Column, percent: Column | float) -> DataFrame:
    return counts.withColumn(
        "row_count_status", F.when(within_count(actual, expected, percent), PASSED).otherwise(FAILED)
    )


def quality_gate(files: DataFrame, errors: DataFrame, critical: Sequence[str]) -> DataFrame:
    """Files with a critical error number fail the gate and must not be written."""
    hits = errors.filter(F.col("error_no").isin(*critical))
    counted = hits.groupBy(F.col("filename").alias(FILE)).agg(F.sum("error_count").alias("critical_errors"))
    joined = files.join(counted, FILE, "left").fillna(0, ["critical_errors"])
    return joined.withColumn("gate", F.when(F.col("critical_errors") > 0, FAILED_QUALITY).otherwise(SUCCESS))
