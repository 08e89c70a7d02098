"""Per-file counts and the verdict on each file, from one grouped pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.messages import error_number, tolerance_exceeded
from millrace.functions.tolerances import tolerance_ratio
from millrace.names import FAILED, FILE, FILE_DATE, PARTITIONS, REJECTED, SUCCESS, any_of, col, sum_of
from millrace.operators.typing import CORRUPT_LINE, DROPPED, FLAGS, GONE, TypedTable, bad_name
from millrace.rules import ColumnRule, TableRule


def bad_count_name(rule: ColumnRule) -> str:
    return f"bad_{rule.name}"


def line_limits(table: TypedTable, rule: TableRule) -> list[int]:
    """Every line limit a file can get: it depends on how many columns have flags."""
    flag_columns = sum(1 for r in table.rules if r.flags_lines)
    return list(range(1, max(1, int(flag_columns * rule.line_tolerance)) + 1))


def load_date(columns: Sequence[str]) -> Column:
    """Date of a row's file: from its name, else its partition values, else NULL."""
    choices = [F.col(FILE_DATE)] if FILE_DATE in columns else []
    if all(c in columns for c in PARTITIONS):
        choices.append(F.make_date(*(F.col(c) for c in PARTITIONS)))
    return F.coalesce(*choices) if choices else F.lit(None).cast("date")


def mandatory_null(rule: ColumnRule) -> Column:
    """NULL in a mandatory column that is not an invalid cell, which has its own error."""
    missing = col(rule.name).isNull()
    return missing if rule.is_text else missing & ~col(bad_name(rule))


def counter_columns(table: TypedTable, rule: TableRule) -> tuple[dict[str, Column], Column]:
    """What is counted of a file's rows, as conditions by name, and the date of a row; ``over_n`` are lines over the n-th limit."""
    no_value = any_of([mandatory_null(r) for r in table.rules if not r.nullable])
    remaining = col(FLAGS) < GONE
    counters = {"total_rows": F.lit(True), "corrupt_rows": col(CORRUPT_LINE), "dropped_rows": col(DROPPED)}
    counters |= {bad_count_name(r): col(bad_name(r)) for r in table.checked}
    counters |= {"null_rows": remaining & no_value}
    counters |= {f"over_{n}": remaining & (col(FLAGS) > n) for n in line_limits(table, rule)}
    return counters, load_date(table.kept)


def file_counts(table: TypedTable, rule: TableRule) -> DataFrame:
    """Row, corrupt, removed and invalid-cell counts of every file.

    One hash aggregate with map-side partial counts, whatever the number of
    files and columns, so one dominant file is no bottleneck.
    """
    counters, date = counter_columns(table, rule)
    over = [F.count_if(c) for name, c in counters.items() if name.startswith("over_")]
    return table.frame.groupBy(FILE).agg(
        *(F.count_if(c).alias(name) for name, c in counters.items() if not name.startswith("over_")),
        F.array(*over).alias("lines_over"),
        F.max(date).alias("load_date"),
    )


def _ratio(count: Column) -> Column:
    return F.when(F.col("total_rows") > 0, count / F.col("total_rows").cast("double")).otherwise(0.0)


def file_verdict(counts: DataFrame, table: TypedTable, rule: TableRule) -> DataFrame:
    """Status of every file.

    Too many corrupt lines fail a file. Otherwise the first column in field
    order whose invalid share exceeds the tolerance rejects it. A share equal
    to the tolerance is accepted.
    """
    tolerance = tolerance_ratio(F.lit(rule.file_tolerance), F.col("total_rows"))
    judged = counts.withColumn("tolerance", tolerance)
    deciding = [
        F.when(
            _ratio(col(bad_count_name(r))) > F.col("tolerance"),
            F.struct(F.lit(r.name).alias("name"), _ratio(col(bad_count_name(r))).alias("ratio")),
        )
        for r in table.checked
        if r.can_reject_file
    ]
    nothing = F.lit(None).cast("struct<name:string,ratio:double>")
    judged = judged.withColumn("__failing", F.coalesce(*deciding, nothing))
    too_corrupt = _ratio(F.col("corrupt_rows")) > F.col("tolerance")
    flagged = sum_of([(col(bad_count_name(r)) > 0).cast("int") for r in table.rules if r.flags_lines])
    limit = F.greatest(F.lit(1), F.floor(F.col("flagged_columns") * F.lit(rule.line_tolerance)).cast("int"))
    status = (
        F.when(too_corrupt, FAILED).when(F.col("__failing").isNotNull(), REJECTED).otherwise(SUCCESS)
    )
    judged = judged.withColumns({"status": status, "flagged_columns": flagged})
    judged = judged.withColumn("line_limit", limit)
    succeeded = F.col("status") == SUCCESS
    rejected_lines = F.when(succeeded, F.element_at("lines_over", F.col("line_limit"))).otherwise(0)
    kind = F.when(F.col("status") == FAILED, "RLI").when(F.col("status") == REJECTED, "RLK")
    judged = judged.withColumns(
        {
            "rejected_lines": rejected_lines,
            "failing_column": F.when(F.col("status") == REJECTED, F.col("__failing.name")),
            "failing_ratio": F.when(F.col("status") == REJECTED, F.col("__failing.ratio")).when(
                F.col("status") == FAILED, _ratio(F.col("corrupt_rows"))
            ),
            "tolerance_kind": kind,
            "error_no": F.when(kind.isNotNull(), error_number(kind)),
        }
    )
    accepted = F.col("total_rows") - F.col("corrupt_rows") - F.col("dropped_rows") - F.col("rejected_lines")
    message = tolerance_exceeded(
        F.col("tolerance_kind"), F.col("failing_ratio"), F.col("tolerance"), F.col("failing_column")
    )
    return judged.withColumns(
        {
            "accepted_rows": F.when(succeeded, accepted).otherwise(0),
            "message": F.when(kind.isNotNull(), message),
        }
    ).drop("__failing", "lines_over")


def accepted_rows(table: TypedTable, verdict: DataFrame) -> DataFrame:
    """Typed rows of the accepted files, with flags and raw texts still attached.

    ``verdict`` is a written table of one row per file, so Spark sees its size:
    it is broadcast while small, else joined by a sort-merge join whose skewed
    files adaptive execution splits. Removed and unreadable rows fail the line
    limit too: one condition on the join, which Spark does not move below the
    projection, where every cell would be parsed a second time.
    """
    passed = verdict.filter(F.col("status") == SUCCESS).select(FILE, "line_limit")
    return table.frame.join(passed, FILE).filter(col(FLAGS) <= F.col("line_limit")).drop("line_limit")


def latest_files(verdict: DataFrame) -> DataFrame:
    """Verdicts of the accepted files with the most recent date.

    The newest date is one row, so joining it back is a broadcast of one row.
    """
    date = F.coalesce("load_date", F.lit("0001-01-01").cast("date"))
    loaded = verdict.filter((F.col("status") == SUCCESS) & (F.col("accepted_rows") > 0)).withColumn("__date", date)
    newest = loaded.agg(F.max("__date").alias("__newest"))
    return loaded.join(F.broadcast(newest), F.col("__date") == F.col("__newest"), "left_semi").drop("__date")


def rows_of_rejected_files(raw: DataFrame, verdict: DataFrame) -> DataFrame:
    """Raw rows of files that were not accepted."""
    refused = verdict.filter(F.col("status") != SUCCESS).select(FILE)
    return raw.join(refused, FILE, "left_semi")
