"""Error rows of a table: one grouped pass over its bad cells feeds all of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import messages
from millrace.functions.dates import failure_number
from millrace.names import CORRUPT, ERROR_NUMBERS, ERROR_SCHEMA, FILE, SUCCESS, col
from millrace.operators.typing import TypedTable, bad_name, raw_name
from millrace.operators.verdict import bad_count_name
from millrace.rules import ColumnRule, TableRule


def normalized(df: DataFrame, table: str | None = None, file: Column | None = None) -> DataFrame:
    """Bring any error frame to the common schema, filling in table and file."""
    defaults = {
        "table_name": F.lit(table),
        "filename": file if file is not None else F.lit(None),
        "error_no": F.lit(None),
        "error_count": F.lit(1),
    }
    columns = []
    for wanted in ERROR_SCHEMA:
        value = defaults.get(wanted.name, F.lit(None))
        if wanted.name in df.columns:
            value = F.coalesce(col(wanted.name).cast(wanted.dataType), value.cast(wanted.dataType))
        columns.append(value.cast(wanted.dataType).alias(wanted.name))
    return df.select(*columns)


def union_errors(frames: list[DataFrame]) -> DataFrame:
    """All error rows of the frames, duplicates kept."""
    wanted = {f.name: f.dataType for f in ERROR_SCHEMA}
    same = [f if {c.name: c.dataType for c in f.schema} == wanted else normalized(f) for f in frames]
    result = same[0]
    for frame in same[1:]:
        result = result.unionByName(frame)
    return result


def melt_bad_cells(table: TypedTable, rules: list[ColumnRule]) -> DataFrame:
    """One row per bad cell or unreadable line: file, column and raw text.

    Filtering rows before melting them would make Spark parse every cell twice,
    once for the filter and once for the result.
    """
    cells = [F.lit(CORRUPT), col(CORRUPT)]
    for rule in rules:
        cells += [F.lit(rule.name), F.when(col(bad_name(rule)), col(raw_name(rule)))]
    return table.frame.select(FILE, F.stack(F.lit(len(cells) // 2), *cells).alias("column_name", "raw_value")).filter(
        F.col("raw_value").isNotNull()
    )


def bad_values(table: TypedTable, files: DataFrame | None = None) -> DataFrame:
    """How often each bad text occurs per file and column, in all or the given files.

    Counting by value first means that everything after this works on distinct
    texts, and that a hot file is spread over its texts.
    """
    cells = melt_bad_cells(table, [rule for rule in table.checked if rule.reported])
    if files is not None:
        cells = cells.join(files.select(FILE), FILE, "left_semi")
    return cells.groupBy(FILE, "column_name", "raw_value").agg(F.count(F.lit(1)).alias("n"))


def _by_column(rules: list[ColumnRule], value) -> Column:
    """``value(rule)`` of the rule that a row's column name stands for."""
    chosen = None
    for rule in rules:
        is_rule = F.col("column_name") == rule.name
        chosen = F.when(is_rule, value(rule)) if chosen is None else chosen.when(is_rule, value(rule))
    return F.lit(None).cast("string") if chosen is None else chosen


def cell_and_column_errors(values: DataFrame, verdict: DataFrame, table: TypedTable, rule: TableRule) -> DataFrame:
    """Error rows of bad cells in accepted files: one per file, column and distinct text, with its exact count.

    ``values`` comes from :func:`bad_values`; it is complete, so the counts of a
    column add up to that of the verdict, whatever their number.
    """
    rules = [r for r in table.checked if r.reported]
    single = [r for r in rules if r.reported_by_cell]
    dates = [r for r in single if r.is_date]
    files = verdict.filter(F.col("status") == SUCCESS).select(
        FILE, "total_rows", *(col(bad_count_name(r)) for r in rules)
    )
    name, raw_value, total = F.col("column_name"), F.col("raw_value"), F.col("total_rows")
    bad = _by_column(rules, lambda r: col(bad_count_name(r)))
    is_line, is_date = name == CORRUPT, name.isin([r.name for r in dates])
    is_single = name.isin([CORRUPT, *(r.name for r in single)])

    rejected = messages.rejected_cell(name, _by_column(single, lambda r: F.lit(r.declared)), bad, total, raw_value)
    summary = messages.invalid_summary(_by_column(rules, lambda r: F.lit(r.action)), bad, total)
    date_text = messages.date_failure(_by_column(dates, lambda r: F.lit(r.date_pattern)), raw_value)
    date_number = _by_column(dates, lambda r: failure_number(raw_value, r.date_pattern))
    return values.join(files, FILE).select(
        F.lit(rule.name).alias("table_name"),
        F.col(FILE).alias("filename"),
        "column_name",
        F.when(is_line, "RFC 4180 non-compliance").when(is_date, date_text).when(is_single, rejected)
        .otherwise(summary).alias("error_message"),
        raw_value.alias("raw_value"),
        F.when(is_line, ERROR_NUMBERS["RLI"]).when(is_date, date_number).otherwise(ERROR_NUMBERS["RLK"]).alias("error_no"),
        F.col("n").cast("int").alias("error_count"),
    )


def file_errors(verdict: DataFrame, rule: TableRule) -> DataFrame:
    """One row per file that stopped at a tolerance."""
    return verdict.filter(F.col("status") != SUCCESS).select(
        F.lit(rule.name).alias("table_name"),
        F.col(FILE).alias("filename"),
        F.coalesce("failing_column", F.lit("N/A")).alias("column_name"),
        F.concat(F.lit("FAIL FAST - "), F.col("message")).alias("error_message"),
        F.lit(None).cast("string").alias("raw_value"),
        "error_no",
        F.floor(F.col("total_rows") * F.col("failing_ratio")).cast("int").alias("error_count"),
    )


def line_errors(verdict: DataFrame, rule: TableRule) -> DataFrame:
    """One row per file that lost lines with too many bad cells."""
    return verdict.filter(F.col("rejected_lines") > 0).select(
        F.lit(rule.name).alias("table_name"),
        F.col(FILE).alias("filename"),
        F.lit("MULTIPLE_COLUMNS").alias("column_name"),
        F.concat(F.lit("Lines with too many errors: "), F.col("rejected_lines").cast("string")).alias("error_message"),
        F.lit(None).cast("string").alias("raw_value"),
        F.lit(ERROR_NUMBERS["RLK"]).alias("error_no"),
        F.col("rejected_lines").cast("int").alias("error_count"),
    )


def table_errors(values: DataFrame, verdict: DataFrame, table: TypedTable, rule: TableRule) -> DataFrame:
    """Every typing, line and file error of a table. A refused file has its single file error only."""
    return union_errors(
        [
            cell_and_column_errors(values, verdict, table, rule),
            file_errors(verdict, rule),
            line_errors(verdict, rule),
        ]
    )
