"""Columns of a table: presence, completion, text transforms, names, order, types."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.casts import cast_text
from millrace.names import FILE, MISSING_COLUMN_ERROR, SYSTEM_COLUMNS, col
from millrace.rules import ColumnRule


def missing_columns(df: DataFrame, expected: Iterable[str]) -> list[str]:
    present = set(df.columns)
    return [name for name in expected if name not in present]


def presence_errors(files: DataFrame, missing: Sequence[str], table: str) -> DataFrame:
    """One error row per file and missing column; ``files`` has one row per file."""
    names = F.array(*(F.lit(name) for name in missing)).cast("array<string>")
    return files.select(FILE, F.explode(names).alias("column_name")).select(
        F.lit(table).alias("table_name"),
        F.col(FILE).alias("filename"),
        "column_name",
        F.concat(F.lit("Missing column: "), F.col("column_name")).alias("error_message"),
        F.lit(None).cast("string").alias("raw_value"),
        F.lit(MISSING_COLUMN_ERROR).alias("error_no"),
        F.lit(1).alias("error_count"),
    )


def complete_schema(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """All expected columns as text; absent ones NULL. Other columns are kept."""
    wanted = set(expected)
    present = set(df.columns)
    kept = [col(c).cast("string").alias(c) if c in wanted else col(c) for c in df.columns]
    added = [F.lit(None).cast("string").alias(c) for c in expected if c not in present]
    return df.select(*kept, *added)


def trim_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Trim the named data columns; system columns keep their types."""
    wanted = set(names) - set(SYSTEM_COLUMNS)
    return df.select(*(F.trim(col(c)).alias(c) if c in wanted else col(c) for c in df.columns))


def transformed(text: Column, rule: ColumnRule) -> Column:
    """Case or pattern transform of a rule; a blank replacement deletes the match."""
    if rule.transform == "uppercase":
        return F.upper(text)
    if rule.transform == "lowercase":
        return F.lower(text)
    if rule.transform == "regex" and rule.pattern and not rule.is_date:
        return F.regexp_replace(text, rule.pattern, rule.replacement or "")
    return text


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(mapping)


def _cast(name: str, present: str, wanted: str) -> Column:
    value = cast_text(col(name), wanted) if present == "string" else col(name).try_cast(wanted)
    return value.alias(name)


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the named columns; values that do not fit become NULL."""
    present = dict(df.dtypes)
    return df.select(*(_cast(c, present[c], types[c]) if c in types else col(c) for c in df.columns))


def ordered(rules: Iterable[ColumnRule]) -> list[ColumnRule]:
    return sorted(rules, key=lambda rule: rule.order)


def order_columns(df: DataFrame, rules: Iterable[ColumnRule]) -> DataFrame:
    """Rule columns by field order, then whatever else the frame holds."""
    first = [rule.name for rule in ordered(rules) if rule.name in df.columns]
    rest = [c for c in df.columns if c not in set(first)]
    return df.select(*(col(c) for c in first + rest))


def rebuild_typed(df: DataFrame, rules: Iterable[ColumnRule]) -> DataFrame:
    """Rule columns in order with exactly their declared types, then system columns.

    A column that is absent becomes a typed NULL; one that has another type is
    cast, values that do not fit becoming NULL.
    """
    present = dict(df.dtypes)
    columns = []
    for rule in ordered(rules):
        if rule.name not in present:
            columns.append(F.lit(None).cast(rule.type).alias(rule.name))
        elif present[rule.name] == rule.type:
            columns.append(col(rule.name))
        else:
            columns.append(_cast(rule.name, present[rule.name], rule.type))
    return df.select(*columns, *(col(c) for c in SYSTEM_COLUMNS if c in present))


def type_mismatches(df: DataFrame, rules: Iterable[ColumnRule]) -> list[tuple[str, str, str]]:
    """Columns whose type differs from the rule: name, declared type, actual type."""
    actual = dict(df.dtypes)
    return [(r.name, r.type, actual[r.name]) for r in ordered(rules) if r.name in actual and actual[r.name] != r.type]


def with_system_columns(df: DataFrame, file_name: Column, loaded_at: Column) -> DataFrame:
    return df.withColumns({FILE: file_name, "LOAD_DATE": F.to_date(loaded_at), "LOAD_TIMESTAMP": loaded_at})


def mandatory_flags(rule_frame: DataFrame) -> DataFrame:
    """Rule rows marked mandatory or optional."""
    return rule_frame.withColumn("requirement", F.when(F.col("is_nullable"), "optional").otherwise("mandatory"))
