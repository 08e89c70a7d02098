"""One generated projection: clean, cast and flag every column of a raw table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.casts import cast_text
from millrace.functions.dates import parse_strict
from millrace.names import BATCH_FILE, CORRUPT, FILE, col, sum_of
from millrace.operators.shape import complete_schema, ordered, transformed
from millrace.rules import ColumnRule


def raw_name(rule: ColumnRule) -> str:
    return f"__raw_{rule.name}"


def bad_name(rule: ColumnRule) -> str:
    return f"__bad_{rule.name}"


DROPPED = "__dropped"
CORRUPT_LINE = "__corrupt"
FLAGS = "__flags"

# More flags than any line limit allows.
GONE = 1 << 30


@dataclass(frozen=True)
class TypedTable:
    """Rows with typed values, their raw texts and their invalid-cell flags.

    ``frame`` holds the kept columns, one typed column per rule, ``__raw_<c>``
    and ``__bad_<c>`` for each column that can fail, ``__dropped`` for rows a
    bad date removes, ``__corrupt`` for unreadable lines and ``__flags``, the
    number of flagged cells in the row, or ``GONE`` for rows that do not remain.
    """

    frame: DataFrame
    rules: tuple[ColumnRule, ...]
    kept: tuple[str, ...]

    @property
    def checked(self) -> list[ColumnRule]:
        return [rule for rule in self.rules if not rule.is_text]

    def values(self, df: DataFrame | None = None) -> DataFrame:
        """Kept and typed columns only."""
        frame = self.frame if df is None else df
        return frame.select(*(col(rule.name) for rule in self.rules), *(col(c) for c in self.kept))


def parsed(text: Column, rule: ColumnRule) -> Column:
    """Typed value of a cell's text; NULL when it does not fit."""
    if rule.is_date:
        return parse_strict(text, rule.date_pattern)
    return cast_text(text, rule.type)


def is_invalid(value: Column, text: Column) -> Column:
    """A filled text that gave no value. Never NULL."""
    return value.isNull() & F.coalesce(F.trim(text) != "", F.lit(False))


def with_file_name(df: DataFrame) -> DataFrame:
    """Rows without a source file name belong to one batch."""
    name = F.coalesce(col(FILE), F.lit(BATCH_FILE)) if FILE in df.columns else F.lit(BATCH_FILE)
    return df.withColumn(FILE, name)


def type_columns(
    raw: DataFrame,
    rules: Sequence[ColumnRule],
    *,
    trim: bool = True,
    fill_defaults: bool = False,
) -> TypedTable:
    """Type every rule column of ``raw`` in one pass, with no job per column.

    A column after a date under REJECT does not count cells of rows that date
    already removed. ``fill_defaults`` puts a rule's default into invalid cells.
    """
    rules = tuple(ordered(rules))
    names = [rule.name for rule in rules]
    frame = with_file_name(complete_schema(raw, names))
    kept = tuple(c for c in frame.columns if c not in set(names) and c != CORRUPT)
    corrupt_text = col(CORRUPT) if CORRUPT in frame.columns else F.lit(None).cast("string")

    def cell(rule: ColumnRule) -> Column:
        text = F.trim(col(rule.name)) if trim else col(rule.name)
        return transformed(text, rule).alias(raw_name(rule))

    frame = frame.select(*(col(c) for c in kept), corrupt_text.alias(CORRUPT), *(cell(rule) for rule in rules))
    frame = frame.select("*", *(parsed(col(raw_name(r)), r).alias(r.name) for r in rules))

    corrupt = col(CORRUPT).isNotNull()
    gone = corrupt
    flags = []
    for rule in rules:
        if rule.is_text:
            continue
        invalid = is_invalid(col(rule.name), col(raw_name(rule)))
        flags.append((invalid & ~gone).alias(bad_name(rule)))
        if rule.drops_rows:
            gone = gone | invalid
    frame = frame.select("*", *flags, (gone & ~corrupt).alias(DROPPED), corrupt.alias(CORRUPT_LINE))
    flagged = [col(bad_name(rule)).cast("int") for rule in rules if rule.flags_lines]
    frame = frame.withColumn(FLAGS, F.when(F.col(DROPPED) | F.col(CORRUPT_LINE), GONE).otherwise(sum_of(flagged)))

    if fill_defaults:
        filled_in = {
            r.name: F.when(col(bad_name(r)), F.lit(r.default).try_cast(r.type)).otherwise(col(r.name))
            for r in rules
            if not r.is_text and r.default is not None
        }
        frame = frame.withColumns(filled_in) if filled_in else frame
    return TypedTable(frame, rules, kept)
