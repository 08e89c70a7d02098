"""Rules that drive an ingestion run, one object per table and per column."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T

from millrace.functions.dates import spark_pattern

ACTIONS = ("REJECT", "ICT_DRIVEN", "LOG_ONLY")

# Spark type of each declared type name. Dates become timestamps.
TYPE_NAMES = {
    "STRING": "string",
    "INTEGER": "int",
    "LONG": "bigint",
    "FLOAT": "float",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
    "DATE": "timestamp",
    "TIMESTAMP": "timestamp",
}


def spark_type(declared: str) -> str:
    """SQL type for a declared name; any other valid SQL type stands for itself."""
    name = declared.strip().upper()
    if name in TYPE_NAMES:
        return TYPE_NAMES[name]
    try:
        return T.DataType.fromDDL(name).simpleString()
    except Exception as failure:
        raise ValueError(f"unknown field type: {declared}") from failure


@dataclass(frozen=True)
class ColumnRule:
    name: str
    order: int = 0
    declared: str = "STRING"
    transform: str | None = None
    pattern: str | None = None
    replacement: str | None = None
    nullable: bool = False
    action: str = "ICT_DRIVEN"
    merge_key: bool = False
    default: str | None = None

    @property
    def type(self) -> str:
        return spark_type(self.declared)

    @property
    def is_date(self) -> bool:
        return self.declared.strip().upper() in ("DATE", "TIMESTAMP")

    @property
    def is_text(self) -> bool:
        return not self.is_date and self.type == "string"

    @property
    def date_pattern(self) -> str:
        return spark_pattern(self.pattern)

    @property
    def drops_rows(self) -> bool:
        """A bad date under REJECT removes its row; other types only log."""
        return self.is_date and self.action == "REJECT"

    @property
    def can_reject_file(self) -> bool:
        if self.nullable or self.is_text:
            return False
        return self.action == "ICT_DRIVEN" or (self.is_date and self.action == "REJECT")

    @property
    def flags_lines(self) -> bool:
        return not self.nullable and not self.is_text and self.action == "ICT_DRIVEN"

    @property
    def reported(self) -> bool:
        """Bad cells appear in the error table; nullable non-date columns stay silent."""
        return not self.is_text and (self.is_date or not self.nullable)

    @property
    def reported_by_cell(self) -> bool:
        return self.reported and (self.is_date or self.action == "REJECT")

    def problem(self) -> str | None:
        """What is wrong with the rule itself, if anything."""
        if self.action not in ACTIONS:
            return f"unknown error action: {self.action}"
        try:
            spark_type(self.declared)
        except ValueError as failure:
            return str(failure)
        return None


@dataclass(frozen=True)
class TableRule:
    name: str
    input_format: str = "csv"
    zone: str = "internal"
    mode: str = ""
    last_table: str | None = None
    trim: bool = True
    file_tolerance: str = "10%"
    line_tolerance: float = 0.10
    # Limits beyond the tolerance, each off unless given: shares of a file in percent, ...
    stop_percent: float | None = None
    rejected_percent: float | None = None
    invalid_percent: float | None = None
    # ... repeated merge keys, as a tolerance text, and error numbers that no accepted file may have.
    duplicate_tolerance: str | None = None
    critical_errors: tuple[str, ...] = ()

    @property
    def last_table_name(self) -> str:
        return self.last_table or f"{self.name}_last"

    @property
    def all_table_name(self) -> str:
        return f"{self.name}_all"

    @property
    def raw_table_name(self) -> str:
        return f"{self.name}_raw"


@dataclass(frozen=True)
class RuleBook:
    tables: tuple[TableRule, ...]
    columns: Mapping[str, tuple[ColumnRule, ...]] = field(default_factory=dict)

    def columns_of(self, table: str) -> tuple[ColumnRule, ...]:
        return tuple(sorted(self.columns.get(table, ()), key=lambda rule: rule.order))

    def merge_keys(self, table: str) -> list[str]:
        return [rule.name for rule in self.columns_of(table) if rule.merge_key]
