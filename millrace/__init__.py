"""Rule-driven file ingestion, data quality and baseline comparison on Spark."""

from millrace.rules import ColumnRule, RuleBook, TableRule

__all__ = ["ColumnRule", "RuleBook", "TableRule"]
