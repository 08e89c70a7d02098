"""All registered queries."""

import importlib

from workload.registry import QUERIES

for _module in ("archive_and_file_queries", "file_name_queries", "column_queries", "check_queries", "tolerance_queries", "error_queries", "report_queries", "sink_queries", "baseline_queries"):
    importlib.import_module(f"workload.{_module}")

__all__ = ["QUERIES"]
