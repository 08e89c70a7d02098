"""Checks on the names of arriving files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import filenames
from millrace.names import DATE_FORMAT_ERROR, REJECTED, SUCCESS


def judge_file_dates(files: DataFrame, name: Column, expected: Column, tolerance_days: int = 0) -> DataFrame:
    """Accept a file whose name holds the expected date, or one close enough when days are allowed."""
    if tolerance_days:
        accepted = filenames.within_days(name, expected, tolerance_days)
    else:
        accepted = filenames.matches_expected_date(name, expected)
    return files.withColumns(
        {
            "status": F.when(accepted, SUCCESS).otherwise(REJECTED),
            "error_no": F.when(~accepted, DATE_FORMAT_ERROR),
        }
    )


def judge_registered_names(files: DataFrame, name: str, registry: DataFrame) -> DataFrame:
    """Check each name against the pattern its fixed part is registered with.

    ``registry``: fixed_part, date_pattern, validation_required; one row per
    kind of file. A kind that is not registered, or needs no validation, passes.
    """
    fixed = F.split_part(F.col(name), F.lit("_"), F.lit(1))
    date_text = F.regexp_extract(F.col(name), r"^[^_]+_([^.]*)", 1)
    joined = files.withColumn("fixed_part", fixed).join(registry, "fixed_part", "left")
    readable = F.try_to_timestamp(F.nullif(date_text, F.lit("")), F.col("date_pattern")).isNotNull()
    refused = F.coalesce(F.col("validation_required"), F.lit(False)) & ~readable
    return joined.select(
        *files.columns,
        "fixed_part",
        F.col("date_pattern").isNotNull().alias("registered"),
        F.when(refused, REJECTED).otherwise(SUCCESS).alias("status"),
        F.when(refused, DATE_FORMAT_ERROR).alias("error_no"),
    )
