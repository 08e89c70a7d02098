"""Column names and status words shared by every stage."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

FILE = "FILE_NAME_RECEIVED"
FILE_DATE = "FILE_EXTRACTION_DATE"
PROCESSED_AT = "FILE_PROCESS_DATE"
PARTITIONS = ("yyyy", "mm", "dd")
SYSTEM_COLUMNS = (FILE, FILE_DATE, *PARTITIONS, PROCESSED_AT)
CORRUPT = "_corrupt_record"

# Name given to rows that carry no source file name.
BATCH_FILE = "AUTO_LOADER_BATCH"

SUCCESS, FAILED, REJECTED = "SUCCESS", "FAILED", "REJECTED"
FAILED_QUALITY = "FAILED_QUALITY"
PASSED, SKIPPED, REGRESSION = "PASSED", "SKIPPED", "REGRESSION"
MISSING, IDENTICAL, DIFFERENT, EXTRA = "MISSING", "IDENTICAL", "DIFFERENT", "EXTRA"

# Error numbers by failure kind.
DATE_FORMAT_ERROR = "000000004"
DATE_VALUE_ERROR = "000000005"
ERROR_NUMBERS = {
    "RLI": "000000007",
    "RLD": "000000008",
    "RLK": "000000009",
}
DEFAULT_ERROR_NUMBER = "000000007"
FILE_REJECTED_ERROR = "000000008"
MISSING_COLUMN_ERROR = "000000010"

# The columns of error rows and of the execution log that reports search for.
ERROR_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("filename", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("raw_value", T.StringType()),
        T.StructField("error_no", T.StringType()),
        T.StructField("error_count", T.IntegerType()),
    ]
)

EXECUTION_LOG_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("filename", T.StringType()),
        T.StructField("input_format", T.StringType()),
        T.StructField("ingestion_mode", T.StringType()),
        T.StructField("output_zone", T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("column_count", T.IntegerType()),
        T.StructField("masking_applied", T.BooleanType()),
        T.StructField("error_count", T.LongType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("error_no", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("duration", T.DoubleType()),
        T.StructField("env", T.StringType()),
        T.StructField("log_ts", T.TimestampType()),
        T.StructField("yyyy", T.IntegerType()),
        T.StructField("mm", T.IntegerType()),
        T.StructField("dd", T.IntegerType()),
    ]
)


def col(name: str) -> Column:
    """Column by exact name, safe for names with dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def any_of(conditions: list[Column]) -> Column:
    """OR of the conditions; false when there are none."""
    result = F.lit(False)
    for condition in conditions:
        result = result | condition
    return result


def sum_of(terms: list[Column]) -> Column:
    """Sum of the terms; zero when there are none."""
    result = F.lit(0)
    for term in terms:
        result = result + term
    return result
