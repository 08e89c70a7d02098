"""Strict date parsing with one pattern and a reason for each failure."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.names import DATE_FORMAT_ERROR, DATE_VALUE_ERROR

# Date patterns in order of preference, and the names rules use for them.
DATE_PATTERNS = ("yyyy-MM-dd", "dd/MM/yyyy", "yyyyMMdd")
PATTERN_NAMES = {
    "YYYY-MM-DD": "yyyy-MM-dd",
    "DD/MM/YYYY": "dd/MM/yyyy",
    "YYYYMMDD": "yyyyMMdd",
}


def spark_pattern(pattern: str | None) -> str:
    """Pattern of a rule in Spark's notation; the first known one when blank."""
    if not pattern:
        return DATE_PATTERNS[0]
    return PATTERN_NAMES.get(pattern, pattern)


def filled(text: Column) -> Column:
    """The text, or NULL when nothing is left after trimming."""
    return F.nullif(F.trim(text), F.lit(""))


def parse_strict(text: Column, pattern: str) -> Column:
    """Timestamp under exactly this pattern; NULL for blanks and mismatches."""
    return F.try_to_timestamp(filled(text), F.lit(pattern))


def shape_of(pattern: str) -> str:
    """Regular expression for texts that look like the pattern."""
    shape = ""
    for run in re.finditer(r"'([^']*)'|([A-Za-z])\2*|[^A-Za-z']+", pattern):
        text = run.group(0)
        if run.group(1) is not None:
            shape += re.escape(run.group(1))
        elif not text[0].isalpha():
            shape += re.escape(text)
        elif text[0] in "ML" and len(text) > 2 or text[0] in "EaG":
            shape += r"\p{L}+"
        elif len(text) == 1:
            shape += r"\d{1,2}"
        else:
            shape += rf"\d{{{len(text)}}}"
    return f"^{shape}$"


def failure_number(text: Column, pattern: str) -> Column:
    """Error number of a text that did not parse: wrong shape or impossible date."""
    return F.when(F.trim(text).rlike(shape_of(pattern)), DATE_VALUE_ERROR).otherwise(DATE_FORMAT_ERROR)
