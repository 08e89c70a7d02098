"""Tolerance texts and threshold checks as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds in percent when the configuration gives none.
FAIL_FAST_PERCENT = 10.0
RLI_PERCENT = 2.5
ICT_PERCENT = 0.15

_NUMBER = r"^\d+(\.\d+)?$"
_PERCENT = r"^(\d+(?:\.\d+)?)\s*%$"


def _percent_value(text: Column) -> Column:
    return F.nullif(F.regexp_extract(F.trim(text), _PERCENT, 1), F.lit("")).cast("double")


def _absolute_value(text: Column) -> Column:
    return F.when(F.trim(text).rlike(_NUMBER), F.trim(text).try_cast("double"))


def tolerance_ratio(text: Column, total: Column) -> Column:
    """``10%`` gives 0.1, ``5`` of 1000 gives 0.005, anything else NULL."""
    absolute = F.when(total > 0, _absolute_value(text) / total.cast("double"))
    return F.coalesce(_percent_value(text) / 100.0, absolute)


def tolerance_lines(text: Column, total: Column) -> Column:
    """Whole lines a percentage allows; NULL when the text is not a percentage."""
    return F.floor(total * _percent_value(text) / 100.0).cast("bigint")


def is_valid_tolerance(text: Column) -> Column:
    return F.coalesce(_percent_value(text), _absolute_value(text)).isNotNull()


def is_tolerance_text(text: str) -> bool:
    """The same check for a text of the configuration."""
    return bool(re.search(_PERCENT, text.strip()) or re.search(_NUMBER, text.strip()))


def threshold_percent(text: Column, default: float) -> Column:
    """Configured percentage; the default when blank or unreadable."""
    digits = F.trim(F.regexp_replace(text, "%", ""))
    return F.coalesce(digits.try_cast("double"), F.lit(float(default)))


def percent_of(part: Column, total: Column) -> Column:
    return part / F.greatest(total, F.lit(1)).cast("double") * 100.0


def stops_ingestion(errors: Column, total: Column, percent: Column | float = FAIL_FAST_PERCENT) -> Column:
    """Fail fast: reached as soon as the error share equals the threshold."""
    return percent_of(errors, total) >= percent


def rejected_lines_ok(rejected: Column, total: Column, percent: Column | float = RLI_PERCENT) -> Column:
    return percent_of(rejected, total) <= percent


def invalid_columns_ok(invalid: Column, total: Column, percent: Column | float = ICT_PERCENT) -> Column:
    return percent_of(invalid, total) <= percent


def within_count(actual: Column, expected: Column, percent: Column | float) -> Column:
    """Row counts agree up to the whole rows the percentage allows."""
    allowed = F.floor(expected * percent / 100.0)
    return F.abs(actual - expected) <= allowed
