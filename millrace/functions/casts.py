"""Casting texts: values that do not fit become NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INTEGRAL = ("tinyint", "smallint", "int", "bigint")
_WHOLE_NUMBER = r"^[\x00-\x20\x7F]*[+-]?[0-9]+[\x00-\x20\x7F]*$"


def cast_text(text: Column, sql_type: str) -> Column:
    """``try_cast`` of a text column.

    For whole numbers the shape is checked first: the cast itself raises and
    catches an exception for every text that is no number, which costs about
    ten times as much as the check.
    """
    value = text.try_cast(sql_type)
    return F.when(text.rlike(_WHOLE_NUMBER), value) if sql_type in INTEGRAL else value
