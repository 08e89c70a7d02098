"""Schemas that grow: new columns, and columns whose type becomes wider."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.names import col

MOST_DIGITS = 38
#: Whole-number types by the decimal digits that hold all their values.
WHOLE_DIGITS = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 20}
TIMES = (T.DateType(), T.TimestampType())
TEXT = T.StringType()
SIMPLE = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.StringType)


def _decimal(kind: T.DataType) -> tuple[int, int] | None:
    """Digits before and after the point that a type needs."""
    if kind in WHOLE_DIGITS:
        return WHOLE_DIGITS[kind], 0
    return (kind.precision - kind.scale, kind.scale) if isinstance(kind, T.DecimalType) else None


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that takes the values of both.

    Whole numbers, decimals, doubles, text; dates, timestamps, text. Decimals
    grow in both parts; beyond 38 digits, and for kinds without a common
    number or time, the result is text. Nested types do not change.
    """
    if a == b:
        return a
    if not (isinstance(a, SIMPLE) and isinstance(b, SIMPLE)):
        raise ValueError(f"a column cannot become {b.simpleString()} after {a.simpleString()}")
    if a in WHOLE_DIGITS and b in WHOLE_DIGITS:
        return max(a, b, key=WHOLE_DIGITS.get)
    if a in TIMES and b in TIMES:
        return T.TimestampType()
    one, other = _decimal(a), _decimal(b)
    if one and other:
        before, after = max(one[0], other[0]), max(one[1], other[1])
        return T.DecimalType(before + after, after) if before + after <= MOST_DIGITS else TEXT
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return T.DoubleType()
    return TEXT


def merged(known: T.StructType | None, new: T.StructType) -> T.StructType:
    """Earlier columns, then new ones, each with a type that takes all values seen."""
    fields = {f.name: f.dataType for f in (known.fields if known else [])}
    for field in new:
        before = fields.get(field.name, field.dataType)
        try:
            fields[field.name] = wider(before, field.dataType)
        except ValueError as problem:
            raise ValueError(f"column {field.name}: {problem}") from None
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def as_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows with all columns of ``schema``; only columns of another type are cast, so that filters still reach the files."""
    kinds = {f.name: f.dataType for f in df.schema}

    def value(field: T.StructField):
        if field.name not in kinds:
            return F.lit(None).cast(field.dataType).alias(field.name)
        return col(field.name) if kinds[field.name] == field.dataType else col(field.name).cast(field.dataType).alias(field.name)

    return df.select(*map(value, schema))
