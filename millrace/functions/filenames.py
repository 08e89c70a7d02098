"""File-name and file-date expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The three date forms looked for in a file name, in order.
DATE_ONLY = r"[_-]?(\d{8})[_-]?"
DATE_AND_TIME_JOINED = r"[_-]?(\d{8})\d{6}[_-]?"
DATE_AND_TIME_SPLIT = r"[_-]?(\d{8})[_-]\d{6}"

SUPPORTED_EXTENSIONS = (".csv", ".parquet", ".json")
ARRIVAL_EXTENSIONS = ("csv", "zip", "parquet", "json")


def received_name(path: Column, extensions: Iterable[str] = ("csv",)) -> Column:
    """Base name without its extension; empty for any other extension."""
    endings = "|".join(re.escape(e.lstrip(".")) for e in extensions)
    return F.regexp_extract(path, rf"([^/]+)\.(?:{endings})$", 1)


def date_candidates(name: Column) -> tuple[Column, Column, Column]:
    return tuple(
        F.regexp_extract(name, pattern, 1)
        for pattern in (DATE_ONLY, DATE_AND_TIME_JOINED, DATE_AND_TIME_SPLIT)
    )


def date_text(name: Column) -> Column:
    """First non-empty date candidate, or an empty string."""
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in date_candidates(name)), F.lit(""))


def extraction_date(name: Column) -> Column:
    """Date in the file name; NULL when there is none or it is impossible.

    The first candidate decides alone: it is found wherever another one is.
    """
    return F.try_to_date(F.nullif(date_candidates(name)[0], F.lit("")), "yyyyMMdd")


def partition_date(name: Column, run_date: Column) -> Column:
    return F.coalesce(extraction_date(name), run_date)


def partition_columns(date: Column) -> dict[str, Column]:
    return {"yyyy": F.year(date), "mm": F.month(date), "dd": F.dayofmonth(date)}


def arrival_pattern(datasets: Iterable[str], extensions: Iterable[str] = ARRIVAL_EXTENSIONS) -> str:
    """``<dataset>_<8 digits>_<6 digits>.<extension>`` for the given datasets."""
    names = "|".join(re.escape(d) for d in datasets)
    endings = "|".join(re.escape(e) for e in extensions)
    return rf"^({names})_(\d{{8}})_(\d{{6}})\.({endings})$"


def is_valid_arrival(name: Column, datasets: Iterable[str]) -> Column:
    return name.rlike(arrival_pattern(datasets))


def arrival_timestamp(name: Column) -> Column:
    """Date and time of ``prefix_yyyyMMdd_HHmmss.ext``; NULL when absent."""
    pattern = r"^[^_]+_(\d{8})_(\d{6})\."
    digits = F.concat(F.regexp_extract(name, pattern, 1), F.regexp_extract(name, pattern, 2))
    return F.try_to_timestamp(F.nullif(digits, F.lit("")), F.lit("yyyyMMddHHmmss"))


def extension(name: Column) -> Column:
    return F.lower(F.regexp_extract(name, r"(\.[^.]+)$", 1))


def is_supported(name: Column, supported: Iterable[str] = SUPPORTED_EXTENSIONS) -> Column:
    return extension(name).isin(*supported)


def matches_expected_date(name: Column, expected: Column) -> Column:
    """False also when the name holds no readable date."""
    return F.coalesce(extraction_date(name) == expected, F.lit(False))


def within_days(name: Column, expected: Column, days: int) -> Column:
    distance = F.abs(F.datediff(extraction_date(name), expected))
    return F.coalesce(distance <= days, F.lit(False))
