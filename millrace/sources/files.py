"""Landing files as raw tables: CSV, JSON, Parquet and flat files."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import filenames
from millrace.names import CORRUPT, FAILED, FILE, FILE_DATE, PROCESSED_AT
from millrace.sources.storage import open_file

#: A header is expected within so many bytes.
HEADER_BYTES = 1 << 20

# Quoting of RFC 4180: a quote inside a quoted field is written twice.
CSV_OPTIONS = {
    "quote": '"',
    "escape": '"',
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
    # A line is judged by all its fields even when a query needs only some.
    "columnPruning": "false",
}


def text_schema(columns: Sequence[str], corrupt: bool = True) -> T.StructType:
    names = [*columns, CORRUPT] if corrupt else list(columns)
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def run_columns(run_ts: datetime | None) -> tuple[Column, Column]:
    """Timestamp and date of the run; the current ones when not given."""
    ts = F.lit(run_ts).cast("timestamp") if run_ts else F.current_timestamp()
    return ts, ts.cast("date")


def with_file_metadata(
    df: DataFrame, path: Column, run_ts: datetime | None = None, extensions: Sequence[str] = ("csv",)
) -> DataFrame:
    """File name, file date, partition and processing columns from a path column."""
    processed, today = run_columns(run_ts)
    named = df.withColumn(FILE, filenames.received_name(path, extensions))
    dated = named.withColumn(FILE_DATE, filenames.extraction_date(F.col(FILE)))
    date = F.coalesce(F.col(FILE_DATE), today)
    return dated.withColumns({**filenames.partition_columns(date), PROCESSED_AT: processed})


def read_csv(
    spark: SparkSession, path: str | list[str], columns: Sequence[str], *, header: bool = True, delimiter: str = ",", multi_line: bool = True
) -> DataFrame:
    """All-text rows bound by position; a record with the wrong number of fields keeps its text in the corrupt column.

    A quoted field may hold line breaks, so one task reads a file; ``multi_line``
    off splits large files that are known to have none.
    """
    raw = (
        spark.read.schema(text_schema(columns))
        .options(**CSV_OPTIONS, header=header, sep=delimiter, enforceSchema=True, multiLine=multi_line)
        .csv(path)
    )
    # Spark refuses a query that needs nothing but the corrupt column. Tying it to a
    # data column, by a comparison that never holds, keeps such queries possible.
    other = F.concat(F.lit("\0"), F.col(f"`{columns[0]}`"))
    return raw.withColumn(CORRUPT, F.when(F.coalesce(F.col(CORRUPT) != other, F.lit(True)), F.col(CORRUPT)))


def _first_records(delimiter: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, headers = batch.column("path").to_pylist(), []
            for path in paths:
                with open_file(path) as file:
                    text = file.read(HEADER_BYTES).decode("utf-8-sig", errors="replace")
                headers.append(next(csv.reader(io.StringIO(text, newline=""), delimiter=delimiter), []))
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(headers, pa.list_(pa.string()))], ["path", "header"])

    return read


def file_headers(spark: SparkSession, path: str, delimiter: str = ",") -> DataFrame:
    """``path`` and ``header`` (column names) of each CSV file; tasks read the first record alone."""
    files = spark.read.format("binaryFile").load(path).select("path")
    return files.mapInArrow(_first_records(delimiter), "path string, header array<string>")


def _places(header: Sequence[str], columns: Sequence[str]) -> dict[str, int]:
    """Where each wanted column stands; names match without regard to case and outer blanks, the first of equal ones."""
    names: dict[str, int] = {}
    for place, name in enumerate(header):
        names.setdefault(name.strip().lower(), place)
    return {c: names[c.lower()] for c in columns if c.lower() in names}


def _by_place(fields: Column, header: Sequence[str], columns: Sequence[str]) -> list[Column]:
    places = _places(header, columns)
    return [(fields[f"_{places[c]}"] if c in places else F.lit(None).cast("string")).alias(c) for c in columns]


def bind_by_name(lines: DataFrame, headers: Sequence[tuple], columns: Sequence[str], delimiter: str = ",") -> DataFrame:
    """Rows of ``path``, ``line`` (and ``header``) parsed by the header they came with: ``path``, the columns, the corrupt column.

    ``headers``: the header line (None for all rows) and its names. There are as many as kinds of files, and all
    kinds are parsed in one pass.
    """
    options = {**{k: v for k, v in CSV_OPTIONS.items() if k != "columnPruning"}, "sep": delimiter, "multiLine": "true"}
    kinds = list(headers) or [(None, list(columns))]
    parsed = []
    for k, (line, names) in enumerate(kinds):
        schema = ", ".join([*(f"`_{n}` string" for n in range(len(names))), f"`{CORRUPT}` string"])
        fields = F.from_csv(F.col("line"), schema, options)
        parsed.append((fields if line is None else F.when(F.col("header") == line, fields)).alias(f"f{k}"))
    bound = [_by_place(F.col(f"f{k}"), names, columns) for k, (_, names) in enumerate(kinds)]
    values = [F.coalesce(*each).alias(c) for c, each in zip(columns, zip(*bound))]
    corrupt = F.coalesce(*(F.col(f"f{k}")[CORRUPT] for k in range(len(kinds)))).alias(CORRUPT)
    return lines.select("path", *parsed).select("path", *values, corrupt)


def read_csv_by_name(spark: SparkSession, path: str, columns: Sequence[str], *, delimiter: str = ",") -> DataFrame:
    """Raw rows of CSV files with headers, bound by column name: ``path``, the columns, the corrupt column.

    Large files are read in ranges. A column that a file lacks is NULL in its rows,
    see :func:`missing_by_file`; one that nobody asked for is dropped.
    """
    from millrace.sources.split_csv import read_csv_split

    return read_csv_split(spark, path, columns, delimiter=delimiter)


def missing_by_file(headers: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``path`` and ``column_name`` of each column that a file's header lacks."""
    names = F.transform("header", lambda h: F.lower(F.trim(h)))
    wanted = F.explode(F.array(*(F.lit(c) for c in columns)).cast("array<string>")).alias("column_name")
    return headers.select("path", names.alias("names"), wanted).filter(~F.array_contains("names", F.lower("column_name"))).select("path", "column_name")


def read_json(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    return (
        spark.read.schema(text_schema(columns))
        .options(mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
        .json(path)
    )


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Columns as stored; the schema comes from the files."""
    return spark.read.parquet(path)


def as_text(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Raw form of a typed source: every column a text."""
    return df.select(*(F.col(c).cast("string").alias(c) for c in columns or df.columns))


def flat_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)


def flat_inventory(files: DataFrame) -> DataFrame:
    """Files and bytes per extension; needs no file content."""
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return files.groupBy(filenames.extension(name).alias("extension")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    )


@dataclass(frozen=True)
class RawScan:
    """A raw table, or why there is none: ABSENT, EMPTY or FAILED."""

    status: str
    frame: DataFrame | None = None
    message: str | None = None


def scan_raw(spark: SparkSession, table: str) -> RawScan:
    """Open a raw table of the catalog; reads at most one row to see if it is empty."""
    try:
        if not spark.catalog.tableExists(table):
            return RawScan("ABSENT")
        frame = spark.table(table)
        return RawScan("EMPTY", frame) if frame.isEmpty() else RawScan("READY", frame)
    except Exception as failure:
        return RawScan(FAILED, message=f"RAW table read error: {failure}")


def source_files(raw: DataFrame) -> DataFrame:
    """Rows per source file, for all files at once."""
    from millrace.operators.typing import with_file_name

    return with_file_name(raw).groupBy(FILE).agg(F.count(F.lit(1)).alias("total_rows"))


def table_of_file(name: Column) -> Column:
    """Table a file belongs to: the part of its name before the first underscore."""
    return F.split_part(name, F.lit("_"), F.lit(1))


def hadoop_path(spark: SparkSession, path: str):
    handle = spark._jvm.org.apache.hadoop.fs.Path(path)
    return handle.getFileSystem(spark._jsc.hadoopConfiguration()), handle
