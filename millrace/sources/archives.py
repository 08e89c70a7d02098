"""ZIP archives as rows: members are listed, checked and read by separate tasks.

Tasks open an archive where it lies and stream from it. Neither an archive nor
a member is ever held in memory as a whole, and the members of one large archive
are spread over all tasks.
"""

from __future__ import annotations

import csv
import io
import zipfile
import zlib
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.files import bind_by_name
from millrace.sources.storage import open_file

MEMBER_SCHEMA = "archive string, member string, size bigint, error string"
RECORD_SCHEMA = "archive string, member string, line_no bigint, line string, header string, error string"
MEMBERS = pa.schema([("archive", pa.string()), ("member", pa.string()), ("size", pa.int64()), ("error", pa.string())])
RECORDS = pa.schema([
    ("archive", pa.string()), ("member", pa.string()), ("line_no", pa.int64()), ("line", pa.string()), ("header", pa.string()), ("error", pa.string()),
])
BATCH_LINES = 5000
BATCH_CHARACTERS = 4 << 20
DAMAGE = (zipfile.BadZipFile, zlib.error, OSError, EOFError, NotImplementedError, RuntimeError, ValueError)

CORRUPT_ARCHIVE = "corrupt or invalid archive"
ARCHIVE_NOT_FOUND = "archive not found: file does not exist"


def archives(spark: SparkSession, path: str) -> DataFrame:
    """Paths of the archives in a folder; contents are not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("recursiveFileLookup", True).load(path)
    return found.select(F.col("path").alias("archive"))


def _spread(df: DataFrame, *keys: str) -> DataFrame:
    # An explicit number: adaptive execution would merge these few small rows into one task.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(tasks, *keys)


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _list_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for archive in batch.column("archive").to_pylist():
            try:
                with open_file(archive) as source, zipfile.ZipFile(source) as bundle:
                    rows = [(archive, m.filename, m.file_size, None) for m in bundle.infolist() if not m.is_dir()]
            except FileNotFoundError:
                rows = [(archive, None, None, ARCHIVE_NOT_FOUND)]
            except (zipfile.BadZipFile, OSError, ValueError):
                rows = [(archive, None, None, CORRUPT_ARCHIVE)]
            yield _batch(MEMBERS, rows)


def _still_quoted(line: str, quoted: bool, delimiter: str) -> bool:
    """Whether a quoted field is open after the line. A quote opens one only where a field begins."""
    if '"' not in line:
        return quoted
    begins, last = not quoted, ""
    for c in line:
        if quoted:
            quoted = c != '"'
            begins = False
        elif c == '"' and begins:
            quoted, begins = True, False
        elif c == '"' and not begins and last == '"':
            quoted = True  # a doubled quote inside a quoted field
        else:
            begins = c == delimiter
        last = c
    return quoted


def records_of(lines: Iterable[str], delimiter: str = ",") -> Iterator[str]:
    """Physical lines joined to records: a line break inside a quoted field belongs to the field.

    A record is as long as its quotes say; one that is never closed holds the rest of the lines.
    """
    held: list[str] = []
    quoted = False
    for line in lines:
        text = line.rstrip("\r\n")
        quoted = _still_quoted(text, quoted, delimiter)
        held.append(text)
        if not quoted:
            yield "\n".join(held)
            held = []
    if held:
        yield "\n".join(held)


def _read_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All records of each member, in one reading that also checks it; then a last row with the error, if any."""
    for batch in batches:
        for row in batch.to_pylist():
            archive, member, error, header = row["archive"], row["member"], row["error"], None
            rows, size = [], 0
            if error is None:
                try:
                    with open_file(archive) as source, zipfile.ZipFile(source) as bundle, bundle.open(member) as data:
                        text = io.TextIOWrapper(data, encoding="utf-8-sig", errors="replace")
                        for number, record in enumerate(records_of(text), 1):
                            header = record if number == 1 else header
                            rows.append((archive, member, number, record, header, None))
                            size += len(record) + len(header)
                            if len(rows) >= BATCH_LINES or size >= BATCH_CHARACTERS:
                                yield _batch(RECORDS, rows)
                                rows, size = [], 0
                except DAMAGE:
                    error = CORRUPT_ARCHIVE
            yield _batch(RECORDS, [*rows, (archive, member, 0, None, header, error)])


def expand_archives(paths: DataFrame) -> DataFrame:
    """Records of all members, each member read once; row 0 of a member holds its error or none.

    Write the result before it is used: the rows of a damaged archive are known
    only when all its members have been read.
    """
    listed = _spread(paths.select("archive").distinct(), "archive").mapInArrow(_list_members, MEMBER_SCHEMA)
    return _spread(listed, "archive", "member").mapInArrow(_read_records, RECORD_SCHEMA)


def expanded_errors(expanded: DataFrame) -> DataFrame:
    """One row per damaged or missing archive."""
    return expanded.filter(F.col("error").isNotNull()).groupBy("archive").agg(F.min("error").alias("error"))


def sound_records(expanded: DataFrame) -> DataFrame:
    """Records of archives without any error; a damaged archive gives nothing."""
    return expanded.filter("line_no > 0").join(expanded_errors(expanded).select("archive"), "archive", "left_anti")


def records_as_csv(records: DataFrame, columns: Sequence[str], *, header: bool = True, delimiter: str = ",") -> DataFrame:
    """Raw rows of CSV records: the member as ``path``, text columns bound by header name and the corrupt column."""
    named = records.withColumnRenamed("member", "path").filter(F.trim("line") != "")
    if not header:
        return bind_by_name(named, [(None, list(columns))], columns, delimiter)
    data = named.filter("line_no > 1")
    headers = [r.header for r in records.filter("line_no = 1").select("header").distinct().collect()]
    return bind_by_name(data, [(h, next(csv.reader([h], delimiter=delimiter), [])) for h in headers], columns, delimiter)
