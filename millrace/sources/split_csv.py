"""CSV files read in byte ranges, also where quoted fields hold line breaks.

Whether a byte lies inside quotes depends on everything before it. So each range is
scanned once under every state that may hold at its start; the ranges'
state maps are composed along a file; then each range knows its true state and parses
the records that begin in it.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterator, Sequence
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.names import CORRUPT
from millrace.session import materialize
from millrace.sources.files import bind_by_name
from millrace.sources.storage import open_file

RANGE_BYTES = 64 << 20
#: Bytes read at once, and the longest record that is held in memory.
PIECE_BYTES = 4 << 20
RECORD_BYTES = 512 << 20
#: Ranges of one file whose state maps one group composes; a file has at most as many such groups.
RUN = 1000
MOST_TASKS = 100_000
BATCH_ROWS, BATCH_BYTES = 5000, 8 << 20

#: Before a record, before another field, in a plain field, inside quotes, after a quote inside quotes.
RECORD, FIELD, PLAIN, QUOTED, QUOTE = range(5)
STATES = (RECORD, FIELD, PLAIN, QUOTED, QUOTE)
BOM = b"\xef\xbb\xbf"

RANGES = "path string, number bigint, start bigint, end bigint"
SCANNED = f"{RANGES}, ends array<int>, firsts array<bigint>"
LINES = "path string, line string, header string, too_long bigint"


class Grammar:
    """RFC 4180 for one delimiter. A quote opens a field only at its beginning; what follows a closing quote is plain."""

    def __init__(self, delimiter: str):
        if len(delimiter.encode()) != 1:
            raise ValueError("files are read in ranges only with a delimiter of one byte")
        d = re.escape(delimiter.encode())
        field = rb'(?:"(?:[^"]++|"")*+"[^%b\n]*+|[^"%b\n][^%b\n]*+|)' % (d, d, d)
        self.fields = re.compile(rb"(?:%b[%b\n])*+" % (field, d))
        self.record = re.compile(rb"(?:%b%b)*+%b\n" % (field, d, field))
        self.quoted = re.compile(rb'"(?:[^"]++|"")*+("?)')
        #: What a range would have to begin with to put a fresh reader into each state.
        self.before = {RECORD: b"", FIELD: delimiter.encode(), PLAIN: b"x", QUOTED: b'"', QUOTE: b'""'}

    def advance(self, state: int, data: bytes) -> int:
        """The state after ``data``."""
        if not data:
            return state
        data = self.before[state] + data
        done = self.fields.match(data).end()
        if done == len(data):
            return RECORD if data[-1:] == b"\n" else FIELD
        if data[done : done + 1] != b'"':
            return PLAIN
        tail = self.quoted.match(data, done)
        if not tail.group(1):
            return QUOTED
        return QUOTE if tail.end() == len(data) else PLAIN

    def first_end(self, state: int, data: bytes) -> int | None:
        """Where the record that is open in ``state`` ends in ``data``, behind its line break."""
        prefix = self.before[state]
        found = self.record.match(prefix + data)
        return found.end() - len(prefix) if found else None


@cache
def grammar(delimiter: str) -> Grammar:
    return Grammar(delimiter)


def csv_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``path``, ``length`` of files; contents are not read."""
    return spark.read.format("binaryFile").load(path).select("path", "length")


def _ranges(files: DataFrame, range_bytes: int) -> DataFrame:
    starts = F.posexplode(F.sequence(F.lit(0), F.col("length") - 1, F.lit(range_bytes).cast("bigint")))
    each = files.where("length > 0").select("path", "length", starts.alias("number", "start"))
    return each.select(
        "path", F.col("number").cast("bigint").alias("number"), "start", F.least(F.col("start") + range_bytes, F.col("length")).alias("end")
    )


def _spread(ranges: DataFrame) -> DataFrame:
    """A task for each range, dealt in turn; adaptive execution would join these few small rows into one task."""
    return ranges.repartition(max(1, min(MOST_TASKS, ranges.count())))


def _scan_range(file, start: int, end: int, rules: Grammar) -> tuple[list[int], list[int | None]]:
    """For each state at ``start``: the state at ``end``, and where the first record of the range begins, if one does."""
    file.seek(start)
    now = {s: s for s in STATES}
    first: dict[int, int | None] = {s: start if s == RECORD else None for s in STATES}
    at = start
    while at < end:
        data = file.read(min(PIECE_BYTES, end - at))
        if not data:
            break
        if at == 0 and data.startswith(BOM):
            first[RECORD] = len(BOM)
            data, at = data[len(BOM) :], len(BOM)
        for state in set(now.values()):
            waiting = [s for s in STATES if now[s] == state and first[s] is None]
            found = rules.first_end(state, data) if waiting else None
            if found is not None and at + found < end:
                first |= dict.fromkeys(waiting, at + found)
        moved = {state: rules.advance(state, data) for state in set(now.values())}
        now = {s: moved[now[s]] for s in STATES}
        at += len(data)
    return [now[s] for s in STATES], [first[s] for s in STATES]


def _scan(delimiter: str):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with open_file(row["path"]) as file:
                    ends, firsts = _scan_range(file, row["start"], row["end"], grammar(delimiter))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["path"]], pa.string()), *(pa.array([row[c]], pa.int64()) for c in ("number", "start", "end")),
                        pa.array([ends], pa.list_(pa.int32())), pa.array([firsts], pa.list_(pa.int64())),
                    ],
                    ["path", "number", "start", "end", "ends", "firsts"],
                )

    return scan


def _states(run: Column, first: Column) -> Column:
    """The state before each part of a run, given the one before all."""
    all_states = F.aggregate(run, F.array(first), lambda known, part: F.concat(known, F.array(part["ends"][F.element_at(known, -1)])))
    return F.slice(all_states, 1, F.size(run))


def located(scanned: DataFrame) -> DataFrame:
    """``path``, ``first``, ``end`` of each range in which a record begins: a prefix scan over the ranges' state maps.

    Maps are composed in runs of 1,000 ranges, then over the runs of a file, so that no group grows with a file.
    """
    runs = materialize(
        scanned.groupBy("path", F.call_function("div", F.col("number"), F.lit(RUN)).alias("run")).agg(
            F.sort_array(F.collect_list(F.struct("number", "ends"))).alias("parts")
        ),
        "csv-runs",
    )
    same = F.array(*(F.lit(s) for s in STATES))
    whole = F.aggregate("parts", same, lambda known, part: F.transform(known, lambda s: part["ends"][s]))
    of_files = runs.select("path", "run", whole.alias("ends")).groupBy("path").agg(F.sort_array(F.collect_list(F.struct("run", "ends"))).alias("parts"))
    before = of_files.select("path", F.posexplode(_states(F.col("parts"), F.lit(RECORD))).alias("run", "state"))
    inside = runs.join(before, ["path", "run"]).select("path", "run", F.posexplode(_states(F.col("parts"), F.col("state"))).alias("at", "state"))
    states = inside.select("path", (F.col("run") * RUN + F.col("at")).alias("number"), "state")
    known = scanned.join(states, ["path", "number"]).select("path", F.col("firsts")[F.col("state")].alias("first"), "end")
    return known.where("first is not null")


def _records(file, first: int, end: int, rules: Grammar) -> Iterator[tuple[bytes | None, int]]:
    """Records that begin in [first, end): bytes without the line break, and their size; None for one too long to be held."""
    file.seek(first)
    held, at = b"", first  # ``at`` is the place of the first byte held
    over = False
    while at < end:
        piece = file.read(max(PIECE_BYTES, len(held)))
        if not piece:
            if held:
                yield held, len(held)
            return
        held += piece
        done = 0
        if b'"' not in held:
            lines = held.split(b"\n")
            for line in lines[:-1]:
                if at + done >= end:
                    return
                yield line, len(line)
                done += len(line) + 1
        else:
            while at + done < end and (found := rules.record.match(held, done)):
                yield held[done : found.end() - 1], found.end() - 1 - done
                done = found.end()
        held, at = held[done:], at + done
        if len(held) > RECORD_BYTES:
            over = True
            break
    if over:
        yield from _skipped(file, held, at, end, rules)


def _skipped(file, held: bytes, at: int, end: int, rules: Grammar) -> Iterator[tuple[bytes | None, int]]:
    """The size of a record that is too long, read on in pieces, and the records behind it."""
    state, size = rules.advance(RECORD, held), len(held)
    while piece := file.read(PIECE_BYTES):
        found = rules.first_end(state, piece)
        if found is not None:
            yield None, size + found - 1
            yield from _records(file, at + size + found, end, rules)
            return
        state, size = rules.advance(state, piece), size + len(piece)
    yield None, size


def _first_record(file, rules: Grammar) -> tuple[str | None, int]:
    """The text of a file's first record and where the next one begins."""
    start = len(BOM) if file.read(len(BOM)) == BOM else 0
    for line, size in _records(file, start, start + 1, rules):
        return (None if line is None else _text(line)), start + size + 1
    return None, start


def _text(line: bytes) -> str:
    return line.removesuffix(b"\r").decode("utf-8", errors="replace")


def _read(delimiter: str, header: bool):
    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        path, line, head, size = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(path, pa.string()), pa.array(line, pa.string()), pa.array(head, pa.string()), pa.array(size, pa.int64())], ["path", "line", "header", "too_long"]
        )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = grammar(delimiter)
        for batch in batches:
            for row in batch.to_pylist():
                with open_file(row["path"]) as file:
                    head, body = _first_record(file, rules) if header else (None, 0)
                    rows, size = [], 0
                    for line, length in _records(file, max(row["first"], body), row["end"], rules):
                        rows.append((row["path"], None if line is None else _text(line), head, length if line is None else None))
                        size += length
                        if len(rows) >= BATCH_ROWS or size >= BATCH_BYTES:
                            yield batch_of(rows)
                            rows, size = [], 0
                    if rows:
                        yield batch_of(rows)

    return read


def _heads(delimiter: str):
    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for path in batch.column("path").to_pylist():
                with open_file(path) as file:
                    found.append(_first_record(file, grammar(delimiter))[0])
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["header"])

    return heads


def split_records(files: DataFrame, *, header: bool = True, delimiter: str = ",", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Records of files (``path``, ``length``) as ``path``, ``line``, ``header``, ``too_long``; each range is a task of its own.

    A record belongs to the range that it begins in, whose task reads on to its end. A record beyond 512 MiB is a row without
    ``line`` that names its size. Files of one range need no scan of states.
    """
    ranges = materialize(_ranges(files, range_bytes), "csv-ranges")
    cut = ranges.join(ranges.where("number > 0").select("path").distinct(), "path", "left_semi")
    whole = ranges.join(ranges.where("number > 0").select("path").distinct(), "path", "left_anti")
    begins = materialize(
        located(materialize(_spread(cut).mapInArrow(_scan(delimiter), SCANNED), "csv-scanned"))
        .unionByName(whole.select("path", F.col("start").alias("first"), "end")),
        "csv-begins",
    )
    return _spread(begins).mapInArrow(_read(delimiter, header), LINES)


def read_csv_split(
    spark: SparkSession, path: str | list[str] | DataFrame, columns: Sequence[str], *, header: bool = True, delimiter: str = ",", range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """Raw text rows of CSV files: ``path``, the columns, the corrupt column. A large file is read by many tasks.

    With a header columns are bound by its names, see :func:`millrace.sources.files.bind_by_name`; else by
    position. Records end with a line feed, a carriage return before it is dropped; blank
    ones are skipped. A quote that is never closed makes the rest of its file one record. ``path`` may
    be a table of ``path`` and ``length``, such as the new files of a stream.
    """
    files = path if isinstance(path, DataFrame) else csv_files(spark, path)
    lines = split_records(files, header=header, delimiter=delimiter, range_bytes=range_bytes)
    message = F.concat(F.lit("record of "), F.col("too_long").cast("string"), F.lit(" bytes"))
    lines = lines.withColumn("line", F.coalesce("line", message)).where(F.trim("line") != "")
    kinds: list[tuple] = []
    if header:
        found = files.mapInArrow(_heads(delimiter), "header string").distinct().collect()  # as many as kinds of files
        kinds = [(r.header, next(csv.reader(io.StringIO(r.header, newline=""), delimiter=delimiter), [])) for r in found if r.header is not None]
        if not kinds:
            kinds = [("", list(columns))]
    return bind_by_name(lines, kinds, columns, delimiter)
