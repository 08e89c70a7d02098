"""Verdicts on files that arrive in parts: one counter state per file, closed by a completion mark or a timeout."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.names import FILE, col
from millrace.operators.typing import type_columns
from millrace.operators.verdict import counter_columns, file_verdict
from millrace.rules import ColumnRule, TableRule
from millrace.streaming.loader import file_stream

#: Between the name of a file and the name of a part: ``orders_20250101_000000~0007.csv``.
PART_SIGN = "~"
COMPLETE, TIMED_OUT, LATE = "COMPLETE", "TIMEOUT", "LATE"
POLL_SECONDS = 0.2
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
COUNTED = f"{FILE} string, counts array<bigint>, load_day int, expected bigint"
CLOSED = f"{FILE} string, counts array<bigint>, load_day int, reason string"


def _count_in_tasks(names: Sequence[str]):
    """Sums per file within a task, so that a file's rows never meet in one task: only its counters do."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list] = {}
        for batch in batches:
            table = pa.Table.from_batches([batch]).group_by(FILE).aggregate([*((n, "sum") for n in names), ("load_day", "max")])
            for row in table.to_pylist():
                mine = known.setdefault(row[FILE], [[0] * len(names), None])
                mine[0] = [a + (row[f"{n}_sum"] or 0) for a, n in zip(mine[0], names)]
                day = row["load_day_max"]
                mine[1] = day if mine[1] is None else mine[1] if day is None else max(day, mine[1])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(known), pa.string()), pa.array([c for c, _ in known.values()], pa.list_(pa.int64())),
                pa.array([d for _, d in known.values()], pa.int32()), pa.nulls(len(known), pa.int64()),
            ],
            [FILE, "counts", "load_day", "expected"],
        )

    return count


class _FileCounter(StatefulProcessor):
    """Adds up the counters of a file's parts until its mark says that all rows are there, or nothing came for too long.

    Parts and marks may come in any order. The state of a file is one line of numbers, whatever its rows.
    """

    def __init__(self, width: int, timeout_ms: int):
        self.width, self.timeout_ms = width, timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("file", "state string")

    def _known(self) -> dict:
        if self.state.exists():
            return json.loads(self.state.get()[0])
        return {"counts": [0] * self.width, "day": None, "expected": None, "closed": False}

    def _row(self, key, counts: list[int], day: int | None, reason: str) -> pd.DataFrame:
        return pd.DataFrame({FILE: [key[0]], "counts": [counts], "load_day": pd.array([day], "Int32"), "reason": [reason]})

    def _stop_timers(self) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known = self._known()
        counts, day = [0] * self.width, None
        for frame in rows:
            for part, at, expected in zip(frame["counts"], frame["load_day"], frame["expected"]):
                if pd.notna(expected):
                    known["expected"] = max(int(expected), known["expected"] or 0)
                if part is not None and len(part):
                    counts = [a + int(b) for a, b in zip(counts, part)]
                if pd.notna(at):
                    day = int(at) if day is None else max(day, int(at))
        if known["closed"]:
            if counts[0]:
                yield self._row(key, counts, day, LATE)
            return
        known["counts"] = [a + b for a, b in zip(known["counts"], counts)]
        days = [d for d in (known["day"], day) if d is not None]
        known["day"] = max(days) if days else None
        self._stop_timers()
        if known["expected"] is not None and known["counts"][0] >= known["expected"]:
            yield self._row(key, known["counts"], known["day"], COMPLETE)
            known["closed"], known["counts"] = True, []
        else:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.timeout_ms)
        self.state.update((json.dumps(known),))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        known = self._known()
        if not known["closed"]:
            yield self._row(key, known["counts"], known["day"], TIMED_OUT)
            known["closed"], known["counts"] = True, []
            self.state.update((json.dumps(known),))

    def close(self) -> None:
        pass


def verdicts_of_parts(parts: DataFrame, marks: DataFrame, rule: TableRule, rules: Sequence[ColumnRule], timeout_ms: int) -> DataFrame:
    """A stream of file verdicts from a stream of raw rows and one of completion marks.

    ``parts``: raw rows with the name of the whole file; ``marks``: the name and
    ``expected``, the number of rows. A file gets one verdict, ``reason`` COMPLETE when all expected
    rows have come, or TIMEOUT when neither part nor mark came for ``timeout_ms``. Rows that come
    after it are counted in a row with reason LATE and do not change the verdict.
    """
    typed = type_columns(parts, rules, trim=rule.trim)
    columns, days = counter_columns(typed, rule)
    names = [f"c{k}" for k in range(len(columns))]
    flat = typed.frame.select(FILE, *(c.cast("bigint").alias(n) for c, n in zip(columns.values(), names)), F.datediff(days, F.lit("1970-01-01")).alias("load_day"))
    counted = flat.mapInArrow(_count_in_tasks(names), COUNTED)
    none = (F.array().cast("array<bigint>").alias("counts"), F.lit(None).cast("int").alias("load_day"))
    both = counted.unionByName(marks.select(FILE, *none, F.col("expected").cast("bigint").alias("expected")))
    closed = both.groupBy(FILE).transformWithStateInPandas(
        statefulProcessor=_FileCounter(len(names), timeout_ms), outputStructType=CLOSED, outputMode="append", timeMode="ProcessingTime"
    )
    at = {name: F.col("counts")[k] for k, name in enumerate(columns)}
    over = [c for name, c in at.items() if name.startswith("over_")]
    counts = closed.select(
        FILE, "reason", *(c.alias(name) for name, c in at.items() if not name.startswith("over_")), F.array(*over).alias("lines_over"),
        F.date_add(F.lit("1970-01-01").cast("date"), F.col("load_day")).alias("load_date"),
    )
    return file_verdict(counts, typed, rule)


def part_stream(spark: SparkSession, path: str, columns: Sequence[str], **options) -> DataFrame:
    """Part files as a stream of raw rows under the name of the whole file."""
    return file_stream(spark, path, "csv", columns, **options).withColumn(FILE, F.split_part(col(FILE), F.lit(PART_SIGN), F.lit(1)))


def mark_stream(spark: SparkSession, path: str, **options) -> DataFrame:
    """Marks as a stream: CSV files with the name of a file and its number of rows."""
    marks = file_stream(spark, path, "csv", ["file", "expected"], **options)
    return marks.select(F.col("file").alias(FILE), F.col("expected").try_cast("bigint").alias("expected"))


def _new_offsets(progress) -> bool:
    return any(source.startOffset != source.endOffset for source in progress.sources)


def judge_parts(verdicts: DataFrame, target: str, checkpoint: str) -> int:
    """Append the verdicts that are due to the Parquet table at ``target``; returns the batches that had new files.

    A stream with timers has a batch at every trigger, for time goes on without new files. So the run ends with the
    second batch in turn that finds none; the first one may be that in which an earlier run was stopped.
    States stay in the checkpoint.
    """
    spark = verdicts.sparkSession
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    query = None
    try:
        writer = verdicts.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", target)
        query = writer.outputMode("append").trigger(processingTime="1 second").start()
        seen: dict[int, bool] = {}
        while query.isActive and (len(seen) < 2 or any(list(seen.values())[-2:])):
            query.awaitTermination(POLL_SECONDS)
            seen |= {p.batchId: _new_offsets(p) for p in query.recentProgress}
        if query.exception() is not None:
            raise query.exception()
        return sum(seen.values())
    finally:
        if query is not None:
            query.stop()
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)
