"""New files to a raw table: a file stream with a checkpoint, drained once per run."""

from __future__ import annotations

import threading
from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from millrace.names import PARTITIONS
from millrace.session import materialize
from millrace.sources.files import CSV_OPTIONS, text_schema, with_file_metadata
from millrace.sources.split_csv import RANGE_BYTES, read_csv_split


def file_stream(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    columns: Sequence[str] | None = None,
    *,
    header: bool = True,
    run_ts: datetime | None = None,
    files_per_batch: int | None = None,
    glob: str | None = None,
) -> DataFrame:
    """Files of a folder as a stream of raw rows with file metadata columns.

    Parquet without ``columns`` takes its schema from the files already there.
    A file is always read whole within one batch.
    """
    names = glob or f"*.{fmt}"
    if columns is not None:
        schema = text_schema(columns)
    else:
        schema = spark.read.format(fmt).option("pathGlobFilter", names).load(path).schema
    reader = spark.readStream.format(fmt).schema(schema).option("pathGlobFilter", names)
    if fmt == "csv":
        reader = reader.options(**CSV_OPTIONS, header=header, multiLine=True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return with_file_metadata(reader.load(path), F.col("_metadata.file_path"), run_ts, (fmt,))


def load_new_files(stream: DataFrame, target: str, checkpoint: str) -> int:
    """Append all files not loaded before to the Parquet table at ``target``; returns the rows added."""
    writer = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("path", target)
        .partitionBy(*PARTITIONS)
        .trigger(availableNow=True)
    )
    return finish(writer.start, stream.sparkSession)


def process_new_files(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> int:
    """Hand each batch of new files to ``handle``, for verdicts that need whole files."""
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return finish(writer.start, stream.sparkSession)


def load_large_files(
    spark: SparkSession, path: str, target: str, checkpoint: str, columns: Sequence[str], *, run_ts: datetime | None = None,
    files_per_batch: int | None = None, glob: str = "*.csv", delimiter: str = ",", range_bytes: int = RANGE_BYTES,
) -> int:
    """Append all CSV files not loaded before, each read in ranges by many tasks; returns the number of files.

    The stream carries only paths and sizes. A batch that is repeated overwrites what it had written.
    """
    reader = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary")
    reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def load(batch: DataFrame, number: int) -> None:
        files = materialize(batch.select("path", "length"), "new-files")
        rows = with_file_metadata(read_csv_split(batch.sparkSession, files, columns, delimiter=delimiter, range_bytes=range_bytes), F.col("path"), run_ts)
        rows.drop("path").write.mode("overwrite").partitionBy(*PARTITIONS).parquet(f"{target}/batch={number}")

    return process_new_files(reader.load(path).select("path", "length"), load, checkpoint)


class _Rows(StreamingQueryListener):
    """Input rows of every batch of the queries started while it listens. Events arrive in order, the end last."""

    def __init__(self) -> None:
        self.rows: dict[str, int] = {}
        self.ended: dict[str, threading.Event] = {}

    def end_of(self, run: str) -> threading.Event:
        return self.ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        run = str(event.progress.runId)
        self.rows[run] = self.rows.get(run, 0) + event.progress.numInputRows

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.end_of(str(event.runId)).set()


def finish(start: Callable[[], StreamingQuery], spark: SparkSession) -> int:
    """Run a query to its end and return its input rows, summed over all batches however many."""
    listener = _Rows()
    spark.streams.addListener(listener)
    try:
        query = start()
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
        run = str(query.runId)
        listener.end_of(run).wait()
        return listener.rows.get(run, 0)
    finally:
        spark.streams.removeListener(listener)
