"""Files known by their content: what is sent again under another name is taken once within a window, late files not at all, and all are logged."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from datetime import datetime, timedelta

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from millrace.functions import filenames
from millrace.names import FILE, PARTITIONS
from millrace.session import materialize
from millrace.sources.files import run_columns, with_file_metadata
from millrace.sources.split_csv import RANGE_BYTES, read_csv_split
from millrace.sources.storage import open_file
from millrace.streaming.loader import process_new_files
from millrace.streaming.partial_files import PROVIDER, ROCKS

NEW, REPEATED, LATE = "NEW", "REPEATED", "LATE"
CHUNK = 1 << 20
#: Files of one batch: so many paths at most meet in one state, if all have the same content.
FILES_PER_BATCH = 10_000
DIGESTED = "path string, length bigint, modified bigint, late boolean, digest string"
JUDGED = "path string, length bigint, modified bigint, digest string, arrived bigint, status string, first_path string"
EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of whole files, read in chunks."""
    for batch in batches:
        found = []
        for path in batch.column("path").to_pylist():
            digest = hashlib.sha256()
            with open_file(path) as file:
                while data := file.read(CHUNK):
                    digest.update(data)
            found.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], [*batch.schema.names, "digest"])


def digested_files(
    spark: SparkSession, path: str, glob: str = "*.csv", files_per_batch: int = FILES_PER_BATCH, run_ts: datetime | None = None, days: int | None = None
) -> DataFrame:
    """New files of a folder as a stream of paths and content digests; the stream carries no content.

    With ``days`` a file is late if the date in its name is further than that from the run's, or if it has none.
    """
    reader = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary")
    files = reader.option("pathGlobFilter", glob).option("maxFilesPerTrigger", files_per_batch).load(path)
    late = F.lit(False)
    if days is not None:
        named = filenames.extraction_date(F.element_at(F.split("path", "/"), -1))
        late = F.coalesce(F.abs(F.datediff(run_columns(run_ts)[1], named)) > days, F.lit(True))
    return files.select("path", "length", F.unix_millis("modificationTime").alias("modified"), late.alias("late")).mapInArrow(_digests, DIGESTED)


def _first_of_content(window_ms: int):
    """Of the files of one content the first is new, by time, then path; later ones repeat it until the window after it has passed."""

    def judge(key: tuple[str], frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        now = state.getCurrentProcessingTimeMs()
        first, since = state.get if state.exists else (None, None)
        if since is not None and now - since > window_ms:
            first = since = None
        files = pd.concat(list(frames)).sort_values(["modified", "path"], ignore_index=True)
        statuses, firsts = [], []
        for path, late in zip(files["path"], files["late"]):
            # A late file is not taken, so that it does not stand in the way of the same content in time.
            if late:
                statuses.append(LATE)
                firsts.append(None)
            elif first is None:
                first, since = path, now
                statuses.append(NEW)
                firsts.append(None)
            else:
                statuses.append(REPEATED)
                firsts.append(first)
        if first is not None:
            state.update((first, since))
            state.setTimeoutDuration(max(1, since + window_ms - now))
        yield files[["path", "length", "modified", "digest"]].assign(arrived=now, status=statuses, first_path=pd.Series(firsts, dtype=object))

    return judge


def once_per_content(files: DataFrame, window: timedelta) -> DataFrame:
    """Every file of a stream with ``status``: NEW, REPEATED (``first_path`` has the same content) or LATE.

    The window begins when the first file arrives and is measured by the clock of the batches, so that no file
    is ever behind a watermark and dropped; a batch that is repeated keeps its time. The state is one path a content,
    and goes when its window has passed.
    """
    window_ms = int(window.total_seconds() * 1000)
    judge = _first_of_content(window_ms)
    return files.groupBy("digest").applyInPandasWithState(judge, JUDGED, "first_path string, since bigint", "append", GroupStateTimeout.ProcessingTimeTimeout)


def load_once(
    spark: SparkSession, path: str, target: str, log: str, checkpoint: str, columns: Sequence[str], *, window: timedelta, days: int | None = None,
    run_ts: datetime | None = None, files_per_batch: int = FILES_PER_BATCH, glob: str = "*.csv", delimiter: str = ",", range_bytes: int = RANGE_BYTES,
) -> int:
    """Append the rows of all new CSV files to ``target``, each content once, and every file to the Parquet table ``log``; returns the files seen.

    New files are read in ranges by many tasks. A batch that is repeated overwrites what it had written.
    """
    judged = once_per_content(digested_files(spark, path, glob, files_per_batch, run_ts, days), window)

    def load(batch: DataFrame, number: int) -> None:
        files = materialize(batch, "judged-files")
        names = {FILE: "path", "first_file": "first_path"}
        logged = files.withColumns({c: F.element_at(F.split(p, "/"), -1) for c, p in names.items()})
        logged.withColumn("arrived", F.timestamp_millis("arrived")).write.mode("overwrite").parquet(f"{log}/batch={number}")
        rows = read_csv_split(batch.sparkSession, files.where(F.col("status") == NEW).select("path", "length"), columns, delimiter=delimiter, range_bytes=range_bytes)
        rows = with_file_metadata(rows, F.col("path"), run_ts)
        rows.drop("path").write.mode("overwrite").partitionBy(*PARTITIONS).parquet(f"{target}/batch={number}")

    # The clock alone needs no batch: a state whose time has come goes with the next files.
    settings = {PROVIDER: ROCKS, EMPTY_BATCHES: "false"}
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        return process_new_files(judged, load, checkpoint)
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
