"""Parquet tables below one folder: appends by run, whole snapshots and bucketed merges."""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.names import PARTITIONS, any_of, col
from millrace.session import materialize
from millrace.sinks.schemas import as_schema, merged
from millrace.sources.files import hadoop_path

SNAPSHOT_FORMAT = "%Y%m%dT%H%M%S"
SCHEMA_FILE = "_schema.json"
BUCKETS_FILE = "_buckets.json"
#: Marks a table in which a column changed its type, so that each run is read with its own schema.
CHANGED_FILE = "_changed"
BUCKET, RUN = "bucket", "run_id"
#: A merged table gets a bucket for so many rows of its first load, between these numbers of buckets.
ROWS_PER_BUCKET = 250_000
FEWEST_BUCKETS, MOST_BUCKETS = 8, 4096


class TableStore:
    """Tables of one run environment.

    A table is appended to, replaced as a whole, or merged by key. What a run
    writes lies in folders named after the run and counts once Spark has
    committed it *and* the run is finished. So a run that failed can be repeated: it
    overwrites its own folders, and readers never see half of it. Writes
    without a run count at once. The merged schema lies beside the rows, so
    that a reader opens no footers to find it. Threads may share a store.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._schemas = threading.RLock()

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def tables(self) -> list[str]:
        """Names of all tables, also of those that nothing is committed in."""
        return [c for c in self._children(self.root) if not c.startswith("_")]

    def _children(self, path: str) -> list[str]:
        fs, handle = hadoop_path(self.spark, path)
        return sorted(s.getPath().getName() for s in fs.listStatus(handle)) if fs.exists(handle) else []

    def _has(self, path: str) -> bool:
        fs, handle = hadoop_path(self.spark, path)
        return fs.exists(handle)

    def _put(self, path: str, text: str) -> None:
        fs, handle = hadoop_path(self.spark, path)
        stream = fs.create(handle, True)
        stream.write(bytearray(text.encode()))
        stream.close()

    def _get(self, path: str) -> str:
        fs, handle = hadoop_path(self.spark, path)
        stream = fs.open(handle)
        text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        return text

    def finish(self, run: str) -> None:
        """From now on what the run wrote counts."""
        self._put(f"{self.root}/_finished/{run}", "")

    def is_finished(self, run: str) -> bool:
        return self._has(f"{self.root}/_finished/{run}")

    def _remember(self, path: str, schema: T.StructType) -> None:
        """Keep the schema of all rows below ``path``: earlier columns, then new ones; a changed type becomes one that takes both."""
        with self._schemas:
            known = self._schema(path)
            grown = merged(known, schema)
            if known and any(grown[f.name].dataType != f.dataType for f in [*known, *schema]):
                self._put(f"{path}/{CHANGED_FILE}", "")
            self._put(f"{path}/{SCHEMA_FILE}", grown.json())

    def _schema(self, path: str) -> T.StructType | None:
        found = f"{path}/{SCHEMA_FILE}"
        with self._schemas:
            return T.StructType.fromJson(json.loads(self._get(found))) if self._has(found) else None

    def _folders(self, name: str) -> list[tuple[int, datetime, str]]:
        """Committed snapshots of finished runs: number, time, folder; oldest first."""
        found = []
        for child in self._children(self.path(name)):
            if not child.startswith("snapshot_id="):
                continue
            for stamp in self._children(f"{self.path(name)}/{child}"):
                folder = f"{self.path(name)}/{child}/{stamp}"
                at, _, run = stamp.split("=", 1)[1].partition(".")
                if self._has(f"{folder}/_SUCCESS") and (not run or self.is_finished(run)):
                    found.append((int(child.split("=", 1)[1]), datetime.strptime(at, SNAPSHOT_FORMAT), folder))
        return sorted(found)

    def snapshots(self, name: str) -> list[tuple[int, datetime]]:
        """Committed snapshots, oldest first."""
        return [(number, at) for number, at, _ in self._folders(name)]

    def _next_snapshot(self, name: str, at: datetime, run: str | None) -> tuple[int, str]:
        number = max((n for n, _ in self.snapshots(name)), default=0) + 1
        stamp = f"{at:{SNAPSHOT_FORMAT}}" + (f".{run}" if run else "")
        return number, f"{self.path(name)}/snapshot_id={number}/snapshot_ts={stamp}"

    def runs(self, name: str) -> list[str]:
        """Appends that count."""
        found = [c.split("=", 1)[1] for c in self._children(self.path(name)) if c.startswith(f"{RUN}=")]
        return [r for r in found if self._has(f"{self.path(name)}/{RUN}={r}/_SUCCESS") and (r.startswith("auto-") or self.is_finished(r))]

    def exists(self, name: str) -> bool:
        """Whether anything committed can be read; folders of interrupted writes do not count."""
        return bool(self._folders(name) or self.runs(name)) or self._has(f"{self.path(name)}/_SUCCESS")

    def read(self, name: str, snapshot: int | None = None) -> DataFrame:
        """The table as it is, or as a given snapshot left it."""
        known = {number: folder for number, _, folder in self._folders(name)}
        if known:
            return self._read_snapshot(name, known[max(known) if snapshot is None else snapshot])
        if runs := self.runs(name):
            return self._read_parts(self.path(name), [f"{self.path(name)}/{RUN}={r}" for r in runs], (RUN,))
        return self.spark.read.parquet(self.path(name))

    def snapshot_at(self, name: str, at: datetime) -> int:
        """The newest snapshot taken at that time or before; of equal times the last one."""
        known = [(taken, number) for number, taken in self.snapshots(name) if taken <= at]
        if not known:
            raise LookupError(f"table {name} has no snapshot of {at:%Y-%m-%d %H:%M:%S} or before")
        return max(known)[1]

    def read_as_of(self, name: str, at: datetime) -> DataFrame:
        """The table as it was at a time."""
        return self.read(name, self.snapshot_at(name, at))

    def changes(self, name: str, keys: Sequence[str], before: int, after: int) -> DataFrame:
        """What changed between two snapshots: ``change`` and the row as it is after, or was before if it is gone.

        ``change`` is inserted, updated or deleted, by key; each snapshot has one row per key. A NULL key equals nothing, so rows
        with one are inserted or deleted as whole rows, as often as they are. Buckets that both snapshots
        of a merged table share are not read. Columns that only one of them has are NULL in the other.
        """
        folders = {number: folder for number, _, folder in self._folders(name)}
        sides = [folders[before], folders[after]]
        parts = [json.loads(self._get(f"{f}/{BUCKETS_FILE}")) if self._has(f"{f}/{BUCKETS_FILE}") else None for f in sides]
        if all(parts) and parts[0]["buckets"] == parts[1]["buckets"]:
            shared = set(parts[0]["parts"].values()) & set(parts[1]["parts"].values())
            frames = [self._read_snapshot(name, f, shared) for f in sides]
        else:
            frames = [self._read_snapshot(name, f) for f in sides]
        schema = merged(frames[0].schema, frames[1].schema)
        old, new = (as_schema(f, schema) for f in frames)
        keyless = any_of([col(k).isNull() for k in keys])
        columns = [c for c in schema.fieldNames()]
        return _keyed_changes(old.filter(~keyless), new.filter(~keyless), keys, columns).unionByName(
            _row_changes(old.filter(keyless), new.filter(keyless), columns)
        )

    def read_run(self, name: str, run: str) -> DataFrame:
        """What one run appended, also before it is finished."""
        return self._read_parts(self.path(name), [f"{self.path(name)}/{RUN}={run}"], (RUN,))

    def _read_parts(self, base: str, parts: Sequence[str], technical: Sequence[str], schema: T.StructType | None = None) -> DataFrame:
        """Rows of some runs' folders. Where types changed each run is read with its own; runs of equal types are one scan."""
        schema = schema or self._schema(base)
        if not self._has(f"{base}/{CHANGED_FILE}"):
            return self.spark.read.schema(schema).option("basePath", base).parquet(*parts).drop(*technical)
        kinds: dict[str, list[str]] = {}
        own: dict[str, str] = {}
        for part in parts:
            run = part[len(base) :].strip("/").split("/")[0]
            if run not in own:
                own[run] = (self._schema(f"{base}/{run}") or schema).json()
            kinds.setdefault(own[run], []).append(part)
        frames = []
        for kind, folders in kinds.items():
            # Columns that came after this run read as NULL.
            written = T.StructType.fromJson(json.loads(kind))
            later = [f for f in schema if f.name not in written.fieldNames()]
            rows = self.spark.read.schema(T.StructType([*written, *later])).option("basePath", base).parquet(*folders)
            frames.append(as_schema(rows.drop(*technical), T.StructType([f for f in schema if f.name not in technical])))
        result = frames[0]
        for frame in frames[1:]:
            result = result.union(frame)
        return result

    def _read_snapshot(self, name: str, folder: str, but: Sequence[str] | set[str] = ()) -> DataFrame:
        """The rows of a snapshot; of a merged table without the bucket folders in ``but``."""
        schema = self._schema(folder)
        if self._has(f"{folder}/{BUCKETS_FILE}"):
            parts = json.loads(self._get(f"{folder}/{BUCKETS_FILE}"))["parts"]
            base = f"{self.path(name)}/_data"
            wanted = [f"{base}/{p}" for p in parts.values() if p not in but]
            if not wanted:
                return self.spark.createDataFrame([], T.StructType([f for f in schema if f.name != BUCKET]))
            return self._read_parts(base, wanted, (RUN, BUCKET), schema)
        return self.spark.read.schema(schema).parquet(folder) if schema else self.spark.read.parquet(folder)

    def append(self, name: str, df: DataFrame, partition_by: Sequence[str] = PARTITIONS, run: str | None = None) -> None:
        """Add rows; new columns and changed types are allowed, see :func:`millrace.sinks.schemas.wider`.

        A run that repeats an append overwrites its own rows.
        """
        folder = f"{self.path(name)}/{RUN}={run or f'auto-{uuid.uuid4().hex}'}"
        self._remember(self.path(name), df.schema)
        _balanced(df, partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(folder)
        self._put(f"{folder}/{SCHEMA_FILE}", merged(None, df.schema).json())

    def overwrite_partitions(self, name: str, df: DataFrame, partition_by: Sequence[str] = PARTITIONS) -> None:
        """Replace only the partitions that ``df`` has rows for."""
        writer = _balanced(df, partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*partition_by).parquet(self.path(name))

    def replace(self, name: str, df: DataFrame, at: datetime, partition_by: Sequence[str] = (), run: str | None = None) -> int:
        """Write ``df`` as the next snapshot, also when ``df`` reads the current one."""
        number, folder = self._next_snapshot(name, at, run)
        writer = _balanced(df, partition_by).write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(folder)
        self._remember(folder, df.schema)
        return number

    def merge(
        self, name: str, batch: DataFrame, keys: Sequence[str], at: datetime, partition_by: Sequence[str] = PARTITIONS, run: str | None = None
    ) -> int:
        """Replace the batch's keys in a table of key-hash buckets; only buckets that the batch touches are rewritten.

        ``batch`` has one row per key. A NULL key equals nothing: such rows are
        added and spread over the buckets. A snapshot lists the folder of each
        bucket, so untouched buckets are shared between snapshots.
        """
        batch = materialize(batch, "batch")
        folders = self._folders(name)
        before = json.loads(self._get(f"{folders[-1][2]}/{BUCKETS_FILE}")) if folders else None
        count = before["buckets"] if before else max(FEWEST_BUCKETS, min(MOST_BUCKETS, batch.count() // ROWS_PER_BUCKET))
        keyless = any_of([col(k).isNull() for k in keys])
        spread = F.when(keyless, F.xxhash64(*(col(c) for c in batch.columns))).otherwise(F.xxhash64(*(col(k) for k in keys)))
        new = batch.withColumn(BUCKET, F.pmod(spread, F.lit(count)).cast("int"))
        touched = [r[0] for r in new.select(BUCKET).distinct().collect()]  # at most MOST_BUCKETS
        base, label = f"{self.path(name)}/_data", run or f"auto-{uuid.uuid4().hex}"
        known = self._schema(folders[-1][2]) if folders else None
        schema = merged(known, new.schema)
        changed = [k for k in keys if known and k in known.fieldNames() and known[k].dataType != new.schema[k].dataType]
        if changed:
            raise ValueError(f"a merge key cannot change its type: {', '.join(changed)}")  # its hash names the bucket
        if known and any(schema[f.name].dataType != f.dataType for f in [*known, *new.schema]):
            self._put(f"{base}/{CHANGED_FILE}", "")
        new = as_schema(new, schema)
        old_parts = [before["parts"][str(b)] for b in touched if str(b) in before["parts"]] if before else []
        if old_parts:
            old = self._read_parts(base, [f"{base}/{p}" for p in old_parts], (RUN,), schema)
            lost = new.filter(~keyless).select(BUCKET, *(col(k) for k in keys))
            kept = old.filter(~keyless).join(lost, [BUCKET, *keys], "left_anti").unionByName(old.filter(keyless))
            new = kept.unionByName(new)
        target = f"{base}/{RUN}={label}"
        _balanced(new, [BUCKET, *partition_by]).write.mode("overwrite").partitionBy(BUCKET, *partition_by).parquet(target)
        self._put(f"{target}/{SCHEMA_FILE}", schema.json())
        number, folder = self._next_snapshot(name, at, run)
        parts = {**(before["parts"] if before else {}), **{str(b): f"{RUN}={label}/{BUCKET}={b}" for b in touched}}
        self._remember(folder, schema)
        self._put(f"{folder}/{BUCKETS_FILE}", json.dumps({"buckets": count, "parts": parts}))
        self._put(f"{folder}/_SUCCESS", "")
        return number


INSERTED, UPDATED, DELETED = "inserted", "updated", "deleted"


def _keyed_changes(old: DataFrame, new: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows whose key is on one side only, or that differ in any column."""
    rest = [c for c in columns if c not in set(keys)]
    x = old.select(*(col(k) for k in keys), F.struct(*(col(c) for c in columns)).alias("__old"))
    y = new.select(*(col(k) for k in keys), F.struct(*(col(c) for c in columns)).alias("__new"))
    both = x.join(y, list(keys), "full_outer")
    gone, came = F.col("__new").isNull(), F.col("__old").isNull()
    same = F.lit(True)
    for c in rest:
        same = same & F.col("__old")[c].eqNullSafe(F.col("__new")[c])
    change = F.when(gone, DELETED).when(came, INSERTED).when(~same, UPDATED)
    row = F.coalesce("__new", "__old")
    return both.select(change.alias("change"), row.alias("row")).where("change is not null").select(
        "change", *(F.col("row")[c].alias(c) for c in columns)
    )


def _row_changes(old: DataFrame, new: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Whole rows that one side has more often than the other, as often as that."""
    sides = old.withColumn("__more", F.lit(-1)).unionByName(new.withColumn("__more", F.lit(1)))
    more = sides.groupBy(*(col(c) for c in columns)).agg(F.sum("__more").alias("__more")).where(F.col("__more") != 0)
    times = F.explode(F.sequence(F.lit(1), F.abs(F.col("__more")).cast("int")))
    change = F.when(F.col("__more") > 0, INSERTED).otherwise(DELETED)
    return more.select(change.alias("change"), *(col(c) for c in columns), times.alias("__time")).drop("__time")


def _balanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Few files per partition, while adaptive execution splits a partition that holds most rows."""
    return df.hint("rebalance", *(F.col(c) for c in partition_by)) if partition_by else df
