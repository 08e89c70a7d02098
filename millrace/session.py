"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import gc
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # The JVM does not compile larger methods; tables of many columns reach this
    # size, and separate operators are then faster than one interpreted method.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the jobs rely on to an existing session."""
    for key, value in SESSION_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session, where
    every task runs on this machine, may fall back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="millrace-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing has used yet."""
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


_open = threading.local()


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove at the end what :func:`materialize` writes inside; :func:`keep` takes a result out of the scope.

    Nothing that is used after the scope may read a table written in it. Results that are
    kept have their lineage cut, so that lost executors never ask for a removed table.
    """
    stack = _open.__dict__.setdefault("scopes", [])
    paths: list[str] = []
    stack.append(paths)
    try:
        yield
    finally:
        stack.remove(paths)
        for path in paths:
            handle = spark._jvm.org.apache.hadoop.fs.Path(path)
            handle.getFileSystem(spark._jsc.hadoopConfiguration()).delete(handle, True)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark remove shuffle files of finished queries: it does so when the driver's garbage is collected."""
    gc.collect()
    spark._jvm.System.gc()


def keep(df: DataFrame, label: str) -> DataFrame:
    """:func:`materialize` for the scope around the present one."""
    stack = _open.__dict__.setdefault("scopes", [])
    inner = stack.pop() if stack else None
    try:
        return materialize(df, label)
    finally:
        if inner is not None:
            stack.append(inner)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The lineage is cut at a durable table, so a lost executor does not repeat
    the work, and the optimizer knows the real size: a join picks a broadcast
    below ``spark.sql.autoBroadcastJoinThreshold`` and a skew-split sort-merge
    join above it.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    if scopes := _open.__dict__.get("scopes"):
        scopes[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
