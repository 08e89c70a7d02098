"""Writing accepted rows: history, latest load and key-based upsert."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.names import FILE, FILE_DATE, FILE_REJECTED_ERROR, PROCESSED_AT, SUCCESS, any_of, col
from millrace.operators.skew import latest_per_key
from millrace.operators.typing import with_file_name
from millrace.operators.verdict import load_date, rows_of_rejected_files
from millrace.rules import TableRule
from millrace.session import materialize
from millrace.sinks.tables import TableStore


#: Stands for a file without any date.
NO_DATE = "0001-01-01"


def latest_load(rows: DataFrame) -> DataFrame:
    """Rows of the most recent file date. The date is a one-row table, so its join is a broadcast."""
    dated = rows.withColumn("__load", load_date(rows.columns))
    newest = dated.agg(F.max("__load").alias("__newest"))
    return dated.join(F.broadcast(newest), F.col("__load") == F.col("__newest"), "left_semi").drop("__load")


def _recency(df: DataFrame) -> list[Column]:
    """Newest first; the remaining columns settle ties the same way on every run."""
    leading = [c for c in (FILE_DATE, PROCESSED_AT, FILE) if c in df.columns]
    rest = [c for c in df.columns if c not in set(leading) and not c.startswith("__")]
    return [col(c).desc_nulls_last() for c in [*leading, *rest]]


def _one_per_key(rows: DataFrame, keys: Sequence[str], order: list[Column]) -> DataFrame:
    """The first row of every key. A NULL key equals nothing, so such rows all stay."""
    keyless = any_of([col(k).isNull() for k in keys])
    return latest_per_key(rows.filter(~keyless), list(keys), order).unionByName(rows.filter(keyless))


def _replace_keys(target: DataFrame, newest: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is not among the newest, and the newest.

    A small batch is broadcast, so a large target is not shuffled. Rows without
    a complete key cannot match and skip the join.
    """
    keyless = any_of([col(k).isNull() for k in keys])
    changed = newest.filter(~keyless).select(*(col(k) for k in keys))
    kept = target.filter(~keyless).join(changed, list(keys), "left_anti")
    return kept.unionByName(target.filter(keyless)).unionByName(newest, allowMissingColumns=True)


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target with the source's rows inserted or, by key, updated.

    ``target`` has one row per key, as this function and a first load leave it.
    """
    return _replace_keys(target, _one_per_key(source, keys, _recency(source)), keys)


def newest_date(rows: DataFrame):
    """The most recent file date of some rows; None without any."""
    return rows.agg(F.max(F.coalesce(load_date(rows.columns), F.lit(NO_DATE).cast("date")))).first()[0]


def _replace_last(store: TableStore, latest: DataFrame, rule: TableRule, at: datetime, run: str | None) -> None:
    """Make the rows the last table, unless that holds a newer load already."""
    date = newest_date(latest)
    if date is None:
        return
    held = newest_date(store.read(rule.last_table_name)) if store.exists(rule.last_table_name) else None
    if held is None or date >= held:
        store.replace(rule.last_table_name, latest, at, run=run)


def apply_ingestion_mode(
    store: TableStore, accepted: DataFrame, latest: DataFrame, rule: TableRule, merge_keys: Sequence[str], at: datetime, run: str | None = None
) -> None:
    """Write accepted rows to the table's history and renew its last table.

    ``merge``: the history keeps one row per key, the last table the newest load
    of the batch with one row per key. ``full_snapshot``: the delivery is the
    table, so the last table is replaced by all of it, whatever its dates. Any other
    mode: the last table holds the newest load. History is appended to in these
    modes. A late file with an older date never replaces the last table.
    """
    if rule.mode.lower() == "merge":
        if not merge_keys:
            raise ValueError(f"table {rule.name} is merged but has no merge key")
        batch = materialize(_one_per_key(accepted, merge_keys, _recency(accepted)), "batch")
        store.merge(rule.all_table_name, batch, merge_keys, at, run=run)
        latest = latest_load(batch)
    else:
        store.append(rule.all_table_name, accepted, run=run)
        if rule.mode.lower() == "full_snapshot":
            latest = accepted
    _replace_last(store, latest, rule, at, run)


def quarantine_rows(raw: DataFrame, verdict: DataFrame, table: str, at: datetime) -> DataFrame:
    """Raw rows of refused files, marked with table and attempt, so a later attempt stands beside this one."""
    named = rows_of_rejected_files(with_file_name(raw), verdict)
    return named.withColumns({"quarantined_table": F.lit(table), "attempt_ts": F.lit(f"{at:%Y%m%d_%H%M%S}"), "attempt_date": F.lit(f"{at:%Y%m%d}")})


def quarantine_errors(verdict: DataFrame, table: str) -> DataFrame:
    """One error row per refused file."""
    return verdict.filter(F.col("status") != SUCCESS).select(
        F.lit(table).alias("table_name"),
        F.col(FILE).alias("filename"),
        F.lit("filename").alias("column_name"),
        F.col("message").alias("error_message"),
        F.col(FILE).alias("raw_value"),
        F.coalesce("error_no", F.lit(FILE_REJECTED_ERROR)).alias("error_no"),
        F.lit(1).alias("error_count"),
    )


def quarantine(store: TableStore, raw: DataFrame, verdict: DataFrame, table: str, at: datetime, run: str | None = None) -> None:
    store.append("quarantine", quarantine_rows(raw, verdict, table, at), ("quarantined_table", "attempt_date"), run=run)


def write_quality_errors(store: TableStore, errors: DataFrame, zone: str, run_ts: Column, run: str | None = None) -> DataFrame:
    """Append error rows with zone and log time; returns what was written."""
    logged = errors.withColumns(
        {
            "zone": F.lit(zone), "log_ts": run_ts,
            "yyyy": F.year(run_ts), "mm": F.month(run_ts), "dd": F.dayofmonth(run_ts),
        }
    )
    label = run or f"auto-{uuid.uuid4().hex}"
    store.append("quality_errors", logged, run=label)
    return store.read_run("quality_errors", label)


def save_baseline(store: TableStore, df: DataFrame, name: str, at: datetime) -> str:
    """Keep the table as it is now as its baseline."""
    store.replace(f"baseline_{name}", df, at)
    return f"baseline_{name}"
