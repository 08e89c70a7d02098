"""A table against its saved baseline: verdict row, details and appended result."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import baseline as ops
from millrace.operators.metrics import dataset_metrics
from millrace.session import materialize
from millrace.sinks.tables import TableStore


@dataclass(frozen=True)
class Comparison:
    verdict: DataFrame
    row_statuses: DataFrame | None
    passed: bool


def compare_tables(
    actual: DataFrame,
    baseline: DataFrame,
    dataset: str,
    at: datetime,
    store: TableStore | None = None,
    keys: Sequence[str] = (),
    percent: float = ops.ROW_COUNT_PERCENT,
) -> Comparison:
    """Compare, append the verdict row to ``validation_results`` and tell if it passed."""
    stamp = F.lit(at).cast("timestamp")
    verdict = materialize(ops.overall_verdict(actual, baseline, dataset, stamp, percent), "comparison")
    if store is not None:
        store.append("validation_results", verdict, ("dataset",))
    rows = ops.compare_rows(actual, baseline, keys) if keys else None
    return Comparison(verdict, rows, verdict.first().overall_status == ops.PASSED)


@dataclass(frozen=True)
class Validation:
    datasets: DataFrame
    report: DataFrame
    passed: bool


def validate_datasets(
    specs: DataFrame,
    read: Mapping[str, Callable[[], DataFrame]],
    at: datetime,
    store: TableStore | None = None,
) -> Validation:
    """Many datasets against their specs: measure, compare, judge quality and regressions, report.

    ``specs`` as for :func:`ops.compare_with_specs`; ``read`` opens the datasets that
    a run produced, so that one that fails to open is skipped and the others go on.
    A dataset fails by row count, by a missing mandatory column or by quality below
    its floor; with a store, more NULLs than in the last validation are a
    regression. Statuses and the report are appended to the store.
    """
    stamp = F.lit(at).cast("timestamp")
    measured = None
    wanted = {r.dataset: r.mandatory_columns for r in specs.select("dataset", "mandatory_columns").collect()}  # one row per configured dataset
    for name, mandatory in wanted.items():
        try:
            df = read[name]() if name in read else None
        except Exception:  # noqa: BLE001 - a dataset that can't be opened has no output
            df = None
        if df is None:
            continue
        present = [c for c in mandatory if c in df.columns]
        one = dataset_metrics(df, name, present or df.columns[:1], stamp).withColumn("columns", F.array(*(F.lit(c) for c in df.columns)))
        measured = one if measured is None else measured.unionByName(one)
    if measured is None:
        kinds = "dataset string, row_count bigint, null_count bigint, quality_score double, date_created date, columns array<string>"
        measured = specs.sparkSession.createDataFrame([], kinds)
    measured = materialize(measured, "dataset-metrics")
    compared = ops.compare_with_specs(specs, measured)
    below = F.col("quality_ok") == F.lit(False)
    judged = compared.withColumns({
        "reason": F.when((F.col("status") != ops.SKIPPED) & below, "quality below its floor").otherwise(F.col("reason")),
        "status": F.when((F.col("status") == ops.PASSED) & below, ops.FAILED).otherwise(F.col("status")),
    })
    if store is not None and store.exists("dataset_metrics"):
        before = store.read("dataset_metrics").groupBy("dataset").agg(F.max_by("null_count", "validated_at").alias("errors"))
        change = ops.quality_regressions(measured.select("dataset", F.col("null_count").alias("errors")), before.join(measured.select("dataset"), "dataset", "left_semi"))
        worse = change.filter(F.col("status") == ops.REGRESSION).select("dataset", F.lit(True).alias("regressed"))
        judged = judged.join(worse, "dataset", "left").withColumn("status", F.when((F.col("status") == ops.PASSED) & F.col("regressed"), ops.REGRESSION).otherwise(F.col("status"))).drop("regressed")
    judged = materialize(judged, "validated-datasets")
    report = materialize(ops.consolidated_report(judged, stamp), "validation-report")
    if store is not None:
        store.append("dataset_metrics", measured.withColumn("validated_at", stamp), ())
        store.append("dataset_results", judged.withColumn("validated_at", stamp), ())
        store.append("validation_reports", report, ())
    return Validation(judged, report, judged.filter(~F.col("status").isin(ops.PASSED, ops.SKIPPED)).isEmpty())
