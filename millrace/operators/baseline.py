"""Comparison of a table with a saved baseline, without joining the two."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.names import DIFFERENT, EXTRA, FAILED, IDENTICAL, MISSING, PASSED, REGRESSION, SKIPPED, SUCCESS, col
from millrace.session import materialize

ROWS = "*"
ROW_COUNT_PERCENT = 5.0
#: So many columns are compared in one pass over all cells.
NARROW_COLUMNS = 8
SHORT_KINDS = {"boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp"}


def common_columns(actual: DataFrame, baseline: DataFrame) -> list[str]:
    present = set(actual.columns)
    return [c for c in baseline.columns if c in present]


def schema_diff(actual: DataFrame, baseline: DataFrame) -> tuple[list[str], list[str]]:
    """Columns missing from the actual table, and columns only it has."""
    return (
        sorted(set(baseline.columns) - set(actual.columns)),
        sorted(set(actual.columns) - set(baseline.columns)),
    )


def _side_profile(df: DataFrame, columns: Sequence[str], side: str) -> DataFrame:
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *(F.count_if(col(c).isNull()).alias(f"__null_{c}") for c in columns),
    )
    pairs = [F.lit(ROWS), F.col("__rows")]
    for c in columns:
        pairs += [F.lit(c), col(f"__null_{c}")]
    melted = counts.select(F.stack(F.lit(len(columns) + 1), *pairs).alias("metric", "n"))
    other = "baseline" if side == "actual" else "actual"
    return melted.select("metric", F.col("n").alias(side), F.lit(0).cast("bigint").alias(other))


def profile(actual: DataFrame, baseline: DataFrame) -> DataFrame:
    """Row count and NULL count per common column, actual beside baseline.

    One scan and one small aggregate per side.
    """
    columns = common_columns(actual, baseline)
    both = _side_profile(actual, columns, "actual").unionByName(_side_profile(baseline, columns, "baseline"))
    return both.groupBy("metric").agg(F.sum("actual").alias("actual"), F.sum("baseline").alias("baseline"))


def _diff_percent(actual: Column, baseline: Column) -> Column:
    return F.when(baseline > 0, (actual - baseline) / baseline.cast("double") * 100.0).otherwise(0.0)


def row_count_diff(profiled: DataFrame, percent: float = ROW_COUNT_PERCENT) -> DataFrame:
    share = _diff_percent(F.col("actual"), F.col("baseline"))
    return profiled.filter(F.col("metric") == ROWS).select(
        "baseline", "actual", (F.col("actual") - F.col("baseline")).alias("diff"),
        share.alias("diff_pct"), (F.abs(share) <= percent).alias("ok"),
    )


def null_diff(profiled: DataFrame) -> DataFrame:
    """NULL counts per column; not ok where the actual table has more."""
    return profiled.filter(F.col("metric") != ROWS).select(
        F.col("metric").alias("column_name"), "baseline", "actual",
        (F.col("actual") - F.col("baseline")).alias("diff"),
        (F.col("actual") <= F.col("baseline")).alias("ok"),
    )


def overall_verdict(
    actual: DataFrame, baseline: DataFrame, dataset: str, at: Column, percent: float = ROW_COUNT_PERCENT
) -> DataFrame:
    """One row: row count, schema and NULL checks and the overall status."""
    missing, extra = schema_diff(actual, baseline)
    is_rows = F.col("metric") == ROWS
    totals = profile(actual, baseline).agg(
        F.max(F.when(is_rows, F.col("baseline"))).alias("baseline"),
        F.max(F.when(is_rows, F.col("actual"))).alias("actual"),
        F.coalesce(F.min(F.when(~is_rows, F.col("actual") <= F.col("baseline"))), F.lit(True)).alias("nulls_ok"),
    )
    share = _diff_percent(F.col("actual"), F.col("baseline"))
    rows_ok = F.abs(share) <= percent
    schema_ok = F.lit(not missing)
    names = lambda values: F.array(*(F.lit(v) for v in values)).cast("array<string>")
    return totals.select(
        F.lit(dataset).alias("dataset"),
        at.alias("timestamp"),
        F.struct(
            "baseline", "actual", (F.col("actual") - F.col("baseline")).alias("diff"),
            share.alias("diff_pct"), rows_ok.alias("ok"),
        ).alias("row_count"),
        F.struct(
            names(missing).alias("missing_columns"), names(extra).alias("extra_columns"), schema_ok.alias("ok")
        ).alias("schema"),
        F.struct(F.col("nulls_ok").alias("ok")).alias("null_check"),
        F.when(rows_ok & schema_ok & F.col("nulls_ok"), PASSED).otherwise(FAILED).alias("overall_status"),
    )


def row_balance(actual: DataFrame, baseline: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Distinct rows with how often each side holds them.

    Grouping the union of both sides replaces the join: a key with many rows on
    both sides never multiplies, and identical rows collapse before any shuffle.
    """
    names = [*keys, *(c for c in columns if c not in set(keys))]
    sides = actual.select(*(col(c) for c in names), F.lit(1).alias("__a"), F.lit(0).alias("__b")).unionByName(
        baseline.select(*(col(c) for c in names), F.lit(0).alias("__a"), F.lit(1).alias("__b"))
    )
    return sides.groupBy(*(col(c) for c in names)).agg(
        F.sum("__a").alias("in_actual"), F.sum("__b").alias("in_baseline")
    )


def row_hashes(df: DataFrame, columns: Sequence[str]) -> tuple[Column, Column]:
    """Two 64-bit hashes of a row. Which cells are NULL is part of them, for Spark's hash passes over NULLs; -0.0 equals 0.0."""
    kinds = dict(df.dtypes)
    values = [col(c) + F.lit(0).cast(kinds[c]) if kinds[c] in ("float", "double") else col(c) for c in columns]
    nulls = F.concat(F.lit(""), *(F.when(col(c).isNull(), "1").otherwise("0") for c in columns))
    return F.xxhash64(F.lit(1), nulls, *values), F.xxhash64(F.lit(2), nulls, *values)


def key_balance(actual: DataFrame, baseline: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows per key on both sides and whether they differ; only keys and 128 bits of hashes of a row are shuffled."""
    rest = [c for c in columns if c not in set(keys)]
    if [dict(actual.dtypes)[c] for c in rest] != [dict(baseline.dtypes)[c] for c in rest]:
        balance = row_balance(actual, baseline, keys, columns)  # types differ: let Spark find the common ones
    else:
        hashes = ["__hash_1", "__hash_2"]
        sides = [df.select(*(col(k) for k in keys), *(h.alias(n) for h, n in zip(row_hashes(df, rest), hashes))) for df in (actual, baseline)]
        balance = row_balance(*sides, keys, hashes)
    return balance.groupBy(*(col(k) for k in keys)).agg(
        F.sum("in_actual").alias("actual_rows"),
        F.sum("in_baseline").alias("baseline_rows"),
        F.max(F.col("in_actual") != F.col("in_baseline")).alias("__differs"),
    )


def compare_rows(
    actual: DataFrame, baseline: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """Status of every key: missing, extra, identical or different."""
    compared = list(columns) if columns is not None else common_columns(actual, baseline)
    per_key = key_balance(actual, baseline, keys, compared)
    status = (
        F.when(F.col("actual_rows") == 0, MISSING)
        .when(F.col("baseline_rows") == 0, EXTRA)
        .when(F.col("__differs"), DIFFERENT)
        .otherwise(IDENTICAL)
    )
    return per_key.withColumn("row_status", status).drop("__differs")


def _short(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Keys and cells, each of 16 bytes at most: cells of other kinds are replaced by two hashes."""
    kinds = dict(df.dtypes)

    def cell(c: str) -> Column:
        if kinds[c] in SHORT_KINDS or kinds[c].startswith("decimal"):
            return col(c)
        return F.when(col(c).isNotNull(), F.struct(F.xxhash64(F.lit(1), col(c)), F.xxhash64(F.lit(2), col(c)))).alias(c)

    return df.select(*(col(k) for k in keys), *(cell(c) for c in columns if c not in set(keys)))


def match_rates(
    actual: DataFrame, baseline: DataFrame, keys: Sequence[str], tolerances: dict[str, float]
) -> DataFrame:
    """Share of baseline rows whose key holds an equal value, per column.

    Hashes tell which keys differ at all; rows of the others match in every
    column and are only counted. Full rows move for differing keys alone, and of
    these, rows equal as a whole are counted and just the rest is compared
    column by column. Of a few columns all cells move at once, long ones as
    hashes of 128 bits.
    """
    columns = list(tolerances)
    if len(columns) <= NARROW_COLUMNS and all(dict(actual.dtypes)[c] == dict(baseline.dtypes)[c] for c in columns):
        balance = row_balance(*(_short(df, keys, columns) for df in (actual, baseline)), keys, columns)
        return _rates(balance, keys, tolerances, F.lit(0), F.coalesce(F.sum("in_baseline"), F.lit(0)))
    per_key = key_balance(actual, baseline, keys, columns)
    differing = materialize(per_key.filter("__differs").select(*(col(k).alias(f"__at_{k}") for k in keys)), "differing-keys")
    all_rows = baseline.count()
    at = [col(k).eqNullSafe(col(f"__at_{k}")) for k in keys]
    actual, baseline = (df.join(differing, at, "left_semi") for df in (actual, baseline))
    equal = F.lit(all_rows) - F.coalesce(F.sum("in_baseline"), F.lit(0))
    balance = materialize(row_balance(actual, baseline, keys, columns), "row-balance")
    return _rates(balance, keys, tolerances, equal, F.lit(all_rows).cast("bigint"))


def _rates(balance: DataFrame, keys: Sequence[str], tolerances: dict[str, float], equal: Column, all_rows: Column) -> DataFrame:
    """Match rates from a row balance, ``equal`` baseline rows beyond it that match everywhere, and the number of baseline rows."""
    columns = list(tolerances)
    same = F.least("in_actual", "in_baseline")
    rest = balance.withColumns({"__a": F.col("in_actual") - same, "__b": F.col("in_baseline") - same}).filter(
        (F.col("__a") > 0) | (F.col("__b") > 0)
    )
    pairs = [part for c in columns for part in (F.lit(c), col(c).cast("string"))]
    cells = rest.select(
        *(col(k).alias(f"__key_{k}") for k in keys), "__a", "__b",
        F.stack(F.lit(len(columns)), *pairs).alias("column_name", "__value"),
    )
    partly = (
        cells.groupBy("column_name", *(col(f"__key_{k}") for k in keys), "__value")
        .agg(F.sum("__a").alias("__a"), F.sum("__b").alias("__b"))
        .select("column_name", F.least("__a", "__b").alias("matched"), F.lit(0).cast("bigint").alias("baseline_rows"))
    )
    names = F.array(*(F.lit(c) for c in columns))
    whole = (
        balance.agg((F.coalesce(F.sum(same), F.lit(0)) + equal).alias("matched"), all_rows.alias("baseline_rows"))
        .select(F.explode(names).alias("column_name"), "matched", "baseline_rows")
    )
    limit = F.coalesce(*(F.when(F.col("column_name") == c, F.lit(float(t))) for c, t in tolerances.items()))
    summed = whole.unionByName(partly).groupBy("column_name").agg(
        F.sum("matched").alias("matched"), F.sum("baseline_rows").alias("baseline_rows")
    )
    rate = F.when(F.col("baseline_rows") > 0, F.col("matched") / F.col("baseline_rows").cast("double")).otherwise(0.0)
    return summed.withColumns({"match_rate": rate, "ok": rate >= limit})


def null_ratios(df: DataFrame, columns: Sequence[str], ceiling: float = 0.02) -> DataFrame:
    """NULL share per column against a ceiling."""
    pairs = []
    for c in columns:
        pairs += [F.lit(c), col(f"__null_{c}")]
    one = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *(F.count_if(col(c).isNull()).alias(f"__null_{c}") for c in columns),
    )
    melted = one.select("total_rows", F.stack(F.lit(len(columns)), *pairs).alias("column_name", "nulls"))
    ratio = F.when(F.col("total_rows") > 0, F.col("nulls") / F.col("total_rows").cast("double")).otherwise(0.0)
    return melted.select("column_name", "nulls", ratio.alias("null_ratio"), (ratio <= ceiling).alias("ok"))


def duplicate_ceiling(actual: DataFrame, baseline: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows beyond the first of their key, per side; ok when the actual table has no more."""
    per_key = row_balance(actual, baseline, keys, keys)
    surplus = lambda c: F.sum(F.greatest(F.col(c) - 1, F.lit(0)))
    return per_key.agg(
        surplus("in_actual").alias("actual_duplicates"), surplus("in_baseline").alias("baseline_duplicates")
    ).withColumn("ok", F.col("actual_duplicates") <= F.col("baseline_duplicates"))


def match_percentage(actual: Column, expected: Column) -> Column:
    return F.when(expected > 0, actual / expected.cast("double")).otherwise(0.0)


def compare_with_specs(specs: DataFrame, outputs: DataFrame) -> DataFrame:
    """Each expected dataset against what a run produced.

    ``specs``: dataset, expected_rows, tolerance_pct, mandatory_columns,
    quality_floor. ``outputs``: dataset, row_count, columns, quality_score.
    A dataset without output is skipped.
    """
    joined = specs.join(outputs, "dataset", "left")
    available = F.col("row_count").isNotNull()
    allowed = F.floor(F.col("expected_rows") * F.col("tolerance_pct") / 100.0)
    rows_ok = F.abs(F.col("row_count") - F.col("expected_rows")) <= allowed
    missing = F.array_except("mandatory_columns", "columns")
    passed = rows_ok & (F.size(missing) == 0)
    return joined.select(
        "dataset",
        F.when(~available, SKIPPED).when(passed, PASSED).otherwise(FAILED).alias("status"),
        F.when(~available, "output not available").alias("reason"),
        "row_count",
        "expected_rows",
        allowed.cast("bigint").alias("tolerance"),
        rows_ok.alias("row_count_ok"),
        F.when(available, missing).alias("missing_columns"),
        (F.col("quality_score") >= F.col("quality_floor")).alias("quality_ok"),
    )


def consolidated_report(compared: DataFrame, at: Column) -> DataFrame:
    """One row over all datasets, with the details as JSON in dataset order."""
    detail = F.struct("dataset", "status", "row_count", "expected_rows")
    return compared.agg(
        F.count(F.lit(1)).alias("datasets_tested"),
        F.count_if(F.col("status") == PASSED).alias("datasets_passed"),
        F.count_if(F.col("status") == FAILED).alias("datasets_failed"),
        F.to_json(F.array_sort(F.collect_list(detail))).alias("details"),
    ).withColumn("timestamp", at)


def quality_regressions(current: DataFrame, baseline: DataFrame) -> DataFrame:
    """Datasets with more errors than in the baseline; both sides: dataset, errors."""
    both = current.select("dataset", F.col("errors").alias("now"), F.lit(0).alias("before")).unionByName(
        baseline.select("dataset", F.lit(0).alias("now"), F.col("errors").alias("before"))
    )
    summed = both.groupBy("dataset").agg(F.sum("now").alias("errors"), F.sum("before").alias("baseline_errors"))
    return summed.withColumn(
        "status", F.when(F.col("errors") > F.col("baseline_errors"), REGRESSION).otherwise(SUCCESS)
    )


def quality_floor(metrics: DataFrame, floor: Column | float) -> DataFrame:
    return metrics.withColumn("quality_status", F.when(F.col("quality_score") >= floor, PASSED).otherwise(FAILED))
