"""Profiles of loads that merge: counts and sketches per file and column, joined on reading, and drift against a baseline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.names import FILE, col

#: Log of the values that a sketch of distinct values keeps: up to so many it is exact, beyond it the relative
#: standard error is the root of their inverse.
DISTINCT_LOG = 12
DISTINCT_ERROR = 3 / (1 << DISTINCT_LOG) ** 0.5
#: Size of a quantile sketch and the rank error that it stays below with 99 %, also after merges.
QUANTILE_SIZE = 400
QUANTILE_ERROR = 0.02
#: Values that a sketch of frequent values follows; up to so many distinct ones their counts are exact.
FREQUENT_TRACKED = 1000
FREQUENT = 10
POINTS = tuple(n / 100 for n in range(1, 100))
#: Quantiles of a side that drift compares.
STEPS = 199
#: Drift: the largest accepted change of the share of NULLs, of any rank, and of the values in common.
NULL_LIMIT, RANK_LIMIT, VALUES_LIMIT = 0.02, 0.1, 0.5
DRIFT, STABLE = "DRIFT", "STABLE"

_NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")
_TIMES = ("date", "timestamp")


def _number(kind: str, column: Column) -> Column | None:
    """What quantiles are taken of: numbers, and times as seconds. NaN and infinities have no rank."""
    if kind.startswith(_TIMES):
        return F.unix_micros(column.cast("timestamp")) / 1e6
    if not kind.startswith(_NUMBERS):
        return None
    number = column.cast("double")
    return F.when(F.abs(number) < float("inf"), number)


def profile(df: DataFrame, columns: Sequence[str], by: str = FILE) -> DataFrame:
    """One row per file and column: ``row_count``, ``null_count`` and sketches of distinct values, ranks and frequent values.

    One pass over the named columns. Every aggregate has partial results in the tasks, so that only sketches of a hot
    file meet, and a sketch is no larger than its values. A column without any value has NULL for the sketch of
    ranks, as has one that is no number or time. An empty table gives no row.
    """
    kinds = dict(df.dtypes)
    values, built = {"__file": col(by)}, []
    for i, c in enumerate(columns):
        number = _number(kinds[c], col(c))
        values |= {f"t{i}": col(c).cast("string"), f"n{i}": F.lit(None).cast("double") if number is None else number}
        built += [
            F.count_if(F.col(f"t{i}").isNull()).alias(f"nulls{i}"),
            F.theta_sketch_agg(f"t{i}", DISTINCT_LOG).alias(f"distinct{i}"),
            F.when(F.count(f"n{i}") > 0, F.kll_sketch_agg_double(f"n{i}", QUANTILE_SIZE)).alias(f"ranks{i}"),
            F.expr(f"approx_top_k_accumulate(t{i}, {FREQUENT_TRACKED})").alias(f"frequent{i}"),
        ]
    one = df.select(*(v.alias(n) for n, v in values.items())).groupBy("__file").agg(F.count(F.lit(1)).alias("row_count"), *built)
    melted = F.array(*(
        F.struct(F.lit(c).alias("column_name"), *(F.col(f"{part}{i}").alias(name) for part, name in (
            ("nulls", "null_count"), ("distinct", "distinct_values"), ("ranks", "ranks"), ("frequent", "frequent"))))
        for i, c in enumerate(columns)
    ))
    rows = one.select(F.col("__file").alias("file"), "row_count", F.explode(melted).alias("p"))
    return rows.select("file", "p.column_name", "row_count", "p.null_count", "p.distinct_values", "p.ranks", "p.frequent")


def merged_profile(profiles: DataFrame, *by: str) -> DataFrame:
    """The profile of all files together per column, from stored profiles alone; with ``by`` per those columns too."""
    return profiles.groupBy(*by, "column_name").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("null_count").alias("null_count"),
        F.theta_union_agg("distinct_values", DISTINCT_LOG).alias("distinct_values"),
        F.when(F.count("ranks") > 0, F.kll_merge_agg_double("ranks", QUANTILE_SIZE)).alias("ranks"),
        F.expr(f"approx_top_k_combine(frequent, {FREQUENT_TRACKED})").alias("frequent"),
    )


def described(merged: DataFrame, points: Sequence[float] = POINTS, frequent: int = FREQUENT) -> DataFrame:
    """A merged profile in plain values: ``distinct_count``, ``quantiles`` at ``points`` and ``top`` (value, count)."""
    at = F.array(*(F.lit(float(p)) for p in points))
    top = F.expr(f"approx_top_k_estimate(frequent, {FREQUENT_TRACKED})")
    # Of equal counts the smaller values come first, also at the cut, so that the result does not hang on the order of the merges.
    top = F.transform(F.filter(top, lambda t: t["item"].isNotNull()), lambda t: F.struct((-t["count"]).alias("less"), t["item"].alias("value")))
    top = F.slice(F.array_sort(top), 1, frequent)
    return merged.select(
        *(c for c in merged.columns if c not in ("distinct_values", "ranks", "frequent")),
        F.round(F.theta_sketch_estimate("distinct_values")).cast("bigint").alias("distinct_count"),
        F.when(F.col("ranks").isNotNull(), F.kll_sketch_get_quantile_double("ranks", at)).alias("quantiles"),
        F.transform(top, lambda t: F.struct(t["value"].alias("value"), (-t["less"]).alias("count"))).alias("top"),
    )


def drift(
    current: DataFrame, baseline: DataFrame, null_limit: float = NULL_LIMIT, rank_limit: float = RANK_LIMIT, values_limit: float = VALUES_LIMIT
) -> DataFrame:
    """Each column of two merged profiles: how far they are apart, and whether that is drift.

    ``null_change``: difference of the shares of NULLs. ``rank_change``: largest difference of ranks at the
    quantiles of both sides, for numbers and times; NULL elsewhere. ``values_kept``: share of the baseline's distinct
    values still there, judged only where there are no ranks. ``reason`` names the first limit that is passed: NULLS,
    RANKS, VALUES, or COLUMN for one that a side lacks. A rank change
    within twice :data:`QUANTILE_ERROR` of its limit may fall on either side.
    """
    names = ("row_count", "null_count", "distinct_values", "ranks")
    sides = [df.select("column_name", F.struct(*names).alias(side)) for df, side in ((current, "now"), (baseline, "before"))]
    both = sides[0].join(sides[1], "column_name", "full")
    share = lambda side: F.when(F.col(f"{side}.row_count") > 0, F.col(f"{side}.null_count") / F.col(f"{side}.row_count").cast("double")).otherwise(0.0)
    ranked = F.col("now.ranks").isNotNull() & F.col("before.ranks").isNotNull()
    points = F.array(*(F.lit(n / (STEPS + 1)) for n in range(1, STEPS + 1)))
    below = lambda side, v: F.size(F.filter(F.col(side), lambda q: q <= v))
    apart = F.transform(F.array_union("q_now", "q_before"), lambda v: F.abs(below("q_now", v) - below("q_before", v)) / F.lit(float(STEPS + 1)))
    before = F.theta_sketch_estimate("before.distinct_values")
    common = F.theta_sketch_estimate(F.theta_intersection("now.distinct_values", "before.distinct_values"))
    whole = F.col("now").isNotNull() & F.col("before").isNotNull()
    quantiles = {f"q_{side}": F.when(ranked, F.kll_sketch_get_quantile_double(f"{side}.ranks", points)) for side in ("now", "before")}
    measured = both.withColumns(quantiles).select(
        "column_name",
        F.when(whole, F.abs(share("now") - share("before"))).alias("null_change"),
        F.when(ranked, F.array_max(apart)).alias("rank_change"),
        F.when(whole, F.when(before > 0, common / before).otherwise(1.0)).cast("double").alias("values_kept"),
    )
    reason = (
        F.when(F.col("null_change").isNull(), "COLUMN")
        .when(F.col("null_change") > null_limit, "NULLS")
        .when(F.col("rank_change") > rank_limit, "RANKS")
        .when(F.col("rank_change").isNull() & (F.col("values_kept") < values_limit), "VALUES")
    )
    return measured.select("*", F.when(reason.isNull(), STABLE).otherwise(DRIFT).alias("status"), reason.alias("reason"))


def rank_errors(df: DataFrame, estimates: DataFrame, columns: Sequence[str], points: Sequence[float] = POINTS) -> DataFrame:
    """The largest rank error of a described profile's quantiles in each column, by counting every row of ``df``.

    A quantile is right if the wanted rank lies between the share of values below it and that of values up to it.
    """
    kinds = dict(df.dtypes)
    wanted = [c for c in columns if _number(kinds[c], col(c)) is not None]
    cells = F.array(*(F.struct(F.lit(c).alias("column_name"), _number(kinds[c], col(c)).alias("x")) for c in wanted))
    rows = df.select(F.explode(cells).alias("cell")).select("cell.*").where("x is not null")
    # One row per column of the table; cells are counted per distinct value before they meet the quantiles.
    counted = rows.groupBy("column_name", "x").agg(F.count(F.lit(1)).alias("n"))
    met = counted.join(F.broadcast(estimates.select("column_name", "quantiles").where("quantiles is not null")), "column_name")
    sums = [F.sum("n").alias("total")]
    for k in range(len(points)):
        sums += [F.sum(F.when(F.col("x") < F.col("quantiles")[k], F.col("n")).otherwise(0)).alias(f"b{k}"), F.sum(F.when(F.col("x") <= F.col("quantiles")[k], F.col("n")).otherwise(0)).alias(f"u{k}")]
    found = met.groupBy("column_name").agg(*sums)
    error = [F.greatest(F.lit(0.0), F.col(f"b{k}") / F.col("total") - F.lit(float(p)), F.lit(float(p)) - F.col(f"u{k}") / F.col("total")) for k, p in enumerate(points)]
    return found.select("column_name", F.greatest(*error).alias("rank_error"))
