"""Profiles that merge, their error bounds, and drift."""

import pytest
from pyspark.sql import functions as F

from millrace.names import FILE
from millrace.operators import profiles
from millrace.operators.profiles import described, drift, merged_profile, profile, rank_errors

COLUMNS = ["price", "day", "code", "void"]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise(F.concat(F.lit("f"), (F.col("id") % 7).cast("string"))).alias(FILE),
        F.when(F.col("id") % 10 != 0, (F.col("id") * 7919 % 30_011).cast("decimal(12,2)")).alias("price"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 365).cast("int")).alias("day"),
        F.concat(F.lit("c"), F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 20)).alias("code"),
        F.lit(None).cast("string").alias("void"),
    )


def test_files_merge_to_the_whole_table(rows):
    stored = profile(rows, COLUMNS)
    assert stored.count() == 8 * len(COLUMNS)
    found = {r.column_name: r for r in described(merged_profile(stored)).collect()}
    assert {c: (r.row_count, r.null_count) for c, r in found.items()} == {
        "price": (30_000, 3_000), "day": (30_000, 0), "code": (30_000, 0), "void": (30_000, 30_000)
    }
    assert found["day"].distinct_count == 365 and found["void"].distinct_count == 0
    exact = rows.select("price").distinct().count() - 1
    assert abs(found["price"].distinct_count - exact) <= profiles.DISTINCT_ERROR * exact
    assert [tuple(t) for t in found["code"].top] == [("c0", 15_000), *((f"c{k}", 1_500) for k in sorted((1, 3, 5, 7, 9, 11, 13, 15, 17, 19), key=str)[:9])]
    assert found["code"].quantiles is None and found["void"].quantiles is None and found["void"].top == []
    errors = rank_errors(rows, described(merged_profile(stored)), COLUMNS).collect()
    assert {r.column_name for r in errors} == {"price", "day"}
    assert all(r.rank_error <= profiles.QUANTILE_ERROR for r in errors)


def test_the_order_of_merging_changes_neither_counts_nor_distinct_values(rows):
    stored = profile(rows, COLUMNS)
    first = merged_profile(stored.where("file < 'f3'")).select("*", F.lit("x").alias("file"))
    rest = merged_profile(stored.where("file >= 'f3'")).select("*", F.lit("y").alias("file"))
    twice = described(merged_profile(first.unionByName(rest)))
    at_once = described(merged_profile(stored))
    plain = ("column_name", "row_count", "null_count", "top")
    assert sorted(twice.select(*plain).collect()) == sorted(at_once.select(*plain).collect())


def test_odd_values(spark):
    odd = spark.sql(f"SELECT * FROM VALUES (NULL, double('NaN'), ''), (NULL, double('Infinity'), NULL), ('f', 1.5D, ''), ('f', 1.5D, '') AS t({FILE}, x, s)")
    found = {r.column_name: r for r in described(merged_profile(profile(odd, ["x", "s"])), [0.5]).collect()}
    assert found["x"].quantiles == [1.5] and found["x"].distinct_count == 3 and found["x"].null_count == 0
    assert found["s"].null_count == 1 and [tuple(t) for t in found["s"].top] == [("", 3)]
    assert profile(odd.limit(0), ["x"]).count() == 0
    assert merged_profile(profile(odd.limit(0), ["x"])).count() == 0


def test_drift_names_its_reason(spark, rows):
    changed = rows.select(
        FILE, (F.col("price") * 2).alias("price"), "day", F.concat(F.lit("new-"), "code").alias("code"),
        F.when(F.col("code") == "c0", "filled").alias("void"), F.lit(1).alias("more"),
    )
    before = merged_profile(profile(rows, COLUMNS))
    found = {r.column_name: r for r in drift(merged_profile(profile(changed, [*COLUMNS, "more"])), before).collect()}
    assert {c: r.reason for c, r in found.items()} == {"price": "RANKS", "day": None, "code": "VALUES", "void": "NULLS", "more": "COLUMN"}
    assert found["price"].rank_change == pytest.approx(0.5, abs=2 * profiles.QUANTILE_ERROR)
    assert all(r.status == "STABLE" for r in drift(before, before).collect())
