"""Comparison by stored digests: the rows of a whole comparison, and unchanged ranges not read."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.operators import digest_tree
from millrace.operators.baseline import compare_rows
from millrace.operators.digest_tree import compare_with_digests, save_digests
from millrace.sinks.tables import TableStore

AT = datetime(2025, 1, 15)


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path))


def table(spark, rows):
    return spark.createDataFrame(rows, "k bigint, part string, v double, note string")


def rows_of(df):
    return sorted(map(tuple, df.select("k", "part", "actual_rows", "baseline_rows", "row_status").collect()), key=str)


def test_equal_to_a_whole_comparison(spark, store):
    before = table(spark, [(k % 300 or None, "ab"[k % 2], k / 4, None if k % 5 else "n") for k in range(600)] + [(7, "a", 0.0, "z"), (7, "a", 0.0, "z"), (8, None, None, None)])
    now = table(
        spark,
        [(k % 300 or None, "ab"[k % 2], k / 4 + (k % 50 == 3), ("n" if k % 5 == 0 else None)) for k in range(600) if k % 40] + [(7, "a", -0.0, "z"), (8, None, None, None), (999, "x", 1.0, "")],
    )
    leaves = save_digests(store, before, "t", ["k", "part"], AT)
    assert leaves == 16
    right = compare_rows(now, before, ["k", "part"])
    assert rows_of(compare_with_digests(store, now, "t")) == rows_of(right)
    changed = compare_with_digests(store, now, "t", only_differences=True)
    assert rows_of(changed) == rows_of(right.where("row_status <> 'IDENTICAL'"))


def test_cells_that_swap_or_turn_null_differ(spark, store):
    before = spark.createDataFrame([(1, None, "x"), (2, "x", None), (3, "a", "b")], "k int, a string, b string")
    now = spark.createDataFrame([(1, "x", None), (2, "x", None), (3, "b", "a")], "k int, a string, b string")
    save_digests(store, before, "t", ["k"], AT)
    assert {r["k"]: r["row_status"] for r in compare_with_digests(store, now, "t").collect()} == {1: "DIFFERENT", 2: "IDENTICAL", 3: "DIFFERENT"}


@pytest.mark.parametrize("named", [1000, 0])
def test_unchanged_ranges_are_not_read(spark, store, tmp_path, monkeypatch, named):
    monkeypatch.setattr(digest_tree, "ROWS_PER_LEAF", 50)
    monkeypatch.setattr(digest_tree, "NAMED_LEAVES", named)
    before = spark.range(4000).select("id", (F.col("id") * 3).alias("v"))
    assert save_digests(store, before, "t", ["id"], AT) == 128
    now = before.withColumn("v", F.when(F.col("id") == 1234, -1).otherwise(F.col("v")))
    assert rows_of_equal(compare_with_digests(store, before, "t")) == 4000
    # Without the files of all folders but the one that holds the changed key the result is the same.
    place = store.read("baseline_t_digests").where("id = 1234").first()["__folder"]
    for folder in tmp_path.glob("baseline_t_digests/*/*/__folder=*"):
        if folder.name != f"__folder={place}":
            for file in folder.iterdir():
                file.unlink()
    changed = compare_with_digests(store, now, "t", only_differences=True)
    assert [tuple(r) for r in changed.collect()] == [(1234, 1, 1, "DIFFERENT")]
    if named:
        assert "(__folder#" in (plan := changed._jdf.queryExecution().executedPlan().toString()) and f" = {place})" in plan and "PartitionFilters" in plan


def rows_of_equal(df):
    return df.where("row_status = 'IDENTICAL' and actual_rows = 1 and baseline_rows = 1").count()


def test_changed_types_and_empty_tables(spark, store):
    before = spark.range(10).select("id", F.lit(1).alias("v"))
    save_digests(store, before, "t", ["id"], AT)
    with pytest.raises(ValueError, match="changed since the baseline: v"):
        compare_with_digests(store, before.withColumn("v", F.lit("1")), "t")
    assert {r["row_status"] for r in compare_with_digests(store, before.limit(0), "t").collect()} == {"MISSING"}
    save_digests(store, before.limit(0), "u", ["id"], AT)
    assert {r["row_status"] for r in compare_with_digests(store, before, "u").collect()} == {"EXTRA"}
