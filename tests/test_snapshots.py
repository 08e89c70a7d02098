"""Snapshots by time and the changes between them."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.sinks.tables import TableStore

AT = datetime(2025, 1, 15, 10)


def test_by_time(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    for n in range(3):
        store.replace("t", spark.range(n + 1), AT + timedelta(days=n // 2))
    assert store.snapshot_at("t", AT) == 2 and store.snapshot_at("t", AT + timedelta(hours=23)) == 2 and store.snapshot_at("t", AT + timedelta(days=9)) == 3
    assert store.read_as_of("t", AT).count() == 2
    with pytest.raises(LookupError, match="no snapshot of 2025-01-15 09:59:59"):
        store.read_as_of("t", AT - timedelta(seconds=1))


def test_changes_of_a_merge_read_only_buckets_that_differ(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    first = spark.range(400).select("id", F.lit("a").alias("v")).union(spark.sql("SELECT NULL, 'k'"))
    store.merge("t", first, ["id"], AT, ())
    store.merge("t", spark.sql("SELECT 7L AS id, 'b' AS v, 1 AS w UNION ALL SELECT 8L, 'a', NULL UNION ALL SELECT NULL, 'k', NULL"), ["id"], AT, ())
    found = {(r["change"], r["id"], r["v"], r["w"]) for r in store.changes("t", ["id"], 1, 2).collect()}
    assert found == {("updated", 7, "b", 1), ("inserted", None, "k", None)}
    back = {(r["change"], r["id"], r["v"]) for r in store.changes("t", ["id"], 2, 1).collect()}
    assert back == {("updated", 7, "a"), ("deleted", None, "k")}
    read = store.changes("t", ["id"], 1, 2).inputFiles()
    assert 0 < len({f.split("/bucket=")[1].split("/")[0] for f in read}) < 8
    assert store.changes("t", ["id"], 2, 2).collect() == []


def test_changes_of_replaced_snapshots_with_other_types(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.replace("t", spark.sql("SELECT 1 AS id, 5 AS v UNION ALL SELECT 2, 6 UNION ALL SELECT 3, NULL"), AT)
    store.replace("t", spark.sql("SELECT 1 AS id, CAST(5.0 AS DECIMAL(4,1)) AS v UNION ALL SELECT 3, 1.5 UNION ALL SELECT 4, NULL"), AT)
    found = {(r["change"], r["id"], None if r["v"] is None else float(r["v"])) for r in store.changes("t", ["id"], 1, 2).collect()}
    assert found == {("deleted", 2, 6.0), ("updated", 3, 1.5), ("inserted", 4, None)}
