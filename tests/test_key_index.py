"""Keys held against the whole history."""

import glob
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.sinks import key_index
from millrace.sinks.key_index import KeyIndex
from millrace.sinks.tables import TableStore


def rows(df):
    return {(r["id"], r["row_count"], r["first_load"]) for r in df.collect()}


def load(index, batch, name):
    found = rows(index.register(batch, name))
    index.store.finish(name)
    return found


def test_against_brute_force_while_the_filter_grows(spark, tmp_path):
    index = KeyIndex(TableStore(spark, str(tmp_path)), "t", ["id"], words_per_bucket_log=7)
    first_load, sizes = {}, set()
    for n, (start, end, step) in enumerate([(0, 900, 1), (800, 9000, 3), (5, 6, 1), (0, 30000, 7)]):
        ids = [*range(start, end, step), start, start]
        expected = {(i, c, first_load.get(i)) for i, c in Counter(ids).items() if c > 1 or i in first_load}
        assert load(index, spark.createDataFrame([(i,) for i in ids], "id long"), f"l{n}") == expected
        for i in ids:
            first_load.setdefault(i, f"l{n}")
        sizes.add(index._size())
    assert len(sizes) > 1
    known = index._known(index._size())
    assert {(r["id"], r["first_load"]) for r in known.collect()} == set(first_load.items()) and known.count() == len(first_load)
    assert known.select("bucket").distinct().count() > key_index.FEWEST_BUCKETS


def test_few_new_keys_are_false_hits(spark, tmp_path):
    index = KeyIndex(TableStore(spark, str(tmp_path)), "t", ["id"])
    load(index, spark.range(4095), "a")
    counted = index._judge(spark.range(10000, 30000))[1]
    assert index._possible(counted, index._size()).count() < 20000 * 0.06


def test_untouched_buckets_are_not_read(spark, tmp_path):
    index = KeyIndex(TableStore(spark, str(tmp_path)), "t", ["id"], words_per_bucket_log=4)
    load(index, spark.range(3000), "a")
    size = index._size()
    bucket = spark.range(5, 6).select(index._bucket(F.xxhash64("id"), size)).first()[0]
    others = [p for p in glob.glob(f"{tmp_path}/t_keys_{size}/run_id=a/bucket=*/*.parquet") if f"bucket={bucket}/" not in p]
    assert len(others) >= 63
    for path in others:
        with open(path, "wb") as damaged:
            damaged.write(b"damaged")
    assert rows(index.repeated(spark.createDataFrame([(5,)], "id long"))) == {(5, 1, "a")}


def test_nulls_empty_loads_failed_loads_and_types(spark, tmp_path):
    index = KeyIndex(TableStore(spark, str(tmp_path)), "t", ["id", "part"])
    batch = spark.sql("SELECT 1L AS id, 'x' AS part UNION ALL SELECT 1L, NULL UNION ALL SELECT 1L, NULL UNION ALL SELECT NULL, 'x'")
    assert load(index, batch.limit(0), "empty") == set()
    index.register(batch, "failed")  # never finished
    assert index.repeated(batch).collect() == []
    assert load(index, batch, "again") == set() and load(index, batch.limit(0), "none") == set()
    assert rows(index.repeated(batch.withColumn("bucket", F.lit("clash")))) == {(1, 1, "again")}
    with pytest.raises(ValueError, match="finished already"):
        index.register(batch, "again")
    with pytest.raises(ValueError, match="change its type: id"):
        index.repeated(batch.withColumn("id", F.col("id").cast("int")))


def test_sizes():
    assert key_index._words_log(0) == key_index._words_log(4095) == 10 and key_index._words_log(4096) == 11
