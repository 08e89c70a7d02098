"""Columns whose type changes between loads."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sinks.schemas import merged, wider
from millrace.sinks.tables import TableStore

AT = datetime(2025, 1, 15)


def kind(text):
    return T._parse_datatype_string(text)


@pytest.mark.parametrize(
    "a, b, both",
    [
        ("int", "int", "int"), ("tinyint", "smallint", "smallint"), ("int", "bigint", "bigint"), ("int", "decimal(5,2)", "decimal(12,2)"),
        ("bigint", "decimal(15,2)", "decimal(22,2)"), ("decimal(10,4)", "decimal(12,2)", "decimal(14,4)"), ("decimal(38,0)", "decimal(10,5)", "string"),
        ("bigint", "double", "double"), ("float", "double", "double"), ("decimal(9,2)", "float", "double"), ("int", "string", "string"),
        ("date", "timestamp", "timestamp"), ("date", "int", "string"), ("boolean", "int", "string"), ("double", "string", "string"),
    ],
)
def test_lattice(spark, a, b, both):
    assert wider(kind(a), kind(b)) == wider(kind(b), kind(a)) == kind(both)
    assert wider(kind(both), kind(a)) == kind(both)


def test_nested_types_do_not_change(spark):
    assert wider(kind("array<int>"), kind("array<int>")) == kind("array<int>")
    with pytest.raises(ValueError, match="column x: "):
        merged(kind("x array<int>"), kind("x string"))


def test_appends_of_other_types_read_as_one_table(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.append("t", spark.sql("SELECT 1 AS k, 2 AS price, DATE '2025-01-02' AS at, 7 AS p"), ("p",), run="one")
    store.append("t", spark.sql("SELECT 2 AS k, CAST(2.5 AS DECIMAL(5,2)) AS price, TIMESTAMP '2025-01-02 03:04:05' AS at, 'new' AS extra, 7 AS p"), ("p",), run="two")
    store.append("t", spark.sql("SELECT 3 AS k, 8 AS price, DATE '2025-01-04' AS at, 8 AS p"), ("p",), run="three")
    for run in ("one", "two", "three"):
        store.finish(run)
    read = store.read("t")
    assert dict(read.dtypes) == {"k": "int", "price": "decimal(12,2)", "at": "timestamp", "p": "int", "extra": "string"}
    rows = {r["k"]: (r["price"], r["at"], r["extra"], r["p"]) for r in read.collect()}
    assert rows == {
        1: (Decimal("2.00"), datetime(2025, 1, 2), None, 7), 2: (Decimal("2.50"), datetime(2025, 1, 2, 3, 4, 5), "new", 7), 3: (Decimal("8.00"), datetime(2025, 1, 4), None, 8),
    }
    assert store.read_run("t", "two").count() == 1
    # Columns that did not change are read without a cast, so that filters reach the files.
    plan = read.where("k = 2")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("EqualTo(k,2)") >= 2


def test_merged_tables_widen_and_keep_untouched_buckets(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.merge("t", spark.range(200).select("id", F.col("id").cast("int").alias("v"), F.lit(date(2025, 1, 1)).alias("d")), ["id"], AT, ())
    store.merge("t", spark.sql("SELECT 5L AS id, CAST(0.25 AS DECIMAL(4,2)) AS v, 'n' AS note"), ["id"], AT, ())
    read = store.read("t")
    assert dict(read.dtypes) == {"id": "bigint", "v": "decimal(12,2)", "d": "date", "note": "string"}
    rows = {r["id"]: (r["v"], r["d"], r["note"]) for r in read.collect()}
    assert len(rows) == 200 and rows[5] == (Decimal("0.25"), None, "n") and rows[6] == (Decimal("6.00"), date(2025, 1, 1), None)
    assert dict(store.read("t", 1).dtypes)["v"] == "int" and store.read("t", 1).where("id = 5").first()["v"] == 5
    store.merge("t", spark.sql("SELECT 900L AS id, 'many' AS v"), ["id"], AT, ())
    assert store.read("t").where("id = 900").first()["v"] == "many" and store.read("t").where("id = 6").first()["v"] in ("6", "6.00")
    with pytest.raises(ValueError, match="merge key"):
        store.merge("t", spark.sql("SELECT 'x' AS id, 'y' AS v"), ["id"], AT, ())
