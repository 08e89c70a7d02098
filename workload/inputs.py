"""Raw inputs derived from the given tables, in Spark and as SQL fragments.

``raw_orders`` turns clean orders into all-text, multi-file rows with known bad
cells. Both forms use only expressions that mean the same in both engines.
"""

from __future__ import annotations

import zipfile
from collections.abc import Iterator
from datetime import datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.names import FILE
from millrace.plans.ingest import JudgedTable, judge
from millrace.rules import ColumnRule, TableRule
from millrace.session import configure, materialize
from millrace.sources.files import hadoop_path, with_file_metadata
from millrace.sources.storage import create_file

RUN_TS = datetime(2025, 1, 15, 10, 30, 0)
ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(c: str) -> Column:
    return F.col(c).cast("decimal(15,2)").cast("string")


def order_file() -> Column:
    return F.concat(
        F.lit("orders_"), F.year("o_orderdate").cast("string"), F.lit("0101_"),
        F.lpad((F.col("o_custkey") % 2).cast("string"), 6, "0"),
    )


def raw_orders(spark: SparkSession, sf_dir: str, copies: bool = False) -> DataFrame:
    """All-text orders; with ``copies`` every hundredth row is delivered twice."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    spoiled_file = (F.year("o_orderdate") == 1999) & (F.col("o_custkey") % 2 == 0) & (key % 5 == 0)
    raw = o.select(
        order_file().alias(FILE),
        key.cast("string").alias("o_orderkey"),
        F.when(key % 45 == 0, "x").otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"),
        "o_orderstatus",
        F.when(spoiled_file | (key % 50 == 0), "abc").when(key % 75 == 0, "").otherwise(money("o_totalprice")).alias(
            "o_totalprice"
        ),
        F.when(key % 40 == 0, "20251345").when(key % 60 == 0, None).otherwise(F.date_format("o_orderdate", "yyyyMMdd")).alias(
            "o_orderdate"
        ),
        F.when(key % 7 == 0, F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit("  "))).otherwise(
            F.col("o_orderpriority")
        ).alias("o_orderpriority"),
    )
    if copies:
        times = F.when(F.col("o_orderkey").cast("bigint") % 100 == 0, 2).otherwise(1)
        raw = raw.withColumn("__copy", F.explode(F.sequence(F.lit(1), times))).drop("__copy")
    return raw


def with_metadata(raw: DataFrame) -> DataFrame:
    """Raw rows with the file date, partition and processing columns."""
    return with_file_metadata(raw, F.concat(F.lit("/landing/"), F.col(FILE), F.lit(".csv")), RUN_TS)


ORDER_RULES = (
    ColumnRule("o_orderkey", 1, "LONG", merge_key=True),
    ColumnRule("o_custkey", 2, "INTEGER"),
    ColumnRule("o_orderstatus", 3, "STRING", "lowercase"),
    ColumnRule("o_totalprice", 4, "DECIMAL(15,2)"),
    ColumnRule("o_orderdate", 5, "DATE", pattern="YYYYMMDD", action="REJECT"),
    ColumnRule("o_orderpriority", 6, "STRING", "uppercase"),
)
ORDER_TABLE = TableRule("orders", mode="full_snapshot")


def order_rules(**changes: dict) -> tuple[ColumnRule, ...]:
    """The order rules with some fields of some columns changed."""
    from dataclasses import replace

    return tuple(replace(r, **changes.get(r.name, {})) for r in ORDER_RULES)


def judged_orders(spark: SparkSession, sf_dir: str, rules=ORDER_RULES, rule: TableRule = ORDER_TABLE) -> JudgedTable:
    return judge(raw_orders(spark, sf_dir), rule, rules)


def landed_orders(spark: SparkSession, sf_dir: str, copies: bool = False) -> DataFrame:
    """The raw orders as a written raw table with metadata, as a run finds it."""
    return materialize(with_metadata(raw_orders(spark, sf_dir, copies)), "orders-raw")


# The same rows in SQL.
RAW_ORDERS = """raw AS (
  SELECT 'orders_' || CAST(year(o_orderdate) AS VARCHAR) || '0101_' || lpad(CAST(o_custkey % 2 AS VARCHAR), 6, '0') AS file,
    CAST(o_orderkey AS VARCHAR) AS o_orderkey,
    CASE WHEN o_orderkey % 45 = 0 THEN 'x' ELSE CAST(o_custkey AS VARCHAR) END AS o_custkey,
    o_orderstatus,
    CASE WHEN (year(o_orderdate) = 1999 AND o_custkey % 2 = 0 AND o_orderkey % 5 = 0) OR o_orderkey % 50 = 0 THEN 'abc'
         WHEN o_orderkey % 75 = 0 THEN '' ELSE CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) END AS o_totalprice,
    CASE WHEN o_orderkey % 40 = 0 THEN '20251345' WHEN o_orderkey % 60 = 0 THEN NULL
         ELSE strftime(o_orderdate, '%Y%m%d') END AS o_orderdate,
    CASE WHEN o_orderkey % 7 = 0 THEN '  ' || o_orderpriority || '  ' ELSE o_orderpriority END AS o_orderpriority
  FROM orders)"""
RAW_ORDERS_COPIES = RAW_ORDERS.replace("raw AS (", "once AS (") + """,
raw AS (SELECT * FROM once UNION ALL SELECT * FROM once WHERE CAST(o_orderkey AS BIGINT) % 100 = 0)"""

# Typed values and invalid-cell flags; a cell is invalid when a filled text gave no value.
TYPED_ORDERS = RAW_ORDERS + """,
vals AS (
  SELECT *, CAST(o_orderkey AS BIGINT) AS k, TRY_CAST(o_custkey AS INTEGER) AS cust, lower(trim(o_orderstatus)) AS st,
    TRY_CAST(NULLIF(o_totalprice, '') AS DECIMAL(15,2)) AS price,
    try_strptime(NULLIF(trim(o_orderdate), ''), '%Y%m%d') AS odate, upper(trim(o_orderpriority)) AS prio
  FROM raw),
typed AS (
  SELECT *, cust IS NULL AND o_custkey IS NOT NULL AND o_custkey <> '' AS bad_cust,
    price IS NULL AND o_totalprice IS NOT NULL AND o_totalprice <> '' AS bad_price,
    odate IS NULL AND o_orderdate IS NOT NULL AND trim(o_orderdate) <> '' AS bad_date
  FROM vals)"""

# Verdict of ORDER_RULES at 10%: customer, price and date can reject a file.
VERDICT_ORDERS = TYPED_ORDERS + """,
counts AS (
  SELECT file, count(*) AS total, count(*) FILTER (bad_cust) AS n_cust, count(*) FILTER (bad_price) AS n_price,
    count(*) FILTER (bad_date) AS n_date,
    count(*) FILTER (NOT bad_date AND CAST(bad_cust AS INT) + CAST(bad_price AS INT) > 1) AS over_one
  FROM typed GROUP BY file),
judged AS (
  SELECT *, CASE WHEN n_cust * 1.0::DOUBLE / total > 0.1::DOUBLE THEN 'o_custkey'
      WHEN n_price * 1.0::DOUBLE / total > 0.1::DOUBLE THEN 'o_totalprice'
      WHEN n_date * 1.0::DOUBLE / total > 0.1::DOUBLE THEN 'o_orderdate' END AS failing
  FROM counts),
verdict AS (
  SELECT *, CASE WHEN failing IS NULL THEN 'SUCCESS' ELSE 'REJECTED' END AS status,
    CASE failing WHEN 'o_custkey' THEN n_cust WHEN 'o_totalprice' THEN n_price WHEN 'o_orderdate' THEN n_date END
      / total::DOUBLE AS ratio,
    CASE WHEN failing IS NULL THEN over_one ELSE 0 END AS rejected_lines,
    CASE WHEN failing IS NULL THEN total - n_date - over_one ELSE 0 END AS accepted
  FROM judged),
good AS (
  SELECT t.* FROM typed t JOIN verdict v USING (file)
  WHERE v.status = 'SUCCESS' AND NOT bad_date AND CAST(bad_cust AS INT) + CAST(bad_price AS INT) <= 1)"""


def event_day_file() -> Column:
    return F.concat(F.lit("events_"), F.date_format("ts", "yyyyMMdd"), F.lit("_"), F.date_format("ts", "HHmmss"))


def write_named_files(df: DataFrame, name: str, directory: str, fmt: str = "csv", **options) -> list[str]:
    """One landing file per value of the column ``name``, called by that value.

    Spark writes one part per name, as one file has one writer; the driver only
    renames the parts.
    """
    spark = df.sparkSession
    staged = f"{directory}/_staged"
    df.repartition(F.col(name)).write.partitionBy(name).format(fmt).options(**options).save(staged)
    fs, _ = hadoop_path(spark, directory)
    path = spark._jvm.org.apache.hadoop.fs.Path
    written = []
    for part in fs.globStatus(path(f"{staged}/{name}=*/part-*")):
        value = part.getPath().getParent().getName().split("=", 1)[1]
        target = f"{directory}/{value}.{fmt}"
        fs.rename(part.getPath(), path(target))
        written.append(target)
    return written


def write_archives(lines: DataFrame, directory: str, *order: str) -> int:
    """ZIP files from rows (archive, member, line); returns their number.

    Each task streams its archives, so nothing is held as a whole.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = member = bundle = out = target = None
        written = []
        for batch in batches:
            for archive, inner, line in zip(*(batch.column(c).to_pylist() for c in ("archive", "member", "line"))):
                if archive != name:
                    if bundle is not None:
                        out.close()
                        bundle.close()
                    if target is not None:
                        target.close()
                    target = create_file(f"{directory}/{archive}")
                    bundle = zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED)
                    written.append(archive)
                    name, member, out = archive, None, None
                if inner != member:
                    if out is not None:
                        out.close()
                    out, member = bundle.open(inner, "w", force_zip64=True), inner
                out.write((line + "\n").encode())
        if bundle is not None:
            out.close()
            bundle.close()
            target.close()
        yield pa.RecordBatch.from_pydict({"archive": pa.array(written, pa.string())})

    tasks = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_lines = lines.repartition(tasks, "archive").sortWithinPartitions("archive", "member", *order)
    return sorted_lines.mapInArrow(write, "archive string").count()
