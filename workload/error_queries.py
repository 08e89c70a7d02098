"""Error rows: schema, union, codes and messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.messages import error_number, numbered
from millrace.names import FILE, REJECTED
from millrace.operators import error_rows as err
from workload import inputs as inp
from workload.check_queries import DATE_ERRORS_SQL, LINEITEM_SQL, SUMMARY_SQL, errors_of, judged_lineitem
from workload.registry import query

# All error rows of the raw orders, as one CTE body after VERDICT_ORDERS.
ORDER_ERRORS_SQL = f"""passed AS (SELECT * FROM verdict WHERE status = 'SUCCESS'),
errors AS (
  {SUMMARY_SQL.format(column='o_custkey', action='ICT_DRIVEN', bad='n_cust', sample='x', source='passed')}
  UNION ALL {SUMMARY_SQL.format(column='o_totalprice', action='ICT_DRIVEN', bad='n_price', sample='abc', source='passed')}
  UNION ALL {DATE_ERRORS_SQL.format(source='SELECT t.file, count(*) AS n FROM typed t JOIN passed USING (file) WHERE bad_date GROUP BY t.file')}
  UNION ALL SELECT 'orders', file, failing, 'FAIL FAST - Column ''' || failing || ''': RLK tolerance exceeded: '
    || printf('%.2f', ratio * 100) || '% > 10.00%', NULL, '000000009', CAST(floor(total * ratio) AS INTEGER) FROM verdict WHERE status = 'REJECTED'
  UNION ALL SELECT 'orders', file, 'MULTIPLE_COLUMNS', 'Lines with too many errors: ' || CAST(rejected_lines AS VARCHAR), NULL,
    '000000009', CAST(rejected_lines AS INTEGER) FROM verdict WHERE rejected_lines > 0
  UNION ALL SELECT 'orders', file, 'o_totalprice', 'Mandatory column is NULL', NULL, '000000009', 1 FROM good WHERE price IS NULL AND NOT bad_price
  UNION ALL SELECT 'orders', file, 'o_orderdate', 'Mandatory column is NULL', NULL, '000000009', 1 FROM good WHERE odate IS NULL)"""
ERROR_COLUMNS = "table_name, filename, column_name, error_message, raw_value, error_no, error_count"


@query(
    "all_error_rows", "G1 G2 G3 G5 G6 G7 E17 E11 E9 E15",
    f"WITH {inp.VERDICT_ORDERS}, {ORDER_ERRORS_SQL} SELECT {ERROR_COLUMNS} FROM errors",
)
def all_error_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every error row of the raw orders, typing to mandatory values, in one schema."""
    return inp.judged_orders(spark, sf_dir).errors(["o_orderkey"])


@query(
    "normalized_errors", "G2 G3",
    """SELECT 'orders' AS table_name, 'orders_raw' AS filename, 'o_totalprice' AS column_name, 'price is high' AS error_message,
      CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) AS raw_value, CAST(NULL AS VARCHAR) AS error_no, 1 AS error_count FROM orders WHERE o_totalprice > 400000
    UNION ALL SELECT 'orders', 'orders_raw', 'o_orderstatus', NULL, o_orderstatus, '000000009', CAST(count(*) AS INTEGER) FROM orders GROUP BY o_orderstatus""",
)
def normalized_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error frames of different shapes brought to the common schema and united."""
    orders = inp.table(spark, sf_dir, "orders")
    high = orders.filter("o_totalprice > 400000").select(
        F.lit("o_totalprice").alias("column_name"), F.lit("price is high").alias("error_message"), inp.money("o_totalprice").alias("raw_value")
    )
    status = orders.groupBy(F.col("o_orderstatus").alias("raw_value")).agg(F.count(F.lit(1)).alias("error_count")).withColumns(
        {"column_name": F.lit("o_orderstatus"), "error_no": F.lit("000000009")}
    )
    frames = [err.normalized(f, "orders", F.lit("orders_raw")) for f in (high, status)]
    return err.union_errors(frames)


@query(
    "fail_fast_error_rows", "G5 G7",
    f"""WITH {inp.VERDICT_ORDERS} SELECT 'orders' AS table_name, file AS filename, failing AS column_name,
      'FAIL FAST - Column ''' || failing || ''': RLK tolerance exceeded: ' || printf('%.2f', ratio * 100) || '% > 10.00%' AS error_message,
      CAST(NULL AS VARCHAR) AS raw_value, '000000009' AS error_no, CAST(floor(total * ratio) AS INTEGER) AS error_count FROM verdict WHERE status = 'REJECTED'""",
)
def fail_fast_error_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return err.file_errors(inp.judged_orders(spark, sf_dir).verdict, inp.ORDER_TABLE)


@query(
    "error_numbers", "G6",
    """SELECT o_orderpriority AS priority, CASE o_orderpriority WHEN '1-URGENT' THEN 'RLI' WHEN '2-HIGH' THEN 'RLD' WHEN '3-MEDIUM' THEN 'RLK' ELSE 'OTHER' END AS kind,
      CASE o_orderpriority WHEN '1-URGENT' THEN '000000007' WHEN '2-HIGH' THEN '000000008' WHEN '3-MEDIUM' THEN '000000009' ELSE '000000007' END AS error_no,
      count(*) AS n FROM orders GROUP BY o_orderpriority""",
)
def error_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("o_orderpriority")
    kind = F.when(p == "1-URGENT", "RLI").when(p == "2-HIGH", "RLD").when(p == "3-MEDIUM", "RLK").otherwise("OTHER")
    orders = inp.table(spark, sf_dir, "orders").select(p.alias("priority"), kind.alias("kind"))
    return orders.groupBy("priority", "kind", error_number(F.col("kind")).alias("error_no")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "rejection_messages", "G7 H6",
    f"""WITH {inp.VERDICT_ORDERS} SELECT file AS "FILE_NAME_RECEIVED", '[000000009] REJECTED - Column ''' || failing || ''': RLK tolerance exceeded: '
      || printf('%.2f', ratio * 100) || '% > 10.00%' AS error_message FROM verdict WHERE status = 'REJECTED'""",
)
def rejection_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdict = inp.judged_orders(spark, sf_dir).verdict.filter(F.col("status") == REJECTED)
    return verdict.select(FILE, numbered(F.col("error_no"), F.col("message")).alias("error_message"))


@query(
    "distinct_bad_values", "G8",
    f"""WITH {LINEITEM_SQL} SELECT file AS "FILE_NAME_RECEIVED", column_name, raw_value, count(*) AS n FROM bad GROUP BY ALL""",
)
def distinct_bad_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return err.bad_values(judged_lineitem(spark, sf_dir).typed)
