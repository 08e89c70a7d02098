"""Tolerance texts and threshold checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import tolerances as tol
from millrace.names import FILE, any_of
from millrace.operators.metrics import run_wide_stop
from millrace.operators.typing import bad_name, type_columns
from millrace.operators.verdict import file_counts
from workload import inputs as inp
from workload.registry import query

TEXT_SQL = """t AS (SELECT o_orderkey, o_custkey + 1 AS total, CASE o_orderkey % 8 WHEN 0 THEN '10%' WHEN 1 THEN '0.5%' WHEN 2 THEN '5'
    WHEN 3 THEN 'abc%' WHEN 4 THEN '' WHEN 5 THEN ' 100% ' WHEN 6 THEN '2.5' ELSE CAST(o_orderkey % 50 AS VARCHAR) || '%' END AS tolerance FROM orders),
  p AS (SELECT *, TRY_CAST(NULLIF(regexp_extract(trim(tolerance), '^(\\d+(?:\\.\\d+)?)\\s*%$', 1), '') AS DOUBLE) AS pct,
    CASE WHEN regexp_matches(trim(tolerance), '^\\d+(\\.\\d+)?$') THEN TRY_CAST(trim(tolerance) AS DOUBLE) END AS num FROM t)"""


def tolerance_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    kind = key % 8
    text = (
        F.when(kind == 0, "10%").when(kind == 1, "0.5%").when(kind == 2, "5").when(kind == 3, "abc%").when(kind == 4, "")
        .when(kind == 5, " 100% ").when(kind == 6, "2.5").otherwise(F.concat((key % 50).cast("string"), F.lit("%")))
    )
    return inp.table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") + 1).alias("total"), text.alias("tolerance"))


@query(
    "tolerance_ratios", "F1 F3",
    f"""WITH {TEXT_SQL} SELECT o_orderkey, coalesce(pct / 100.0::DOUBLE, num / total::DOUBLE) AS ratio FROM p""",
)
def tolerance_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = tolerance_texts(spark, sf_dir)
    return texts.select("o_orderkey", tol.tolerance_ratio(F.col("tolerance"), F.col("total")).alias("ratio"))


@query(
    "tolerance_lines", "F2",
    f"""WITH {TEXT_SQL} SELECT o_orderkey, CAST(floor(total * pct / 100.0::DOUBLE) AS BIGINT) AS allowed_lines FROM p""",
)
def tolerance_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = tolerance_texts(spark, sf_dir)
    return texts.select("o_orderkey", tol.tolerance_lines(F.col("tolerance"), F.col("total")).alias("allowed_lines"))


@query(
    "invalid_tolerances", "F4",
    f"""WITH {TEXT_SQL} SELECT o_orderkey, tolerance FROM p WHERE coalesce(pct, num) IS NULL""",
)
def invalid_tolerances(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = tolerance_texts(spark, sf_dir)
    return texts.filter(~tol.is_valid_tolerance(F.col("tolerance"))).select("o_orderkey", "tolerance")


RATE_SQL = f"""{inp.TYPED_ORDERS}, c AS (SELECT file, count(*) AS total,
      sum(CAST(bad_cust AS INT) + CAST(bad_price AS INT) + CAST(bad_date AS INT))::BIGINT AS errors,
      count(*) FILTER (bad_cust OR bad_price OR bad_date) AS rejected,
      CAST(bool_or(bad_cust) AS INT) + CAST(bool_or(bad_price) AS INT) + CAST(bool_or(bad_date) AS INT) AS invalid_columns FROM typed GROUP BY file)"""


def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors, lines with an error and columns with an error of each file."""
    typed = type_columns(inp.raw_orders(spark, sf_dir), inp.order_rules(o_orderdate={"action": "LOG_ONLY"}))
    bad = [F.col(bad_name(r)) for r in typed.checked]
    return typed.frame.groupBy(FILE).agg(
        F.count(F.lit(1)).alias("total"),
        sum((F.count_if(b) for b in bad[1:]), F.count_if(bad[0])).alias("errors"),
        F.count_if(any_of(bad)).alias("rejected"),
        sum((F.max(b).cast("int") for b in bad[1:]), F.max(bad[0]).cast("int")).alias("invalid_columns"),
    )


@query(
    "fail_fast_threshold", "F5",
    f"""WITH {RATE_SQL} SELECT file AS "FILE_NAME_RECEIVED", errors, total, errors / greatest(total, 1)::DOUBLE * 100.0::DOUBLE AS error_percent,
      errors / greatest(total, 1)::DOUBLE * 100.0::DOUBLE >= 10 AS stops FROM c""",
)
def fail_fast_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reaching the threshold is enough to stop."""
    errors, total = F.col("errors"), F.col("total")
    return rates(spark, sf_dir).select(
        FILE, "errors", "total", tol.percent_of(errors, total).alias("error_percent"),
        tol.stops_ingestion(errors, total).alias("stops"),
    )


@query(
    "rejected_line_threshold", "F6",
    f"""WITH {RATE_SQL} SELECT file AS "FILE_NAME_RECEIVED", rejected / greatest(total, 1)::DOUBLE * 100.0::DOUBLE AS rejected_percent,
      rejected / greatest(total, 1)::DOUBLE * 100.0::DOUBLE <= 6.5::DOUBLE AS ok, rejected / greatest(total, 1)::DOUBLE * 100.0::DOUBLE <= 2.5::DOUBLE AS ok_default FROM c""",
)
def rejected_line_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected, total = F.col("rejected"), F.col("total")
    return rates(spark, sf_dir).select(
        FILE, tol.percent_of(rejected, total).alias("rejected_percent"),
        tol.rejected_lines_ok(rejected, total, 6.5).alias("ok"), tol.rejected_lines_ok(rejected, total).alias("ok_default"),
    )


@query(
    "invalid_column_threshold", "F7",
    f"""WITH {RATE_SQL} SELECT file AS "FILE_NAME_RECEIVED", invalid_columns, invalid_columns / 6::DOUBLE * 100.0::DOUBLE AS invalid_percent,
      invalid_columns / 6::DOUBLE * 100.0::DOUBLE <= 0.15::DOUBLE AS ok FROM c""",
)
def invalid_column_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    invalid, columns = F.col("invalid_columns"), F.lit(len(inp.ORDER_COLUMNS))
    return rates(spark, sf_dir).select(
        FILE, "invalid_columns", tol.percent_of(invalid, columns).alias("invalid_percent"),
        tol.invalid_columns_ok(invalid, columns).alias("ok"),
    )


@query(
    "run_wide_fail_fast", "F8",
    f"""WITH {inp.TYPED_ORDERS}, t AS (SELECT CAST(substr(file, 8, 4) AS INTEGER) AS table_index, sum(CAST(bad_price AS INT) + CAST(bad_cust AS INT))::BIGINT AS errors,
        count(*) AS processed FROM typed GROUP BY 1),
      s AS (SELECT *, coalesce(sum(errors) OVER w, 0)::BIGINT AS errors_before, coalesce(sum(processed) OVER w, 0)::BIGINT AS processed_before
        FROM t WINDOW w AS (ORDER BY table_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    SELECT *, bool_or(errors_before > 0 AND errors_before / greatest(processed_before, 1)::DOUBLE * 100.0::DOUBLE >= 6::DOUBLE)
      OVER (ORDER BY table_index ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stopped FROM s""",
)
def run_wide_fail_fast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each year as one table of a run: errors of earlier tables stop the later ones."""
    typed = type_columns(inp.raw_orders(spark, sf_dir), inp.order_rules(o_orderdate={"action": "LOG_ONLY"}))
    counts = file_counts(typed, inp.ORDER_TABLE)
    year = F.substring(FILE, 8, 4).cast("int")
    tables = counts.groupBy(year.alias("table_index")).agg(
        F.sum(F.col("bad_o_totalprice") + F.col("bad_o_custkey")).alias("errors"), F.sum("total_rows").alias("processed")
    )
    return run_wide_stop(tables, 6.0)


@query(
    "threshold_texts", "F9",
    f"""WITH {TEXT_SQL}, d AS (SELECT *, TRY_CAST(NULLIF(trim(replace(tolerance, '%', '')), '') AS DOUBLE) AS value FROM p)
    SELECT o_orderkey, coalesce(value, 10::DOUBLE) AS fail_fast, coalesce(value, 2.5::DOUBLE) AS rejected_lines,
      coalesce(value, 0.15::DOUBLE) AS invalid_columns FROM d""",
)
def threshold_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("tolerance")
    return tolerance_texts(spark, sf_dir).select(
        "o_orderkey",
        tol.threshold_percent(text, tol.FAIL_FAST_PERCENT).alias("fail_fast"),
        tol.threshold_percent(text, tol.RLI_PERCENT).alias("rejected_lines"),
        tol.threshold_percent(text, tol.ICT_PERCENT).alias("invalid_columns"),
    )
