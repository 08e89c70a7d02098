"""Metrics, execution log and reports over judged files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.names import FILE
from millrace.operators import metrics
from millrace.session import materialize
from workload import inputs as inp
from workload.check_queries import judged_events
from workload.error_queries import ORDER_ERRORS_SQL
from workload.registry import query

PARTS = f"WITH {inp.VERDICT_ORDERS}, {ORDER_ERRORS_SQL}, sums AS (SELECT filename AS file, sum(error_count)::BIGINT AS n FROM errors GROUP BY 1)"


def errors_and_verdict(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    judged = inp.judged_orders(spark, sf_dir)
    return materialize(judged.errors(), "errors"), judged.verdict


def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    errors, verdict = errors_and_verdict(spark, sf_dir)
    return metrics.execution_log(verdict, errors, inp.ORDER_TABLE, 6, F.lit(inp.RUN_TS).cast("timestamp"), "dev")


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log of a run over two tables: orders and events."""
    events = judged_events(spark, sf_dir)
    log = metrics.execution_log(
        events.verdict, materialize(events.errors(), "errors"), events.rule, 3, F.lit(inp.RUN_TS).cast("timestamp"), "dev"
    )
    return order_log(spark, sf_dir).unionByName(log)


@query(
    "final_metrics", "H1",
    f"""{PARTS} SELECT v.file AS "FILE_NAME_RECEIVED", v.total AS total_rows, 0::BIGINT AS corrupt_rows, coalesce(n, 0)::BIGINT AS anomalies_total,
      accepted AS cleaned_rows FROM verdict v LEFT JOIN sums USING (file)""",
)
def final_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    errors, verdict = errors_and_verdict(spark, sf_dir)
    return metrics.final_metrics(verdict, errors)


@query(
    "error_summary", "H2",
    f"""{PARTS} SELECT table_name, column_name, sum(error_count)::BIGINT AS errors, count(*) AS error_rows FROM errors GROUP BY 1, 2""",
)
def error_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.error_summary(errors_and_verdict(spark, sf_dir)[0])


LOG_SQL = """log AS (SELECT 'orders' AS table_name, v.file AS filename, CASE WHEN status = 'REJECTED' THEN 'csv' ELSE 'staging' END AS input_format,
      'full_snapshot' AS ingestion_mode, 'internal' AS output_zone, total AS row_count, CASE WHEN status = 'REJECTED' THEN 0 ELSE 6 END AS column_count,
      false AS masking_applied, CASE WHEN status = 'SUCCESS' THEN coalesce(n, 0) ELSE 0 END::BIGINT AS error_count,
      CASE WHEN status = 'REJECTED' THEN '[000000009] REJECTED - Column ''' || failing || ''': RLK tolerance exceeded: ' || printf('%.2f', ratio * 100) || '% > 10.00%'
           WHEN coalesce(n, 0) > 0 THEN CAST(n AS VARCHAR) || ' errors' END AS error_message,
      CASE WHEN status = 'REJECTED' THEN '000000009' END AS error_no, status, 0::DOUBLE AS duration, 'dev' AS env,
      TIMESTAMP '2025-01-15 10:30:00' AS log_ts, 2025 AS yyyy, 1 AS mm, 15 AS dd FROM verdict v LEFT JOIN sums USING (file))"""


@query("execution_log_rows", "B11 H3", f"{PARTS}, {LOG_SQL} SELECT * FROM log")
def execution_log_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 18-column log row of every file, accepted or rejected."""
    return order_log(spark, sf_dir).withColumn("log_ts", F.col("log_ts").cast("timestamp_ntz"))


EVENT_STATUS = """ev AS (SELECT event_type, count(*) AS total, count(*) FILTER (event_id % 10 < CASE event_type WHEN 'error' THEN 8
      WHEN 'view' THEN 5 WHEN 'click' THEN 2 ELSE 0 END) AS bad FROM events GROUP BY 1),
  es AS (SELECT *, CASE WHEN bad / total::DOUBLE > 0.5::DOUBLE THEN 'REJECTED' ELSE 'SUCCESS' END AS status FROM ev),
  statuses AS (SELECT 'orders' AS table_name, status FROM verdict UNION ALL SELECT 'events', status FROM es)"""


@query(
    "run_counters", "H3 H4",
    f"""WITH {inp.VERDICT_ORDERS}, {EVENT_STATUS} SELECT count(*) FILTER (status = 'SUCCESS') AS files_succeeded, count(*) FILTER (status = 'REJECTED') AS files_rejected,
      count(*) FILTER (status = 'FAILED') AS files_failed, count(*) AS files_total,
      CASE WHEN count(*) FILTER (status = 'FAILED') > 0 THEN 1 WHEN count(*) FILTER (status = 'REJECTED') > 0 AND count(*) FILTER (status = 'SUCCESS') = 0 THEN 2 ELSE 0 END AS outcome_code
    FROM statuses""",
)
def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.run_counters(run_log(spark, sf_dir))


@query(
    "run_report", "H5",
    f"""WITH {inp.VERDICT_ORDERS}, {EVENT_STATUS} SELECT table_name, count(*) FILTER (status = 'SUCCESS') AS files_processed,
      count(*) FILTER (status <> 'SUCCESS') AS files_failed, 0::DOUBLE AS duration FROM statuses GROUP BY table_name""",
)
def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.run_report(run_log(spark, sf_dir))


@query(
    "rejected_files_report", "H6",
    f"""{PARTS}, {LOG_SQL} SELECT filename, error_message, row_count FROM log WHERE status = 'REJECTED'
    ORDER BY log_ts DESC, filename""",
)
def rejected_files_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.rejected_files(order_log(spark, sf_dir)).select("filename", "error_message", "row_count")


@query(
    "fail_fast_report", "H7",
    f"""{PARTS} SELECT filename, column_name, error_message, error_count FROM errors WHERE error_message LIKE '%FAIL FAST%'
    ORDER BY filename""",
)
def fail_fast_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    errors = errors_and_verdict(spark, sf_dir)[0].withColumn("log_ts", F.lit(inp.RUN_TS).cast("timestamp"))
    return metrics.fail_fast_errors(errors).select("filename", "column_name", "error_message", "error_count")


@query(
    "latest_results", "H8",
    """SELECT ts AS "timestamp", event_id, event_type FROM events ORDER BY ts DESC, event_id, event_type LIMIT 10""",
)
def latest_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inp.table(spark, sf_dir, "events").select(F.col("ts").alias("timestamp"), "event_id", "event_type")
    return metrics.latest(events, 10)


@query(
    "load_messages", "H9",
    f"""WITH {inp.VERDICT_ORDERS} SELECT file AS "FILE_NAME_RECEIVED", status, CAST(accepted AS VARCHAR) || ' rows integrated, '
      || CAST(total - accepted AS VARCHAR) || ' rejected' AS load_message FROM verdict""",
)
def load_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.load_messages(inp.judged_orders(spark, sf_dir).verdict)


@query(
    "dataset_metrics", "H10 J15",
    f"""WITH {inp.TYPED_ORDERS}, m AS (SELECT count(*) AS row_count,
        sum(CAST(cust IS NULL AS INT) + CAST(price IS NULL AS INT) + CAST(odate IS NULL AS INT))::BIGINT AS null_count,
        count(*) FILTER (cust IS NOT NULL AND price IS NOT NULL AND odate IS NOT NULL) / count(*)::DOUBLE AS quality_score FROM typed)
    SELECT 'orders' AS dataset, row_count, null_count, quality_score, '2025-01-15' AS date_created,
      CASE WHEN quality_score >= 0.95::DOUBLE THEN 'PASSED' ELSE 'FAILED' END AS quality_status FROM m""",
)
def dataset_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, NULLs and clean share of the typed orders, held against a floor."""
    from millrace.operators.baseline import quality_floor
    from millrace.operators.typing import type_columns

    typed = type_columns(inp.raw_orders(spark, sf_dir), inp.ORDER_RULES).values()
    measured = metrics.dataset_metrics(
        typed, "orders", ["o_custkey", "o_totalprice", "o_orderdate"], F.lit(inp.RUN_TS.date())
    )
    return quality_floor(measured, 0.95).withColumn("date_created", F.date_format("date_created", "yyyy-MM-dd"))


@query(
    "file_partition_values", "B7",
    """SELECT 'events_' || event_type AS "FILE_NAME_RECEIVED", min(strftime(ts, '%Y-%m-%d'))[1:4]::INTEGER AS yyyy,
      min(strftime(ts, '%Y-%m-%d'))[6:7]::INTEGER AS mm, min(strftime(ts, '%Y-%m-%d'))[9:10]::INTEGER AS dd
    FROM events WHERE event_type <> 'view' GROUP BY event_type UNION ALL SELECT 'events_view', NULL, NULL, NULL""",
)
def file_partition_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First complete date triple of each file; a file without one has none."""
    known = F.col("event_type") != "view"
    rows = inp.table(spark, sf_dir, "events").select(
        F.concat(F.lit("events_"), "event_type").alias(FILE),
        F.when(known, F.year("ts")).alias("yyyy"), F.when(known, F.month("ts")).alias("mm"), F.when(known, F.dayofmonth("ts")).alias("dd"),
    )
    return metrics.partition_values(rows)
