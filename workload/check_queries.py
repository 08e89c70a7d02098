"""Invalid counts, error actions, file verdicts, line rejection and quality checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.names import FILE, SUCCESS
from millrace.operators import error_rows as err
from millrace.operators import quality
from millrace.operators.typing import FLAGS, GONE, type_columns
from millrace.operators.verdict import accepted_rows, file_counts, file_verdict
from millrace.plans.ingest import JudgedTable, judge
from millrace.rules import ColumnRule, TableRule
from millrace.session import materialize
from workload import inputs as inp
from workload.archive_and_file_queries import RFC_FILES, RFC_RULES, rfc_raw
from workload.registry import query

FLAGSHIP_SQL = f"""WITH {inp.VERDICT_ORDERS}
SELECT file AS "FILE_NAME_RECEIVED", total AS total_rows, n_cust AS bad_o_custkey, n_price AS bad_o_totalprice,
  n_date AS bad_o_orderdate, status, failing AS failing_column, ratio AS failing_ratio, rejected_lines,
  accepted AS accepted_rows, CASE WHEN failing IS NOT NULL THEN '000000009' END AS error_no,
  CASE WHEN failing IS NOT NULL THEN 'Column ''' || failing || ''': RLK tolerance exceeded: '
    || printf('%.2f', ratio * 100) || '% > 10.00%' END AS message
FROM verdict"""


@query("file_verdict", "E6 E12 E5 D3 D4 D8 E1 G6 G7", FLAGSHIP_SQL)
def file_verdict_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file typed, counted and judged by one projection and one aggregate."""
    typed = type_columns(inp.raw_orders(spark, sf_dir), inp.ORDER_RULES)
    verdict = file_verdict(file_counts(typed, inp.ORDER_TABLE), typed, inp.ORDER_TABLE)
    return verdict.select(
        FILE, "total_rows", "bad_o_custkey", "bad_o_totalprice", "bad_o_orderdate", "status", "failing_column",
        "failing_ratio", "rejected_lines", "accepted_rows", "error_no", "message",
    )


@query(
    "invalid_counts", "E6",
    f"""WITH {inp.VERDICT_ORDERS}, m AS (SELECT file, total, 'o_custkey' AS column_name, n_cust AS bad FROM counts
      UNION ALL SELECT file, total, 'o_totalprice', n_price FROM counts UNION ALL SELECT file, total, 'o_orderdate', n_date FROM counts)
    SELECT file AS "FILE_NAME_RECEIVED", column_name, bad, bad / total::DOUBLE * 100.0::DOUBLE AS bad_percent FROM m WHERE bad > 0""",
)
def invalid_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = inp.judged_orders(spark, sf_dir)
    bad = err.bad_values(judged.typed).groupBy(FILE, "column_name").agg(F.sum("n").alias("bad"))
    share = F.col("bad") / F.col("total_rows").cast("double") * 100.0
    return bad.join(judged.verdict.select(FILE, "total_rows"), FILE).select(
        FILE, "column_name", "bad", share.alias("bad_percent")
    )


# Line items as a raw table: one file per shipping year, a third of the quantities unreadable.
LINEITEM_SQL = """raw AS (SELECT 'lineitem_' || CAST(year(l_shipdate) AS VARCHAR) || '0101' AS file,
    CAST(l_orderkey AS VARCHAR) AS l_orderkey, CASE WHEN l_linenumber % 3 = 0 THEN 'bad' || CAST(l_partkey % 11 AS VARCHAR)
    ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS l_quantity FROM lineitem),
  bad AS (SELECT file, 'l_quantity' AS column_name, l_quantity AS raw_value FROM raw WHERE l_quantity LIKE 'bad%'),
  n AS (SELECT file, count(*) AS total, count(*) FILTER (l_quantity LIKE 'bad%') AS bad FROM raw GROUP BY file)"""
LINEITEM_TABLE = TableRule("lineitem", file_tolerance="100%")
LINEITEM_RULES = (ColumnRule("l_orderkey", 1, "LONG"), ColumnRule("l_quantity", 2, "INTEGER", action="REJECT"))


def raw_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantity = F.when(
        F.col("l_linenumber") % 3 == 0, F.concat(F.lit("bad"), (F.col("l_partkey") % 11).cast("string"))
    ).otherwise(F.col("l_quantity").cast("int").cast("string"))
    return inp.table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("lineitem_"), F.year("l_shipdate").cast("string"), F.lit("0101")).alias(FILE),
        F.col("l_orderkey").cast("string").alias("l_orderkey"), quantity.alias("l_quantity"),
    )


def judged_lineitem(spark: SparkSession, sf_dir: str) -> JudgedTable:
    return judge(raw_lineitem(spark, sf_dir), LINEITEM_TABLE, LINEITEM_RULES)


@query(
    "sample_bad_values", "E7 G8",
    f"""WITH {LINEITEM_SQL} SELECT file AS filename, raw_value, 'COLUMN REJECTED: l_quantity. Expected type: INTEGER, ' || CAST(n.bad AS VARCHAR) || ' invalid values of '
      || CAST(n.total AS VARCHAR) || ' rows (' || printf('%.1f', n.bad / n.total::DOUBLE * 100) || '%). Value: ' || raw_value AS error_message, CAST(count(*) AS INTEGER) AS error_count
    FROM bad JOIN n USING (file) GROUP BY file, raw_value, n.bad, n.total""",
)
def sample_bad_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct bad text of a column under REJECT, with its exact number of cells."""
    return errors_of(judged_lineitem(spark, sf_dir)).select("filename", "raw_value", "error_message", "error_count")


@query(
    "actions_resolved", "E8 F9",
    """SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'REJECT' WHEN '2-HIGH' THEN 'LOG_ONLY' ELSE 'ICT_DRIVEN' END AS error_action,
      count(*) AS cells FROM orders GROUP BY 1""",
)
def actions_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blank forms of an action resolve to the default; the rest is upper-cased."""
    from millrace.sources.rule_tables import normalize_column_rules

    p = F.col("o_orderpriority")
    action = F.when(p == "1-URGENT", " reject").when(p == "2-HIGH", "Log_Only").when(p == "3-MEDIUM", "NaN").otherwise(" ")
    cells = inp.table(spark, sf_dir, "orders").select(action.alias("Error action"))
    return normalize_column_rules(cells).groupBy("error_action").agg(F.count(F.lit(1)).alias("cells"))


DATE_FIRST = dict(o_orderdate={"order": 0})


@query(
    "date_reject_first", "E9",
    f"""WITH {inp.TYPED_ORDERS} SELECT file AS "FILE_NAME_RECEIVED", count(*) AS total_rows, count(*) FILTER (bad_date) AS dropped_rows,
      count(*) FILTER (bad_cust AND NOT bad_date) AS bad_o_custkey, count(*) FILTER (bad_price AND NOT bad_date) AS bad_o_totalprice
    FROM typed GROUP BY file""",
)
def date_reject_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A date under REJECT removes its rows before later columns are counted; the denominator stays."""
    typed = type_columns(inp.raw_orders(spark, sf_dir), inp.order_rules(**DATE_FIRST))
    counts = file_counts(typed, inp.ORDER_TABLE)
    return counts.select(FILE, "total_rows", "dropped_rows", "bad_o_custkey", "bad_o_totalprice")


def errors_of(judged: JudgedTable) -> DataFrame:
    values = materialize(err.bad_values(judged.typed), "bad-values")
    return err.table_errors(values, judged.verdict, judged.typed, judged.rule)


DATE_ERRORS_SQL = """SELECT 'orders' AS table_name, file AS filename, 'o_orderdate' AS column_name,
      'DATE_PARSE_ERROR: Pattern ''yyyyMMdd'' does not match. Value: 20251345' AS error_message, '20251345' AS raw_value,
      '000000005' AS error_no, CAST(n AS INTEGER) AS error_count FROM ({source}) s"""


@query(
    "date_errors_logged", "E9 E4",
    f"""WITH {inp.TYPED_ORDERS} {DATE_ERRORS_SQL.format(source='SELECT file, count(*) AS n FROM typed WHERE bad_date GROUP BY file')}""",
)
def date_errors_logged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bad dates are listed by text with their number, also in a nullable column under LOG_ONLY."""
    rules = inp.order_rules(
        o_orderdate={"action": "LOG_ONLY", "nullable": True}, o_custkey={"nullable": True}, o_totalprice={"nullable": True}
    )
    return errors_of(inp.judged_orders(spark, sf_dir, rules))


@query(
    "reject_action", "E10",
    f"""WITH {inp.TYPED_ORDERS}, c AS (SELECT file, count(*) AS total, count(*) FILTER (bad_price) AS bad FROM typed GROUP BY file)
    SELECT 'orders' AS table_name, file AS filename, 'o_totalprice' AS column_name,
      'COLUMN REJECTED: o_totalprice. Expected type: DECIMAL(15,2), ' || CAST(bad AS VARCHAR) || ' invalid values of '
        || CAST(total AS VARCHAR) || ' rows (' || printf('%.1f', bad / total::DOUBLE * 100) || '%). Value: abc' AS error_message,
      'abc' AS raw_value, '000000009' AS error_no, CAST(bad AS INTEGER) AS error_count FROM c WHERE bad > 0""",
)
def reject_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    """REJECT on a number lists its bad cells and keeps the rows, whatever their share."""
    rules = inp.order_rules(
        o_totalprice={"action": "REJECT"}, o_custkey={"nullable": True}, o_orderdate={"action": "LOG_ONLY", "nullable": True}
    )
    found = errors_of(inp.judged_orders(spark, sf_dir, rules))
    return found.filter(F.col("column_name") == "o_totalprice")


@query(
    "reject_keeps_rows", "E10",
    f"""WITH {inp.TYPED_ORDERS} SELECT file AS "FILE_NAME_RECEIVED", count(*) AS row_count,
      count(*) FILTER (price IS NULL) AS null_prices FROM typed GROUP BY file""",
)
def reject_keeps_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = inp.order_rules(
        o_totalprice={"action": "REJECT"}, o_custkey={"nullable": True}, o_orderdate={"action": "LOG_ONLY", "nullable": True}
    )
    rows = inp.judged_orders(spark, sf_dir, rules).accepted()
    return rows.groupBy(FILE).agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(F.col("o_totalprice").isNull()).alias("null_prices")
    )


@query(
    "flagged_rows", "E11",
    f"""WITH {inp.VERDICT_ORDERS} SELECT t.file AS "FILE_NAME_RECEIVED", CAST(bad_cust AS INT) + CAST(bad_price AS INT) AS flags,
      count(*) AS row_count FROM typed t JOIN verdict v USING (file) WHERE v.status = 'SUCCESS' AND NOT bad_date GROUP BY 1, 2""",
)
def flagged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by number of flagged cells in files below the tolerance."""
    judged = inp.judged_orders(spark, sf_dir)
    passed = judged.verdict.filter(F.col("status") == SUCCESS).select(FILE)
    rows = judged.typed.frame.filter(F.col(FLAGS) < GONE).join(passed, FILE, "left_semi")
    return rows.groupBy(FILE, F.col(FLAGS).alias("flags")).agg(F.count(F.lit(1)).alias("row_count"))


SUMMARY_SQL = """SELECT 'orders' AS table_name, file AS filename, '{column}' AS column_name, '{action}: ' || CAST({bad} AS VARCHAR) || '/'
      || CAST(total AS VARCHAR) || ' invalid (' || printf('%.1f', {bad} / total::DOUBLE * 100) || '%)' AS error_message,
      '{sample}' AS raw_value, '000000009' AS error_no, CAST({bad} AS INTEGER) AS error_count FROM {source} WHERE {bad} > 0"""


@query(
    "ict_summaries", "E11",
    f"""WITH {inp.VERDICT_ORDERS}, passed AS (SELECT * FROM verdict WHERE status = 'SUCCESS')
    {SUMMARY_SQL.format(column='o_custkey', action='ICT_DRIVEN', bad='n_cust', sample='x', source='passed')}
    UNION ALL {SUMMARY_SQL.format(column='o_totalprice', action='ICT_DRIVEN', bad='n_price', sample='abc', source='passed')}""",
)
def ict_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One summary row per file and flagged column below the tolerance."""
    return errors_of(inp.judged_orders(spark, sf_dir)).filter(F.col("error_message").startswith("ICT_DRIVEN"))


@query(
    "log_only_summaries", "E13",
    f"""WITH {inp.VERDICT_ORDERS} {SUMMARY_SQL.format(column='o_totalprice', action='LOG_ONLY', bad='n_price', sample='abc', source='counts')}""",
)
def log_only_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LOG_ONLY never rejects a file or a line: one summary row per file."""
    rules = inp.order_rules(o_totalprice={"action": "LOG_ONLY"}, o_custkey={"nullable": True})
    judged = inp.judged_orders(spark, sf_dir, rules)
    return errors_of(judged).filter(F.col("column_name") == "o_totalprice")


@query(
    "nullable_columns_silent", "E14",
    f"""WITH {inp.TYPED_ORDERS} SELECT file AS "FILE_NAME_RECEIVED", 'SUCCESS' AS status, count(*) AS accepted_rows, 0 AS flagged_columns,
      count(*) FILTER (bad_price) AS bad_o_totalprice FROM typed GROUP BY file""",
)
def nullable_columns_silent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bad values of nullable columns become NULL without a flag, an error row or a rejection."""
    rules = inp.order_rules(
        o_custkey={"nullable": True}, o_totalprice={"nullable": True}, o_orderdate={"nullable": True, "action": "ICT_DRIVEN"}
    )
    judged = inp.judged_orders(spark, sf_dir, rules)
    return judged.verdict.select(FILE, "status", "accepted_rows", "flagged_columns", "bad_o_totalprice")


@query(
    "accepted_orders", "E12 E15 E22",
    f"""WITH {inp.VERDICT_ORDERS} SELECT file AS "FILE_NAME_RECEIVED", k AS o_orderkey, cust AS o_custkey, st AS o_orderstatus,
      price::DOUBLE AS o_totalprice, odate AS o_orderdate, prio AS o_orderpriority FROM good""",
)
def accepted_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All accepted rows: refused files, removed rows and rejected lines are gone."""
    rows = inp.judged_orders(spark, sf_dir).accepted()
    shown = {"o_orderdate": "timestamp_ntz", "o_totalprice": "double"}
    values = [F.col(c).cast(shown[c]).alias(c) if c in shown else F.col(c) for c in inp.ORDER_COLUMNS]
    return rows.select(FILE, *values)


@query(
    "rejected_lines", "E15",
    f"""WITH {inp.VERDICT_ORDERS} SELECT 'orders' AS table_name, file AS filename, 'MULTIPLE_COLUMNS' AS column_name,
      'Lines with too many errors: ' || CAST(rejected_lines AS VARCHAR) AS error_message, CAST(NULL AS VARCHAR) AS raw_value,
      '000000009' AS error_no, CAST(rejected_lines AS INTEGER) AS error_count FROM verdict WHERE rejected_lines > 0""",
)
def rejected_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return err.line_errors(inp.judged_orders(spark, sf_dir).verdict, inp.ORDER_TABLE)


WIDE = range(1, 25)
WIDE_SQL = ", ".join(f"(l_orderkey * 7 + l_linenumber * {i} + l_partkey) % 40 < 3 AS b{i}" for i in WIDE)


@query(
    "wide_line_limit", "E15",
    f"""WITH w AS (SELECT 'lines_' || CAST(year(l_shipdate) AS VARCHAR) AS file, {WIDE_SQL} FROM lineitem),
      c AS (SELECT file, {' + '.join(f'CAST(b{i} AS INT)' for i in WIDE)} AS flags FROM w),
      l AS (SELECT file, {' + '.join(f'CAST(bool_or(b{i}) AS INT)' for i in WIDE)} AS flagged FROM w GROUP BY file)
    SELECT c.file AS "FILE_NAME_RECEIVED", flagged AS flagged_columns, greatest(1, CAST(floor(flagged * 0.1) AS INTEGER)) AS line_limit,
      count(*) FILTER (flags > greatest(1, CAST(floor(flagged * 0.1) AS INTEGER))) AS rejected_lines
    FROM c JOIN l USING (file) GROUP BY c.file, flagged""",
)
def wide_line_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """24 flagged columns: a line may have two bad cells, a third rejects it."""
    bad = lambda i: (F.col("l_orderkey") * 7 + F.col("l_linenumber") * i + F.col("l_partkey")) % 40 < 3
    raw = inp.table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("lines_"), F.year("l_shipdate").cast("string")).alias(FILE),
        *(F.when(bad(i), "abc").otherwise("1").alias(f"c{i}") for i in WIDE),
    )
    rules = [ColumnRule(f"c{i}", i, "INTEGER") for i in WIDE]
    verdict = judge(raw, TableRule("lines", file_tolerance="100%"), rules).verdict
    return verdict.select(FILE, "flagged_columns", "line_limit", "rejected_lines")


@query(
    "corrupt_line_check", "E16",
    f"""WITH c AS (SELECT {RFC_FILES} AS file, count(*) AS total, count(*) FILTER (c_custkey % 10 = 0) AS corrupt FROM customer GROUP BY 1)
    SELECT file AS "FILE_NAME_RECEIVED", total AS total_rows, corrupt AS corrupt_rows,
      CASE WHEN corrupt / total::DOUBLE > 0.1::DOUBLE THEN 'FAILED' ELSE 'SUCCESS' END AS status,
      CASE WHEN corrupt / total::DOUBLE > 0.1::DOUBLE THEN '000000007' END AS error_no,
      CASE WHEN corrupt / total::DOUBLE > 0.1::DOUBLE THEN 'RLI tolerance exceeded: ' || printf('%.2f', corrupt / total::DOUBLE * 100) || '% > 10.00%' END AS message,
      CASE WHEN corrupt / total::DOUBLE > 0.1::DOUBLE THEN 0 ELSE total - corrupt END AS accepted_rows FROM c""",
)
def corrupt_line_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with more than a tenth of unreadable lines fail as a whole."""
    verdict = judge(rfc_raw(spark, sf_dir), TableRule("clients", file_tolerance="10%"), RFC_RULES).verdict
    return verdict.select(FILE, "total_rows", "corrupt_rows", "status", "error_no", "message", "accepted_rows")


@query(
    "mandatory_nulls", "E17",
    f"""WITH {inp.VERDICT_ORDERS}, m AS (SELECT file, 'o_totalprice' AS column_name FROM good WHERE price IS NULL AND NOT bad_price
      UNION ALL SELECT file, 'o_orderdate' FROM good WHERE odate IS NULL)
    SELECT 'orders' AS table_name, file AS filename, column_name, 'Mandatory column is NULL' AS error_message,
      CAST(NULL AS VARCHAR) AS raw_value, '000000009' AS error_no, 1 AS error_count FROM m""",
)
def mandatory_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = inp.judged_orders(spark, sf_dir)
    return quality.mandatory_nulls(accepted_rows(judged.typed, judged.verdict), judged.typed, "orders")


@query(
    "duplicate_keys", "E18",
    """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
)
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(inp.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], by=())


@query(
    "duplicate_key_errors", "E18",
    f"""WITH {inp.RAW_ORDERS_COPIES} SELECT 'orders' AS table_name, file AS filename, 'o_orderkey' AS column_name,
      'Duplicate key: ' || CAST(count(*) AS VARCHAR) || ' rows' AS error_message, o_orderkey AS raw_value, '000000008' AS error_no,
      CAST(count(*) AS INTEGER) AS error_count FROM raw GROUP BY file, o_orderkey HAVING count(*) > 1""",
)
def duplicate_key_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_key_errors(inp.raw_orders(spark, sf_dir, copies=True), ["o_orderkey"], "orders")


@query(
    "duplicate_line_tolerance", "E19",
    """WITH k AS (SELECT 'lines_' || CAST(year(l_shipdate) AS VARCHAR) AS file, l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL),
      f AS (SELECT file, sum(n)::BIGINT AS total_rows, sum(n - 1)::BIGINT AS duplicate_rows FROM k GROUP BY file),
      r AS (SELECT *, duplicate_rows / total_rows::DOUBLE AS duplicate_ratio FROM f)
    SELECT file AS "FILE_NAME_RECEIVED", total_rows, duplicate_rows, duplicate_ratio,
      CASE WHEN duplicate_ratio > 0.045::DOUBLE THEN 'REJECTED' ELSE 'SUCCESS' END AS status,
      CASE WHEN duplicate_ratio > 0.045::DOUBLE THEN '000000008' END AS error_no,
      CASE WHEN duplicate_ratio > 0.045::DOUBLE THEN 'RLD tolerance exceeded: ' || printf('%.2f', duplicate_ratio * 100) || '% > 4.50%' END AS message FROM r""",
)
def duplicate_line_tolerance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inp.table(spark, sf_dir, "lineitem").withColumn(FILE, F.concat(F.lit("lines_"), F.year("l_shipdate").cast("string")))
    return quality.duplicate_shares(rows, ["l_orderkey", "l_linenumber"], "4.5%")


@query(
    "format_check", "E20",
    r"""SELECT page_id, url FROM pages WHERE NOT regexp_matches(url, '^https?://[a-z.]+/[a-z]{2}/[0-9]+$')""",
)
def format_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = inp.table(spark, sf_dir, "pages").select("page_id", "url")
    return quality.format_violations(pages, "url", r"^https?://[a-z.]+/[a-z]{2}/[0-9]+$")


@query(
    "row_count_check", "E21",
    """SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS row_count,
      CASE WHEN abs(count(*) - 333) <= floor(333 * 5 / 100.0) THEN 'PASSED' ELSE 'FAILED' END AS row_count_status FROM events GROUP BY 1""",
)
def row_count_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = inp.table(spark, sf_dir, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(
        F.count(F.lit(1)).alias("row_count")
    )
    return quality.row_count_check(days, F.col("row_count"), F.lit(333), 5)


# Events as one file per type; a different share of the dates of each file is impossible.
EVENT_DATES_SQL = """raw AS (SELECT 'events_' || event_type AS file, event_id, CASE WHEN event_id % 10 < CASE event_type
      WHEN 'error' THEN 8 WHEN 'view' THEN 5 WHEN 'click' THEN 2 ELSE 0 END THEN '2025-13-45' ELSE strftime(ts, '%Y-%m-%d') END AS day FROM events),
  c AS (SELECT file, count(*) AS total, count(*) FILTER (day = '2025-13-45') AS bad FROM raw GROUP BY file)"""
EVENT_RULES = (
    ColumnRule("event_id", 1, "STRING"), ColumnRule("user_id", 2, "STRING"),
    ColumnRule("day", 3, "DATE", pattern="YYYY-MM-DD", action="REJECT"),
)
EVENT_TABLE = TableRule("events", file_tolerance="50%")


def judged_events(spark: SparkSession, sf_dir: str) -> JudgedTable:
    t = F.col("event_type")
    share = F.when(t == "error", 8).when(t == "view", 5).when(t == "click", 2).otherwise(0)
    day = F.when(F.col("event_id") % 10 < share, "2025-13-45").otherwise(F.date_format("ts", "yyyy-MM-dd"))
    raw = inp.table(spark, sf_dir, "events").select(
        F.concat(F.lit("events_"), t).alias(FILE), F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("user_id"), day.alias("day"),
    )
    return judge(raw, EVENT_TABLE, EVENT_RULES)


@query(
    "partial_and_refused_files", "E22 E23 H9",
    f"""WITH {EVENT_DATES_SQL} SELECT file AS "FILE_NAME_RECEIVED", CASE WHEN bad / total::DOUBLE > 0.5::DOUBLE THEN 'REJECTED' ELSE 'SUCCESS' END AS status,
      CASE WHEN bad / total::DOUBLE > 0.5::DOUBLE THEN 0 ELSE total - bad END AS accepted_rows,
      CASE WHEN bad / total::DOUBLE > 0.5::DOUBLE THEN 'Column ''day'': RLK tolerance exceeded: ' || printf('%.2f', bad / total::DOUBLE * 100) || '% > 50.00%' END AS message FROM c""",
)
def partial_and_refused_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At 50%: a file with 80% bad dates is refused, one with 20% loses just those rows."""
    return judged_events(spark, sf_dir).verdict.select(FILE, "status", "accepted_rows", "message")


@query(
    "partial_load_errors", "E22 E23 G5",
    f"""WITH {EVENT_DATES_SQL}
    SELECT filename, column_name, error_message, error_no, sum(error_count)::BIGINT AS errors, count(*) AS error_rows FROM (
      SELECT file AS filename, 'day' AS column_name, 'DATE_PARSE_ERROR: Pattern ''yyyy-MM-dd'' does not match. Value: 2025-13-45' AS error_message,
        '000000005' AS error_no, CAST(bad AS INTEGER) AS error_count FROM c WHERE bad > 0 AND bad / total::DOUBLE <= 0.5::DOUBLE
      UNION ALL SELECT file, 'day', 'FAIL FAST - Column ''day'': RLK tolerance exceeded: ' || printf('%.2f', bad / total::DOUBLE * 100) || '% > 50.00%',
        '000000009', CAST(floor(total * (bad / total::DOUBLE)) AS INTEGER) FROM c WHERE bad / total::DOUBLE > 0.5::DOUBLE) e
    GROUP BY ALL""",
)
def partial_load_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = errors_of(judged_events(spark, sf_dir))
    return found.groupBy("filename", "column_name", "error_message", "error_no").agg(
        F.sum("error_count").alias("errors"), F.count(F.lit(1)).alias("error_rows")
    )


@query(
    "quality_gate", "E24",
    """WITH raw AS (SELECT 'lineitem_' || strftime(l_shipdate, '%Y%m%d') AS file, l_orderkey, l_linenumber FROM lineitem),
      k AS (SELECT file, count(*) AS n FROM raw GROUP BY file, l_orderkey, l_linenumber),
      f AS (SELECT file, sum(n)::BIGINT AS total_rows, coalesce(sum(n) FILTER (n > 1), 0)::BIGINT AS critical_errors FROM k GROUP BY file)
    SELECT file AS "FILE_NAME_RECEIVED", critical_errors, CASE WHEN critical_errors > 0 THEN 'FAILED_QUALITY' ELSE 'SUCCESS' END AS gate,
      CASE WHEN critical_errors > 0 THEN 0 ELSE total_rows END AS written_rows FROM f""",
)
def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One critical error holds back the whole file: nothing of it is written."""
    rows = inp.table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("lineitem_"), F.date_format("l_shipdate", "yyyyMMdd")).alias(FILE), "l_orderkey", "l_linenumber"
    )
    errors = quality.duplicate_key_errors(rows, ["l_orderkey", "l_linenumber"], "lineitem")
    gates = materialize(quality.quality_gate(rows.select(FILE).distinct(), errors, ["000000008"]), "gates")
    written = rows.join(gates.filter(F.col("gate") == SUCCESS).select(FILE), FILE, "left_semi")
    counts = written.groupBy(FILE).agg(F.count(F.lit(1)).alias("written_rows"))
    return gates.join(counts, FILE, "left").fillna(0, ["written_rows"])
