"""File names, file dates and the metadata columns of raw rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import filenames
from millrace.operators.arrivals import judge_file_dates, judge_registered_names
from millrace.operators.shape import with_system_columns
from millrace.sources.files import with_file_metadata
from workload import inputs as inp
from workload.registry import query

# Every event stands for one arriving file; the name takes all known forms.
NAMES_SQL = """names AS (SELECT event_id, ts, event_type, user_id, CASE event_id % 8
    WHEN 0 THEN 'data_' || strftime(ts, '%Y%m%d') WHEN 1 THEN 'data-' || strftime(ts, '%Y%m%d')
    WHEN 2 THEN 'data' || strftime(ts, '%Y%m%d') WHEN 3 THEN 'data_' || strftime(ts, '%Y%m%d_%H%M%S')
    WHEN 4 THEN 'data_' || strftime(ts, '%Y%m%d%H%M%S') WHEN 5 THEN 'data'
    WHEN 6 THEN 'id' || lpad(CAST(event_id + 123450000000 AS VARCHAR), 12, '0') ELSE 'a_20251345' END AS base,
    CASE event_id % 5 WHEN 4 THEN '.txt' ELSE '.csv' END AS ending FROM events),
  dated AS (SELECT *, try_strptime(regexp_extract(base, '[_-]?(\\d{8})[_-]?', 1), '%Y%m%d')::DATE AS fdate FROM names)"""


def base_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_id") % 8
    day, time = F.date_format("ts", "yyyyMMdd"), F.date_format("ts", "HHmmss")
    number = F.lpad((F.col("event_id") + 123450000000).cast("string"), 12, "0")
    base = (
        F.when(kind == 0, F.concat(F.lit("data_"), day)).when(kind == 1, F.concat(F.lit("data-"), day))
        .when(kind == 2, F.concat(F.lit("data"), day)).when(kind == 3, F.concat(F.lit("data_"), day, F.lit("_"), time))
        .when(kind == 4, F.concat(F.lit("data_"), day, time)).when(kind == 5, F.lit("data"))
        .when(kind == 6, F.concat(F.lit("id"), number)).otherwise(F.lit("a_20251345"))
    )
    ending = F.when(F.col("event_id") % 5 == 4, ".txt").otherwise(".csv")
    return inp.table(spark, sf_dir, "events").select(
        "event_id", "ts", "event_type", "user_id", base.alias("base"), ending.alias("ending")
    )


def ntz(c: str) -> Column:
    return F.col(c).cast("timestamp_ntz").alias(c)


@query(
    "file_metadata", "C1 C5 C6 C7 C8 C10",
    f"""WITH {NAMES_SQL}, f AS (SELECT event_id, CASE WHEN ending = '.csv' THEN base ELSE '' END AS name,
        CASE WHEN ending = '.csv' THEN fdate END AS d FROM dated)
    SELECT event_id, name AS "FILE_NAME_RECEIVED", CAST(d AS TIMESTAMP) AS "FILE_EXTRACTION_DATE",
      year(coalesce(d, DATE '2025-01-15'))::INTEGER AS yyyy, month(coalesce(d, DATE '2025-01-15'))::INTEGER AS mm,
      day(coalesce(d, DATE '2025-01-15'))::INTEGER AS dd, TIMESTAMP '2025-01-15 10:30:00' AS "FILE_PROCESS_DATE" FROM f""",
)
def file_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata columns from the path; only they and the data columns remain."""
    files = base_names(spark, sf_dir).select(
        "event_id", F.concat(F.lit("/landing/in/"), "base", "ending").alias("path")
    )
    rows = with_file_metadata(files, F.col("path"), inp.RUN_TS).drop("path")
    return rows.withColumns({c: ntz(c) for c in ("FILE_EXTRACTION_DATE", "FILE_PROCESS_DATE")})


@query(
    "file_date_candidates", "C2 C3 C4",
    f"""WITH {NAMES_SQL}, c AS (SELECT event_id, regexp_extract(base, '[_-]?(\\d{{8}})[_-]?', 1) AS date_only,
        regexp_extract(base, '[_-]?(\\d{{8}})\\d{{6}}[_-]?', 1) AS date_time_joined,
        regexp_extract(base, '[_-]?(\\d{{8}})[_-]\\d{{6}}', 1) AS date_time_split FROM names)
    SELECT *, CASE WHEN date_only <> '' THEN date_only WHEN date_time_joined <> '' THEN date_time_joined
      ELSE date_time_split END AS picked FROM c""",
)
def file_date_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("base")
    only, joined, split = filenames.date_candidates(name)
    return base_names(spark, sf_dir).select(
        "event_id", only.alias("date_only"), joined.alias("date_time_joined"), split.alias("date_time_split"),
        filenames.date_text(name).alias("picked"),
    )


@query(
    "system_columns", "C9",
    """SELECT event_id, event_type || '_' || strftime(ts, '%Y%m%d') AS "FILE_NAME_RECEIVED",
      TIMESTAMP '2025-01-15' AS "LOAD_DATE", TIMESTAMP '2025-01-15 10:30:00' AS "LOAD_TIMESTAMP" FROM events""",
)
def system_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inp.table(spark, sf_dir, "events")
    name = F.concat("event_type", F.lit("_"), F.date_format("ts", "yyyyMMdd"))
    loaded = with_system_columns(events, name, F.lit(inp.RUN_TS).cast("timestamp"))
    return loaded.select("event_id", "FILE_NAME_RECEIVED", ntz("LOAD_DATE"), ntz("LOAD_TIMESTAMP"))


ARRIVALS_SQL = """arrivals AS (SELECT event_id, ts, event_type || CASE event_id % 6 WHEN 0 THEN '_' || strftime(ts, '%Y%m%d')
      WHEN 1 THEN '_' || strftime(ts, '%Y') || '_' || strftime(ts, '%H%M%S') WHEN 2 THEN '_file'
      ELSE '_' || strftime(ts, '%Y%m%d_%H%M%S') END || CASE event_id % 7 WHEN 0 THEN '.zip' WHEN 1 THEN '.parquet'
      WHEN 2 THEN '.json' WHEN 3 THEN '.xlsx' WHEN 4 THEN '.CSV' ELSE '.csv' END AS name FROM events)"""


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, ending = F.col("event_id") % 6, F.col("event_id") % 7
    day, time = F.date_format("ts", "yyyyMMdd"), F.date_format("ts", "HHmmss")
    body = (
        F.when(kind == 0, F.concat(F.lit("_"), day))
        .when(kind == 1, F.concat(F.lit("_"), F.date_format("ts", "yyyy"), F.lit("_"), time))
        .when(kind == 2, F.lit("_file")).otherwise(F.concat(F.lit("_"), day, F.lit("_"), time))
    )
    extension = (
        F.when(ending == 0, ".zip").when(ending == 1, ".parquet").when(ending == 2, ".json").when(ending == 3, ".xlsx")
        .when(ending == 4, ".CSV").otherwise(".csv")
    )
    return inp.table(spark, sf_dir, "events").select("event_id", "ts", F.concat("event_type", body, extension).alias("name"))


@query(
    "arrival_names", "C11 C12 C13",
    f"""WITH {ARRIVALS_SQL}, p AS (SELECT *, regexp_extract(name, '^[^_]+_(\\d{{8}})_(\\d{{6}})\\.', 1) AS d,
        regexp_extract(name, '^[^_]+_(\\d{{8}})_(\\d{{6}})\\.', 2) AS t FROM arrivals)
    SELECT event_id, regexp_matches(name, '^(view|signup|click)_(\\d{{8}})_(\\d{{6}})\\.(csv|zip|parquet|json)$') AS valid,
      strftime(try_strptime(NULLIF(d || t, ''), '%Y%m%d%H%M%S'), '%Y-%m-%d') AS file_date,
      strftime(try_strptime(NULLIF(d || t, ''), '%Y%m%d%H%M%S'), '%H:%M:%S') AS file_time,
      lower(regexp_extract(name, '(\\.[^.]+)$', 1)) IN ('.csv', '.parquet', '.json') AS supported FROM p""",
)
def arrival_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name format for three known datasets, date and time, and supported extensions."""
    name = F.col("name")
    at = filenames.arrival_timestamp(name)
    return arrivals(spark, sf_dir).select(
        "event_id",
        filenames.is_valid_arrival(name, ("view", "signup", "click")).alias("valid"),
        F.date_format(at, "yyyy-MM-dd").alias("file_date"),
        F.date_format(at, "HH:mm:ss").alias("file_time"),
        filenames.is_supported(name).alias("supported"),
    )


@query(
    "expected_file_date", "C14",
    f"""WITH {NAMES_SQL} SELECT event_id, base,
      CASE WHEN fdate = CAST(ts AS DATE) THEN 'SUCCESS' ELSE 'REJECTED' END AS status,
      CASE WHEN fdate = CAST(ts AS DATE) THEN NULL ELSE '000000004' END AS error_no FROM dated""",
)
def expected_file_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = base_names(spark, sf_dir)
    judged = judge_file_dates(files, F.col("base"), F.col("ts").cast("date"))
    return judged.select("event_id", "base", "status", "error_no")


@query(
    "file_date_within_days", "C16",
    f"""WITH {NAMES_SQL}, j AS (SELECT event_id, coalesce(abs(date_diff('day', DATE '2024-01-15', fdate)) <= 10, false) AS ok FROM dated)
    SELECT event_id, CASE WHEN ok THEN 'SUCCESS' ELSE 'REJECTED' END AS status,
      CASE WHEN ok THEN NULL ELSE '000000004' END AS error_no FROM j""",
)
def file_date_within_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = F.lit("2024-01-15").cast("date")
    judged = judge_file_dates(base_names(spark, sf_dir), F.col("base"), expected, tolerance_days=10)
    return judged.select("event_id", "status", "error_no")


@query(
    "registered_file_patterns", "C15",
    f"""WITH {ARRIVALS_SQL}, p AS (SELECT event_id, split_part(name, '_', 1) AS fixed_part,
        regexp_extract(name, '^[^_]+_([^.]*)', 1) AS d FROM arrivals),
      r AS (SELECT *, fixed_part IN ('click', 'view', 'signup') AS registered,
        (fixed_part = 'click' AND (NOT regexp_matches(d, '^\\d{{8}}_\\d{{6}}$') OR try_strptime(d, '%Y%m%d_%H%M%S') IS NULL))
        OR (fixed_part = 'view' AND (NOT regexp_matches(d, '^\\d{{8}}$') OR try_strptime(d, '%Y%m%d') IS NULL)) AS refused FROM p)
    SELECT event_id, fixed_part, registered, CASE WHEN refused THEN 'REJECTED' ELSE 'SUCCESS' END AS status,
      CASE WHEN refused THEN '000000004' END AS error_no FROM r""",
)
def registered_file_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three registered kinds of files: two validated with different date patterns, one not."""
    registry = spark.createDataFrame(
        [("click", "yyyyMMdd_HHmmss", True), ("view", "yyyyMMdd", True), ("signup", "yyyyMMdd", False)],
        "fixed_part string, date_pattern string, validation_required boolean",
    )
    judged = judge_registered_names(arrivals(spark, sf_dir), "name", registry)
    return judged.select("event_id", "fixed_part", "registered", "status", "error_no")
