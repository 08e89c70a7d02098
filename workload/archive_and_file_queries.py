"""Sources: archives, incremental loads, delimited, JSON, Parquet and flat files."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from datetime import datetime, timedelta

from millrace.functions import filenames
from millrace.names import CORRUPT, FILE
from millrace.operators.error_rows import bad_values, table_errors
from millrace.operators.metrics import load_messages
from millrace.plans.ingest import judge
from millrace.plans.landing import land_archives
from millrace.rules import ColumnRule, TableRule
from millrace.session import fresh_dir, materialize
from millrace.sinks.tables import TableStore
from millrace.sources import archives as arc
from millrace.sources import files as src
from millrace.sources.rule_tables import normalize_column_rules, normalize_table_rules, rule_errors
from millrace.sources.split_csv import read_csv_split
from millrace.sources.storage import create_file
from millrace.streaming.loader import file_stream, load_large_files, load_new_files, process_new_files
from millrace.streaming.partial_files import PART_SIGN, judge_parts, mark_stream, part_stream, verdicts_of_parts
from millrace.streaming.repeated_files import load_once
from workload import inputs as inp
from workload.registry import QUERIES, query


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw orders as CSV lines with archive and member names: one archive per year."""
    raw = inp.raw_orders(spark, sf_dir)
    line = F.concat_ws(",", *(F.coalesce(F.col(c), F.lit("")) for c in inp.ORDER_COLUMNS))
    return raw.select(
        F.concat(F.split_part(F.col(FILE), F.lit("_"), F.lit(2)), F.lit(".zip")).alias("archive"),
        F.concat(F.col(FILE), F.lit(".csv")).alias("member"),
        line.alias("line"),
    )


@query(
    "archive_expansion", "A1 C1",
    f"""WITH {inp.RAW_ORDERS} SELECT file AS "FILE_NAME_RECEIVED", count(*) AS row_count,
      count(*) FILTER (o_totalprice = 'abc') AS bad_prices, sum(CAST(o_orderkey AS BIGINT))::BIGINT AS key_sum
    FROM raw GROUP BY file""",
)
def archive_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_dir(spark, "archives")
    inp.write_archives(order_lines(spark, sf_dir), folder)
    expanded = materialize(arc.expand_archives(arc.archives(spark, folder)), "expanded")
    rows = arc.records_as_csv(arc.sound_records(expanded), inp.ORDER_COLUMNS, header=False)
    named = rows.withColumn(FILE, filenames.received_name(F.col("path")))
    return named.groupBy(FILE).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("o_totalprice") == "abc").alias("bad_prices"),
        F.sum(F.col("o_orderkey").cast("bigint")).alias("key_sum"),
    )


@query(
    "landing_run", "A1 A2 A13 C14",
    f"""WITH {inp.RAW_ORDERS} SELECT file AS "FILE_NAME_RECEIVED", CASE WHEN file LIKE '%000000' THEN 1 ELSE 2 END AS landed_by_run, count(*) AS row_count,
      count(*) FILTER (o_totalprice = 'abc') AS bad_prices, sum(CAST(o_orderkey AS BIGINT))::BIGINT AS key_sum, count(*) AS logged_rows
    FROM raw GROUP BY file""",
)
def landing_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives with header lines land in two waves and three runs: each is taken once, rows are counted exactly."""
    folder, store = fresh_dir(spark, "landing"), TableStore(spark, fresh_dir(spark, "store"))
    lines = order_lines(spark, sf_dir).withColumn("archive", F.concat(F.split_part("member", F.lit("."), F.lit(1)), F.lit(".zip")))
    header = lines.select("archive", "member").distinct().withColumn("line", F.lit(",".join(inp.ORDER_COLUMNS)))
    whole = header.withColumn("at", F.lit(0)).unionByName(lines.withColumn("at", F.lit(1)))
    early = F.col("member").contains("_000000.")
    for number, wave in enumerate([whole.filter(early), whole.filter(~early), None]):
        if wave is not None:
            inp.write_archives(wave, f"{folder}/{number}", "at")
        land_archives(spark, folder, {"orders": inp.ORDER_COLUMNS}, store, inp.RUN_TS + timedelta(days=number))
    log = store.read("landing_log").select(F.col("filename").alias(FILE), F.col("row_count").alias("logged_rows"))
    run = F.datediff(F.col("FILE_PROCESS_DATE"), F.lit(inp.RUN_TS.date())) + 1
    rows = store.read("orders_raw").groupBy(FILE, run.alias("landed_by_run")).agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(F.col("o_totalprice") == "abc").alias("bad_prices"), F.sum(F.col("o_orderkey").cast("bigint")).alias("key_sum")
    )
    return rows.join(log, FILE)


@query(
    "damaged_archives", "A2",
    """WITH years AS (SELECT DISTINCT year(o_orderdate) AS y FROM orders), n AS (SELECT count(*) AS n FROM years)
    SELECT 'sound' AS kind, n AS archives, (SELECT count(*) FROM orders) AS line_count FROM n
    UNION ALL SELECT 'corrupt or invalid archive', n, 0 FROM n
    UNION ALL SELECT 'archive not found: file does not exist', n, 0 FROM n""",
)
def damaged_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_dir(spark, "archives")
    inp.write_archives(order_lines(spark, sf_dir), folder)

    def damage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = []
            for path in batch.column("archive").to_pylist():
                with arc.open_file(path) as whole:
                    content = whole.read()
                target = f"{folder}/damaged/{os.path.basename(path)}"
                middle = len(content) // 2
                with create_file(target) as broken:
                    broken.write(content[:middle] + bytes(64) + content[middle + 64:])
                paths.append(target)
            yield pa.RecordBatch.from_pydict({"archive": pa.array(paths, pa.string())})

    sound = materialize(arc.archives(spark, folder), "sound")
    damaged = materialize(sound.mapInArrow(damage, "archive string"), "damaged")
    absent = sound.select(F.concat("archive", F.lit(".gone")).alias("archive"))
    expanded = materialize(arc.expand_archives(sound.unionByName(damaged).unionByName(absent)), "expanded")
    lines = arc.sound_records(expanded).groupBy("archive").agg(F.count(F.lit(1)).alias("n"))
    failed = arc.expanded_errors(expanded).select(F.col("error").alias("kind"), F.lit(0).cast("bigint").alias("n"))
    return (
        lines.select(F.lit("sound").alias("kind"), "n").unionByName(failed)
        .groupBy("kind").agg(F.count(F.lit(1)).alias("archives"), F.sum("n").alias("line_count"))
    )


@query(
    "incremental_csv_load", "A3 C1 C5 C7 C8",
    f"""WITH {inp.RAW_ORDERS} SELECT file AS "FILE_NAME_RECEIVED", CAST(substr(file, 8, 4) AS INTEGER) AS yyyy,
      1 AS mm, 1 AS dd, CASE WHEN file LIKE '%000000' THEN 1 ELSE 2 END AS loaded_by_run, count(*) AS row_count,
      count(*) FILTER (o_totalprice = 'abc') AS bad_prices
    FROM raw GROUP BY file""",
)
def incremental_csv_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two waves of files and three runs: each file is loaded once, by the first run that sees it."""
    folder, target, state = (fresh_dir(spark, n) for n in ("landing", "raw", "checkpoint"))
    raw = inp.raw_orders(spark, sf_dir)
    staged = raw.select(FILE, *(F.coalesce(F.col(c), F.lit("")).alias(c) for c in inp.ORDER_COLUMNS))
    waves = [staged.filter(F.col(FILE).endswith("000000")), staged.filter(~F.col(FILE).endswith("000000"))]
    for number, wave in enumerate([*waves, None]):
        if wave is not None:
            inp.write_named_files(wave, FILE, f"{folder}/{number}", "csv", header=True, quoteAll=True)
        stream = file_stream(
            spark, f"{folder}/*", "csv", inp.ORDER_COLUMNS, run_ts=inp.RUN_TS + timedelta(days=number)
        )
        load_new_files(stream, target, state)
    loaded = spark.read.parquet(target)
    run = F.datediff(F.col("FILE_PROCESS_DATE"), F.lit(inp.RUN_TS.date())) + 1
    return loaded.groupBy(FILE, "yyyy", "mm", "dd", run.alias("loaded_by_run")).agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(F.col("o_totalprice") == "abc").alias("bad_prices")
    )


@query(
    "parquet_stream_load", "A4",
    """SELECT 'events' AS "FILE_NAME_RECEIVED", event_type, count(*) AS row_count, sum(event_id)::BIGINT AS id_sum,
      min(ts) AS first_ts, max(ts) AS last_ts FROM events GROUP BY event_type""",
)
def parquet_stream_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schema taken from the files; columns keep their stored types."""
    inp.table(spark, sf_dir, "events")
    target, state = fresh_dir(spark, "raw"), fresh_dir(spark, "checkpoint")
    stream = file_stream(spark, sf_dir, "parquet", run_ts=inp.RUN_TS, glob="events.parquet")
    load_new_files(stream, target, state)
    return spark.read.parquet(target).groupBy(FILE, "event_type").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("event_id").alias("id_sum"),
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
    )


@query(
    "json_load", "A5",
    """SELECT event_type, count(*) AS row_count, sum(CAST(json_extract_string(props, '$.k') AS BIGINT))::BIGINT AS k_sum,
      sum(user_id)::BIGINT AS user_sum FROM events GROUP BY event_type""",
)
def json_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON lines, read back as all-text raw rows; nested JSON stays a text."""
    folder = fresh_dir(spark, "json")
    inp.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "props").write.json(folder)
    raw = src.read_json(spark, folder, ["event_id", "user_id", "event_type", "props"])
    return raw.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(F.get_json_object("props", "$.k").cast("bigint")).alias("k_sum"),
        F.sum(F.col("user_id").cast("bigint")).alias("user_sum"),
    )


@query(
    "direct_files", "A6",
    """SELECT 'customer' AS table_name, count(*) AS row_count, sum(c_custkey)::BIGINT AS key_sum FROM customer
    UNION ALL SELECT 'supplier', count(*), sum(s_suppkey)::BIGINT FROM supplier""",
)
def direct_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two plain CSV files without an archive, loaded as two tables."""
    folder, target = fresh_dir(spark, "landing"), fresh_dir(spark, "tables")
    customer = inp.table(spark, sf_dir, "customer").select(
        F.lit("customer_20250101_000000").alias("file"), F.col("c_custkey").cast("string").alias("key"), F.col("c_name").alias("name")
    )
    supplier = inp.table(spark, sf_dir, "supplier").select(
        F.lit("supplier_20250101_000000").alias("file"), F.col("s_suppkey").cast("string").alias("key"), F.col("s_name").alias("name")
    )
    inp.write_named_files(customer.unionByName(supplier), "file", folder, "csv", header=True)
    raw = src.read_csv_by_name(spark, f"{folder}/*.csv", ["key", "name"])
    named = src.with_file_metadata(raw, F.col("path"), inp.RUN_TS).drop("path")
    named.withColumn("table_name", src.table_of_file(F.col(FILE))).write.partitionBy("table_name").parquet(target)
    return spark.read.parquet(target).groupBy("table_name").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(F.col("key").cast("bigint")).alias("key_sum")
    )


@query(
    "headers_by_name", "A6 D1",
    """SELECT 'customer_' || (c_custkey % 3) AS kind, count(*) AS row_count, sum(c_custkey)::BIGINT AS key_sum,
      count(*) FILTER (c_custkey % 3 <> 2) AS names, max(CASE WHEN c_custkey % 3 <> 2 THEN c_name END) AS last_name,
      CASE WHEN c_custkey % 3 = 2 THEN 'name' END AS missing FROM customer GROUP BY c_custkey % 3""",
)
def headers_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose headers are in order, reordered and short: values go by name, a missing column is reported per file."""
    folder = fresh_dir(spark, "headers")
    rows = inp.table(spark, sf_dir, "customer").select((F.col("c_custkey") % 3).alias("kind"), F.col("c_custkey").cast("string").alias("key"), F.col("c_name").alias("name"))
    for kind, columns in enumerate((["key", "name"], ["name", "key"], ["key"])):
        mine = rows.filter(F.col("kind") == kind).select(F.lit(f"customer_{kind}").alias("file"), *columns)
        inp.write_named_files(mine, "file", f"{folder}/{kind}", "csv", header=True)
    wanted = ["key", "name"]
    kind = filenames.received_name(F.col("path")).alias("kind")
    read = src.read_csv_by_name(spark, f"{folder}/*/*.csv", wanted).groupBy(kind).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(F.col("key").cast("bigint")).alias("key_sum"), F.count("name").alias("names"), F.max("name").alias("last_name")
    )
    missing = src.missing_by_file(src.file_headers(spark, f"{folder}/*/*.csv"), wanted).select(kind, F.col("column_name").alias("missing"))
    return read.join(missing, "kind", "left")


@query(
    "flat_file_inventory", "A7",
    """WITH kinds AS (SELECT source, 'doc_' || source || CASE CAST(substr(source, 4) AS INTEGER) % 3
        WHEN 0 THEN '.tif' WHEN 1 THEN '.xml' ELSE '.json' END AS name, text FROM documents)
    SELECT regexp_extract(name, '(\\.[^.]+)$', 1) AS extension, count(DISTINCT name) AS files,
      sum(octet_length(encode(text)) + 1)::BIGINT AS bytes FROM kinds GROUP BY 1""",
)
def flat_file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as flat files, one per source; counted and measured without reading them."""
    folder = fresh_dir(spark, "flat")
    kind = F.substring("source", 4, 9).cast("int") % 3
    ending = F.when(kind == 0, ".tif").when(kind == 1, ".xml").otherwise(".json")
    docs = inp.table(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc_"), F.col("source"), ending).alias("name"), F.col("text")
    )
    staged = fresh_dir(spark, "staged")
    inp.write_named_files(docs, "name", staged, "text")
    fs, _ = src.hadoop_path(spark, staged)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(path(folder))
    for found in fs.globStatus(path(f"{staged}/*.text")):
        fs.rename(found.getPath(), path(f"{folder}/{found.getPath().getName()[:-5]}"))
    stored = fresh_dir(spark, "flat-table")
    src.flat_files(spark, folder).write.parquet(stored)
    return src.flat_inventory(spark.read.parquet(stored))


RFC_RULES = (ColumnRule("custkey", 1, "LONG"), ColumnRule("label", 2, "STRING"))
RFC_TABLE = TableRule("clients", file_tolerance="100%")
RFC_FILES = "'clients_20250101_' || lpad(CAST(c_nationkey % 5 AS VARCHAR), 6, '0')"


def rfc_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as CSV lines: every tenth label holds a bare delimiter, every tenth a quoted one, every tenth a quoted line break."""
    key = F.col("c_custkey")
    label = (
        F.when(key % 10 == 0, F.concat("c_name", F.lit(","), "c_mktsegment"))
        .when(key % 10 == 1, F.concat(F.lit('"'), "c_name", F.lit(","), "c_mktsegment", F.lit('"')))
        .when(key % 10 == 2, F.concat(F.lit('"'), "c_name", F.lit("\n"), "c_mktsegment", F.lit('"')))
        .otherwise(F.col("c_name"))
    )
    name = F.concat(F.lit("clients_20250101_"), F.lpad((F.col("c_nationkey") % 5).cast("string"), 6, "0"))
    return inp.table(spark, sf_dir, "customer").select(
        name.alias("file"), F.concat(key.cast("string"), F.lit(","), label).alias("value")
    )


def rfc_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = fresh_dir(spark, "rfc")
    inp.write_named_files(rfc_lines(spark, sf_dir), "file", staged, "text")
    raw = src.read_csv(spark, f"{staged}/*.text", ["custkey", "label"], header=False)
    return src.with_file_metadata(raw, F.col("_metadata.file_path"), inp.RUN_TS, ("text",))


@query(
    "rfc4180_lines", "A8 H9 E16",
    f"""SELECT {RFC_FILES} AS "FILE_NAME_RECEIVED", 'SUCCESS' AS status,
      CAST(count(*) FILTER (c_custkey % 10 <> 0) AS VARCHAR) || ' rows integrated, '
        || CAST(count(*) FILTER (c_custkey % 10 = 0) AS VARCHAR) || ' rejected' AS load_message
    FROM customer GROUP BY 1""",
)
def rfc4180_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_messages(judge(rfc_raw(spark, sf_dir), RFC_TABLE, RFC_RULES).verdict)


@query(
    "rfc4180_errors", "A8 B12 G1",
    f"""WITH lines AS (SELECT {RFC_FILES} AS filename, CAST(c_custkey AS VARCHAR) || ',' || c_name || ',' || c_mktsegment AS raw_value
        FROM customer WHERE c_custkey % 10 = 0)
    SELECT 'clients' AS table_name, filename, '_corrupt_record' AS column_name, 'RFC 4180 non-compliance' AS error_message,
      raw_value, '000000007' AS error_no, 1 AS error_count FROM lines""",
)
def rfc4180_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(materialize(rfc_raw(spark, sf_dir), "raw"), RFC_TABLE, RFC_RULES)
    values = materialize(bad_values(judged.typed), "bad-values")
    return table_errors(values, judged.verdict, judged.typed, judged.rule)


#: Small, so that the files of the given tables are cut as large files are.
SPLIT_BYTES = 4096


def split_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = fresh_dir(spark, "rfc")
    inp.write_named_files(rfc_lines(spark, sf_dir), "file", staged, "text")
    raw = read_csv_split(spark, f"{staged}/*.text", ["custkey", "label"], header=False, range_bytes=SPLIT_BYTES)
    return src.with_file_metadata(raw, F.col("path"), inp.RUN_TS, ("text",))


@query("split_file_lines", "A8 A3 H9 E16", QUERIES["rfc4180_lines"].sql)
def split_file_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files read in byte ranges whose borders cut quoted line breaks."""
    return load_messages(judge(split_raw(spark, sf_dir), RFC_TABLE, RFC_RULES).verdict)


@query(
    "split_file_cells", "A8 A6 A3",
    """SELECT l_orderkey % 7 AS part, count(*) AS row_count, sum(l_linenumber)::BIGINT AS line_sum, count(*) FILTER (l_linenumber % 3 = 0) AS broken,
      max(CASE l_linenumber % 3 WHEN 0 THEN l_partkey::VARCHAR || chr(10) || '"' || l_returnflag || '", ' || l_linestatus
        WHEN 1 THEN l_partkey::VARCHAR || ',' || l_returnflag ELSE l_partkey::VARCHAR END) AS last_note
    FROM lineitem GROUP BY 1""",
)
def split_file_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines in files with a header, loaded by a file stream that reads them in ranges; notes hold delimiters, quotes and line breaks."""
    folder, target, state = (fresh_dir(spark, n) for n in ("landing", "tables", "checkpoint"))
    part = F.col("l_partkey").cast("string")
    note = (
        F.when(F.col("l_linenumber") % 3 == 0, F.concat(part, F.lit('\n"'), "l_returnflag", F.lit('", '), "l_linestatus"))
        .when(F.col("l_linenumber") % 3 == 1, F.concat(part, F.lit(","), "l_returnflag")).otherwise(part)
    )
    rows = inp.table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") % 7).cast("string").alias("part"), F.col("l_linenumber").cast("string").alias("line"), note.alias("note")
    )
    rows.write.option("header", True).option("quoteAll", True).option("escape", '"').option("maxRecordsPerFile", 50_000).csv(folder)
    load_large_files(spark, folder, target, state, ["part", "line", "note"], run_ts=inp.RUN_TS, range_bytes=1 << 18)
    return spark.read.parquet(target).groupBy(F.col("part").cast("bigint").alias("part")).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(F.col("line").cast("bigint")).alias("line_sum"),
        F.count_if(F.contains("note", F.lit("\n"))).alias("broken"), F.max("note").alias("last_note"),
    )


@query(
    "raw_scan_status", "A9",
    """SELECT 'orders' AS table_name, 'READY' AS scan_status, count(*) AS row_count FROM orders
    UNION ALL SELECT 'events', 'READY', count(*) FROM events
    UNION ALL SELECT 'refunds', 'EMPTY', count(*) FROM orders WHERE o_totalprice < 0
    UNION ALL SELECT 'returns', 'ABSENT', 0""",
)
def raw_scan_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan of four raw tables: two filled, one empty, one never created."""
    orders = inp.table(spark, sf_dir, "orders")
    orders.createOrReplaceTempView("orders_raw")
    orders.filter("o_totalprice < 0").createOrReplaceTempView("refunds_raw")
    inp.table(spark, sf_dir, "events").createOrReplaceTempView("events_raw")
    result = None
    for name in ("orders", "events", "refunds", "returns"):
        found = src.scan_raw(spark, f"{name}_raw")
        counted = (found.frame if found.frame is not None else spark.range(0)).agg(F.count(F.lit(1)).alias("row_count"))
        row = counted.select(F.lit(name).alias("table_name"), F.lit(found.status).alias("scan_status"), "row_count")
        result = row if result is None else result.unionByName(row)
    return result


PART_RULES_SQL = """CASE p_partkey % 7 WHEN 0 THEN 'nan' WHEN 1 THEN '' WHEN 2 THEN 'None' WHEN 3 THEN 'null'
      WHEN 4 THEN 'reject' WHEN 5 THEN ' log_only ' ELSE 'IGNORE' END"""


def part_rule_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule cells from parts, with every blank form."""
    key = F.col("p_partkey")
    action = (
        F.when(key % 7 == 0, "nan").when(key % 7 == 1, "").when(key % 7 == 2, "None").when(key % 7 == 3, "null")
        .when(key % 7 == 4, "reject").when(key % 7 == 5, " log_only ").otherwise("IGNORE")
    )
    return inp.table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("Delta Table Name"),
        F.concat("p_name", F.lit("_"), key.cast("string")).alias("Column Name"),
        F.col("p_size").cast("string").alias("Field Order"),
        F.when(key % 3 == 0, "NaN").otherwise(F.lit("date")).alias("Field type"),
        F.when(key % 2 == 0, "UPPERCASE").otherwise(F.lit(" ")).alias("Transformation Type"),
        F.when(key % 4 == 0, "yyyyMMdd").alias("Transformation pattern"),
        F.when(key % 5 == 0, "True").when(key % 5 == 1, "no").alias("Is Nullable"),
        action.alias("Error action"),
        F.when(key % 6 == 0, "isMergeKey").otherwise("none").alias("Is Special"),
    )


@query(
    "rule_cells_normalized", "A10 E8",
    f"""WITH c AS (SELECT *, {PART_RULES_SQL} AS a FROM part)
    SELECT p_brand AS table_name, p_name || '_' || CAST(p_partkey AS VARCHAR) AS column_name, p_size AS field_order,
      CASE WHEN p_partkey % 3 = 0 THEN 'STRING' ELSE 'DATE' END AS field_type,
      CASE WHEN p_partkey % 2 = 0 THEN 'uppercase' END AS transformation,
      CASE WHEN p_partkey % 4 = 0 THEN 'yyyyMMdd' END AS pattern, CAST(NULL AS VARCHAR) AS replacement,
      p_partkey % 5 = 0 AS is_nullable,
      CASE WHEN lower(trim(a)) IN ('', 'nan', 'none', 'null') THEN 'ICT_DRIVEN' ELSE upper(trim(a)) END AS error_action,
      p_partkey % 6 = 0 AS is_merge_key, CAST(NULL AS VARCHAR) AS default_value FROM c""",
)
def rule_cells_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_column_rules(part_rule_cells(spark, sf_dir))


@query(
    "rule_problems", "A10 F4",
    f"""WITH c AS (SELECT *, {PART_RULES_SQL} AS a,
        CASE p_partkey % 4 WHEN 0 THEN 'abc%' WHEN 1 THEN '5' WHEN 2 THEN '2.5%' ELSE '' END AS tol FROM part)
    SELECT p_brand AS table_name, 'Rejected line per file tolerance' AS column_name, 'Invalid tolerance: abc%' AS error_message,
      'abc%' AS raw_value, 1 AS error_count FROM c WHERE tol = 'abc%'
    UNION ALL SELECT p_brand, p_name || '_' || CAST(p_partkey AS VARCHAR), 'Unknown error action: IGNORE', 'IGNORE', 1
    FROM c WHERE a = 'IGNORE'""",
)
def rule_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    tables = inp.table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("Delta Table Name"),
        F.when(key % 4 == 0, "abc%").when(key % 4 == 1, "5").when(key % 4 == 2, "2.5%").otherwise("").alias(
            "Rejected line per file tolerance"
        ),
    )
    return rule_errors(normalize_table_rules(tables), normalize_column_rules(part_rule_cells(spark, sf_dir)))


@query(
    "source_file_names", "A11 A12 G8",
    f"""WITH {inp.RAW_ORDERS} SELECT 'orders' AS table_name, file AS "FILE_NAME_RECEIVED", count(*) AS total_rows FROM raw GROUP BY file
    UNION ALL SELECT 'customer', 'AUTO_LOADER_BATCH', count(*) FROM customer""",
)
def source_file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files and rows of a raw table; rows without a file name form one batch."""
    named = src.source_files(inp.raw_orders(spark, sf_dir)).withColumn("table_name", F.lit("orders"))
    unnamed = src.source_files(inp.table(spark, sf_dir, "customer")).withColumn("table_name", F.lit("customer"))
    return named.unionByName(unnamed)


@query(
    "many_tables_at_once", "A13",
    """SELECT 'nation' AS table_name, count(*) AS row_count, sum(n_nationkey)::BIGINT AS key_sum FROM nation
    UNION ALL SELECT 'region', count(*), sum(r_regionkey)::BIGINT FROM region
    UNION ALL SELECT 'part', count(*), sum(p_partkey)::BIGINT FROM part
    UNION ALL SELECT 'customer', count(*), sum(c_custkey)::BIGINT FROM customer
    UNION ALL SELECT 'supplier', count(*), sum(s_suppkey)::BIGINT FROM supplier""",
)
def many_tables_at_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five tables in archives that hold a share of each, expanded and written as five tables by one job."""
    batches = max(2, inp.table(spark, sf_dir, "customer").count() // 500)
    sources = {"nation": "n_nationkey", "region": "r_regionkey", "part": "p_partkey", "customer": "c_custkey", "supplier": "s_suppkey"}
    lines = None
    for name, key in sources.items():
        rows = inp.table(spark, sf_dir, name).select(
            F.concat(F.lit("batch"), F.pmod(F.col(key), F.lit(batches)).cast("string"), F.lit(".zip")).alias("archive"), F.lit(f"{name}_20250101_000000.csv").alias("member"),
            F.concat(F.col(key).cast("string"), F.lit(","), F.col(f"{name[0]}_name")).alias("line"),
        )
        lines = rows if lines is None else lines.unionByName(rows)
    folder, target = fresh_dir(spark, "archives"), fresh_dir(spark, "tables")
    inp.write_archives(lines, folder)
    expanded = materialize(arc.expand_archives(arc.archives(spark, folder)), "expanded")
    rows = arc.records_as_csv(arc.sound_records(expanded), ["key", "name"], header=False)
    named = src.with_file_metadata(rows, F.col("path"), inp.RUN_TS).drop("path", CORRUPT)
    named.withColumn("table_name", src.table_of_file(F.col(FILE))).write.partitionBy("table_name").parquet(target)
    return spark.read.parquet(target).groupBy("table_name").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(F.col("key").cast("bigint")).alias("key_sum")
    )


@query(
    "stream_file_verdicts", "A3 E12",
    f"""WITH {inp.VERDICT_ORDERS} SELECT file AS "FILE_NAME_RECEIVED", total AS total_rows, status,
      accepted AS accepted_rows FROM verdict""",
)
def stream_file_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New files judged batch by batch as they arrive: a file is whole within its batch."""
    folder, target, state = (fresh_dir(spark, n) for n in ("landing", "verdicts", "checkpoint"))
    staged = inp.raw_orders(spark, sf_dir)
    inp.write_named_files(staged, FILE, folder, "csv", header=True, quoteAll=True, emptyValue="", nullValue="")
    stream = file_stream(spark, folder, "csv", inp.ORDER_COLUMNS, run_ts=inp.RUN_TS, files_per_batch=8)

    def handle(batch: DataFrame, number: int) -> None:
        verdict = judge(batch, inp.ORDER_TABLE, inp.ORDER_RULES).verdict
        verdict.write.mode("overwrite").parquet(f"{target}/batch={number}")

    process_new_files(stream, handle, state)
    return spark.read.parquet(target).select(FILE, "total_rows", "status", "accepted_rows")


@query(
    "verdicts_of_file_parts", "A3 E12",
    f"""WITH {inp.VERDICT_ORDERS} SELECT file AS "FILE_NAME_RECEIVED", total AS total_rows, status, accepted AS accepted_rows, 'COMPLETE' AS reason FROM verdict""",
)
def verdicts_of_file_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders delivered in interleaved parts over several batches: a file is judged once its mark says that it is whole."""
    folder, marks, target, state = (fresh_dir(spark, n) for n in ("landing", "marks", "verdicts", "checkpoint"))
    raw = inp.raw_orders(spark, sf_dir)
    piece = F.pmod(F.xxhash64("o_orderkey"), F.lit(3)).cast("string")
    parts = raw.withColumn("part", F.concat(F.col(FILE), F.lit(PART_SIGN), piece)).drop(FILE)
    inp.write_named_files(parts, "part", folder, "csv", header=True, quoteAll=True, emptyValue="", nullValue="")
    raw.groupBy(F.col(FILE).alias("file")).agg(F.count(F.lit(1)).alias("expected")).write.option("header", True).csv(marks)
    rows = part_stream(spark, folder, inp.ORDER_COLUMNS, run_ts=inp.RUN_TS, files_per_batch=12)
    verdicts = verdicts_of_parts(rows, mark_stream(spark, marks), inp.ORDER_TABLE, inp.ORDER_RULES, timeout_ms=3_600_000)
    judge_parts(verdicts.select(FILE, "total_rows", "status", "accepted_rows", "reason"), target, state)
    return spark.read.parquet(target)


def send_again(spark: SparkSession, files: list[str], old: str, new: str) -> None:
    """The same bytes under other names, copied by the file system."""
    fs, _ = src.hadoop_path(spark, files[0])
    path, jvm = spark._jvm.org.apache.hadoop.fs.Path, spark._jvm.org.apache.hadoop.fs
    for name in files:
        jvm.FileUtil.copy(fs, path(name), fs, path(name.replace(old, new)), False, spark._jsc.hadoopConfiguration())


@query(
    "repeated_deliveries", "A3 C16",
    """WITH f AS (SELECT strftime(o_orderdate, '%Y%m') AS month, count(*) AS n FROM orders GROUP BY 1),
      d AS (SELECT *, date_diff('day', strptime(month || '01', '%Y%m%d')::DATE, DATE '2001-08-31') > 1461 AS late,
        date_diff('day', strptime(month || '02', '%Y%m%d')::DATE, DATE '2001-08-31') > 1461 AS late_again FROM f)
    SELECT 'orders_' || month || '01.csv' AS "FILE_NAME_RECEIVED", CASE WHEN late THEN 'LATE' ELSE 'NEW' END AS status, CAST(NULL AS VARCHAR) AS first_file,
      CASE WHEN late THEN 0 ELSE n END AS loaded_rows FROM d
    UNION ALL SELECT 'orders_' || month || '02.csv', CASE WHEN late_again THEN 'LATE' WHEN late THEN 'NEW' ELSE 'REPEATED' END,
      CASE WHEN NOT late THEN 'orders_' || month || '01.csv' END, CASE WHEN late AND NOT late_again THEN n ELSE 0 END FROM d""",
)
def repeated_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file of orders a month, all sent again under another name in a second run: content counts once, late files are logged only."""
    folder, target, log, state = (fresh_dir(spark, n) for n in ("landing", "rows", "log", "checkpoint"))
    month = F.concat(F.lit("orders_"), F.date_format("o_orderdate", "yyyyMM"), F.lit("01"))
    orders = inp.table(spark, sf_dir, "orders").select(month.alias(FILE), *(F.col(c).cast("string").alias(c) for c in inp.ORDER_COLUMNS))
    files = inp.write_named_files(orders, FILE, folder, "csv", header=True)
    options = {"window": timedelta(days=30), "days": 1461, "run_ts": datetime(2001, 8, 31), "files_per_batch": 50}
    load_once(spark, folder, target, log, state, inp.ORDER_COLUMNS, **options)
    send_again(spark, files, "01.csv", "02.csv")
    load_once(spark, folder, target, log, state, inp.ORDER_COLUMNS, **options)
    loaded = spark.read.parquet(target).groupBy(F.concat(F.col(FILE), F.lit(".csv")).alias(FILE)).agg(F.count(F.lit(1)).alias("loaded_rows"))
    logged = spark.read.parquet(log).select(FILE, "status", "first_file").join(loaded, FILE, "left")
    return logged.select(FILE, "status", "first_file", F.coalesce("loaded_rows", F.lit(0)).cast("bigint").alias("loaded_rows"))
