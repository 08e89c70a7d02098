"""Sinks: appends, snapshots, upserts, latest load, quarantine and log tables."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.names import FILE, PARTITIONS
from millrace.plans.ingest import ingest_table, run
from millrace.rules import RuleBook, TableRule
from millrace.session import fresh_dir, materialize
from millrace.sinks import ingestion
from millrace.sinks.key_index import KeyIndex
from millrace.sinks.tables import TableStore
from millrace.sources.files import RawScan
from workload import inputs as inp
from workload.archive_and_file_queries import RFC_RULES, RFC_TABLE, rfc_raw
from workload.error_queries import ERROR_COLUMNS, ORDER_ERRORS_SQL
from workload.registry import query
from workload.report_queries import LOG_SQL, PARTS


def store_for(spark: SparkSession) -> TableStore:
    return TableStore(spark, fresh_dir(spark, "store"))


def dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    date = F.col("o_orderdate")
    return inp.table(spark, sf_dir, "orders").withColumns(
        {"yyyy": F.year(date), "mm": F.month(date), "dd": F.dayofmonth(date), FILE: inp.order_file()}
    )


@query(
    "append_with_new_columns", "B1",
    """SELECT yyyy, mm, sum(n)::BIGINT AS row_count, sum(k)::BIGINT AS key_sum, sum(p)::BIGINT AS priorities FROM (
      SELECT year(o_orderdate)::INTEGER AS yyyy, month(o_orderdate)::INTEGER AS mm, count(*) AS n, sum(o_orderkey) AS k,
        count(CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END) AS p FROM orders GROUP BY 1, 2) t GROUP BY 1, 2""",
)
def append_with_new_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends by date; the second brings a column the first does not have."""
    store, orders = store_for(spark), dated_orders(spark, sf_dir)
    store.append("orders", orders.filter("o_orderstatus <> 'O'").select("o_orderkey", *PARTITIONS), ("yyyy", "mm"))
    store.append("orders", orders.filter("o_orderstatus = 'O'").select("o_orderkey", "o_orderpriority", *PARTITIONS), ("yyyy", "mm"))
    return store.read("orders").groupBy("yyyy", "mm").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("o_orderkey").alias("key_sum"), F.count("o_orderpriority").alias("priorities")
    )


@query(
    "append_with_changed_types", "B1",
    """SELECT 'decimal(22,2)' AS price_type, 'string' AS code_type, 'double' AS rate_type, o_orderstatus, count(*) AS row_count,
      sum(CASE WHEN o_orderstatus = 'F' THEN floor(o_totalprice) ELSE CAST(o_totalprice AS DECIMAL(15,2)) END)::DECIMAL(22,2) AS price,
      max(CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey AS VARCHAR) ELSE 'C' || o_custkey END) AS last_code,
      sum(CASE WHEN o_orderstatus = 'F' THEN o_custkey ELSE o_custkey / 2::DOUBLE END)::DOUBLE AS rates FROM orders GROUP BY o_orderstatus""",
)
def append_with_changed_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries with whole prices, then decimal ones; number codes, then text; the table's types take them all."""
    store, orders = store_for(spark), inp.table(spark, sf_dir, "orders")
    key, price = F.col("o_custkey"), F.col("o_totalprice")
    shapes = {
        "F": [F.floor(price).cast("bigint"), key.cast("int"), key.cast("int")],
        "O": [price.cast("decimal(15,2)"), F.concat(F.lit("C"), key.cast("string")), key / F.lit(2.0)],
        "P": [price.cast("decimal(15,2)"), F.concat(F.lit("C"), key.cast("string")), (key / F.lit(2.0)).cast("double")],
    }
    for status, columns in shapes.items():
        rows = orders.filter(F.col("o_orderstatus") == status)
        store.append("orders", rows.select("o_orderstatus", *(c.alias(n) for c, n in zip(columns, ("price", "code", "rate")))), ())
    read = store.read("orders")
    kinds = dict(read.dtypes)
    return read.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("price").cast("decimal(22,2)").alias("price"), F.max("code").alias("last_code"), F.sum("rate").alias("rates")
    ).select(*(F.lit(kinds[c]).alias(f"{c}_type") for c in ("price", "code", "rate")), "*")


@query(
    "full_snapshot_ingest", "B2 B3 B5 B6",
    f"""WITH {inp.VERDICT_ORDERS}, g AS (SELECT file, substr(file, 8, 4)::INTEGER AS yyyy, k FROM good)
    SELECT 'orders_all' AS table_name, file AS "FILE_NAME_RECEIVED", yyyy, count(*) AS row_count, sum(k)::BIGINT AS key_sum FROM g GROUP BY ALL
    UNION ALL SELECT 'orders_last', file, yyyy, count(*), sum(k)::BIGINT FROM g GROUP BY ALL""",
)
def full_snapshot_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole run: the delivery is the table, so history and last table hold all accepted rows, whatever their dates."""
    store = store_for(spark)
    raw = inp.landed_orders(spark, sf_dir)
    ingest_table(raw, inp.ORDER_TABLE, inp.ORDER_RULES, store, inp.RUN_TS)
    counts = lambda name: store.read(name).groupBy(F.lit(name).alias("table_name"), FILE, "yyyy").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("o_orderkey").alias("key_sum")
    )
    return counts("orders_all").unionByName(counts("orders_last"))


@query(
    "merge_ingest", "B2 B4 B5",
    f"""WITH {inp.VERDICT_ORDERS}, once AS (SELECT DISTINCT k, file FROM good)
    SELECT file AS "FILE_NAME_RECEIVED", count(*) AS row_count, sum(k)::BIGINT AS key_sum,
      '20250116' AS loaded_on FROM once GROUP BY file""",
)
def merge_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files delivered twice, with repeated rows: each key stays once, from the second run."""
    store, rule = store_for(spark), TableRule("orders", mode="merge")
    landed = inp.landed_orders(spark, sf_dir, copies=True)
    for day in (0, 1):
        raw = landed.withColumn("FILE_PROCESS_DATE", F.lit(inp.RUN_TS + timedelta(days=day)).cast("timestamp"))
        ingest_table(raw, rule, inp.ORDER_RULES, store, inp.RUN_TS + timedelta(days=day))
    return store.read("orders_all").groupBy(FILE, F.date_format("FILE_PROCESS_DATE", "yyyyMMdd").alias("loaded_on")).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("o_orderkey").alias("key_sum")
    )


@query(
    "ingest_again", "A3 B2 B6",
    f"""WITH {inp.VERDICT_ORDERS} SELECT file AS "FILE_NAME_RECEIVED", CASE WHEN file LIKE '%000000' THEN '20250115' ELSE '20250116' END AS loaded_on,
      count(*) AS row_count, sum(k)::BIGINT AS key_sum FROM good GROUP BY file""",
)
def ingest_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the files, then all of them, then all again: each file is in the history once, from the first run that saw it."""
    store, rule = store_for(spark), TableRule("orders")
    landed = inp.landed_orders(spark, sf_dir)
    for day, raw in enumerate([landed.filter(F.col(FILE).endswith("000000")), landed, landed]):
        ingest_table(raw, rule, inp.ORDER_RULES, store, inp.RUN_TS + timedelta(days=day))
    runs = store.read("execution_log").select(F.col("filename").alias(FILE), F.date_format("log_ts", "yyyyMMdd").alias("loaded_on")).distinct()
    counts = store.read("orders_all").groupBy(FILE).agg(F.count(F.lit(1)).alias("row_count"), F.sum("o_orderkey").alias("key_sum"))
    return counts.join(runs, FILE)


@query(
    "late_delivery", "B3 B5",
    f"""WITH {inp.VERDICT_ORDERS}, g AS (SELECT * FROM good WHERE substr(file, 8, 4)::INTEGER >= 1998)
    SELECT file AS "FILE_NAME_RECEIVED", count(*) AS row_count, sum(k)::BIGINT AS key_sum FROM g GROUP BY file""",
)
def late_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full snapshot of several dates, then a late delivery of older files: the last table stays what the snapshot made it."""
    store, landed = store_for(spark), inp.landed_orders(spark, sf_dir)
    year = F.substring(FILE, 8, 4).cast("int")
    for day, raw in enumerate([landed.filter(year >= 1998), landed.filter(year < 1998)]):
        ingest_table(raw, inp.ORDER_TABLE, inp.ORDER_RULES, store, inp.RUN_TS + timedelta(days=day))
    return store.read("orders_last").groupBy(FILE).agg(F.count(F.lit(1)).alias("row_count"), F.sum("o_orderkey").alias("key_sum"))


@query(
    "merge_upsert", "B4",
    """SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'F' THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders
    UNION ALL SELECT o_orderkey + 1000000000, o_custkey, 'N' FROM orders WHERE o_orderpriority = '1-URGENT'""",
)
def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished orders are updated, urgent ones give new keys; nothing is repeated."""
    orders = inp.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    urgent = inp.table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'")
    changed = orders.filter("o_orderstatus = 'F'").withColumn("o_orderstatus", F.lit("X"))
    new = urgent.select((F.col("o_orderkey") + 1000000000).alias("o_orderkey"), "o_custkey", F.lit("N").alias("o_orderstatus"))
    return ingestion.merge_upsert(orders, changed.unionByName(new), ["o_orderkey"])


@query(
    "latest_load", "B5",
    """SELECT event_id, event_type FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)""",
)
def latest_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inp.table(spark, sf_dir, "events")
    dated = events.withColumns({"yyyy": F.year("ts"), "mm": F.month("ts"), "dd": F.dayofmonth("ts")})
    return ingestion.latest_load(dated).select("event_id", "event_type")


@query(
    "history_partitions", "B6",
    """SELECT year(o_orderdate)::INTEGER AS yyyy, CASE WHEN year(o_orderdate) >= 2000 THEN 2 ELSE 1 END AS delivery, count(*) AS row_count,
      sum(o_orderkey)::BIGINT AS key_sum FROM orders GROUP BY 1, 2""",
)
def history_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivering some dates again replaces only their partitions."""
    store, orders = store_for(spark), dated_orders(spark, sf_dir).select("o_orderkey", *PARTITIONS)
    store.overwrite_partitions("orders", orders.withColumn("delivery", F.lit(1)), ("yyyy",))
    store.overwrite_partitions("orders", orders.filter("yyyy >= 2000").withColumn("delivery", F.lit(2)), ("yyyy",))
    return store.read("orders").groupBy("yyyy", "delivery").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("o_orderkey").alias("key_sum")
    )


@query(
    "snapshot_history", "B8",
    """SELECT 1 AS snapshot_id, TIMESTAMP '2025-01-15 10:30:00' AS snapshot_ts, count(*) AS row_count FROM customer
    UNION ALL SELECT 2, TIMESTAMP '2025-01-16 10:30:00', count(*) FROM customer WHERE c_acctbal > 0
    UNION ALL SELECT 3, TIMESTAMP '2025-01-17 10:30:00', count(*) FROM customer WHERE c_mktsegment = 'BUILDING'""",
)
def snapshot_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three replacements are three snapshots with a time, each still readable."""
    store, customer = store_for(spark), inp.table(spark, sf_dir, "customer")
    for day, rows in enumerate([customer, customer.filter("c_acctbal > 0"), customer.filter("c_mktsegment = 'BUILDING'")]):
        store.replace("customer", rows, inp.RUN_TS + timedelta(days=day))
    result = None
    for number, at in store.snapshots("customer"):
        row = store.read("customer", number).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(number).alias("snapshot_id"), F.lit(at).cast("timestamp_ntz").alias("snapshot_ts"), "row_count"
        )
        result = row if result is None else result.unionByName(row)
    return result


@query(
    "snapshot_changes", "B8 B4",
    """SELECT 'merged' AS kind, CASE WHEN o_orderpriority = '1-URGENT' AND o_orderkey % 20 = 0 THEN 'inserted' ELSE 'updated' END AS change,
      CASE WHEN o_orderpriority = '1-URGENT' AND o_orderkey % 20 = 0 THEN o_orderkey + 1000000000 ELSE o_orderkey END AS o_orderkey,
      CASE WHEN o_orderpriority = '1-URGENT' AND o_orderkey % 20 = 0 THEN 'N' ELSE 'X' END AS o_orderstatus
    FROM orders WHERE (o_orderpriority = '1-URGENT' AND o_orderkey % 20 = 0) OR (o_orderpriority <> '1-URGENT' AND o_orderkey % 50 = 0 AND o_orderstatus <> 'X')
    UNION ALL SELECT 'replaced', CASE WHEN o_orderstatus = 'P' THEN 'deleted' ELSE 'updated' END, o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'P' ELSE 'G' END
    FROM orders WHERE o_orderstatus = 'P' OR (o_orderstatus = 'F' AND o_orderkey % 10 = 0)""",
)
def snapshot_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a merge and a replacement changed, between the snapshots of two days found by time."""
    store, day = store_for(spark), timedelta(days=1)
    orders = inp.table(spark, sf_dir, "orders")
    key, rows = F.col("o_orderkey"), orders.select("o_orderkey", "o_orderstatus")
    new = orders.filter((F.col("o_orderpriority") == "1-URGENT") & (key % 20 == 0)).select((key + 1000000000).alias("o_orderkey"), F.lit("N").alias("o_orderstatus"))
    changed = orders.filter((F.col("o_orderpriority") != "1-URGENT") & (key % 50 == 0)).select("o_orderkey", F.lit("X").alias("o_orderstatus"))
    store.merge("merged", rows, ["o_orderkey"], inp.RUN_TS, ())
    store.merge("merged", changed.unionByName(new), ["o_orderkey"], inp.RUN_TS + day, ())
    store.replace("replaced", rows, inp.RUN_TS)
    later = F.when((F.col("o_orderstatus") == "F") & (key % 10 == 0), "G").otherwise(F.col("o_orderstatus"))
    store.replace("replaced", rows.filter("o_orderstatus <> 'P'").withColumn("o_orderstatus", later), inp.RUN_TS + day)

    def between(name: str) -> DataFrame:
        before, after = (store.snapshot_at(name, inp.RUN_TS + n * day + timedelta(hours=1)) for n in (0, 1))
        return store.changes(name, ["o_orderkey"], before, after).withColumn("kind", F.lit(name))

    return between("merged").unionByName(between("replaced"))


@query(
    "snapshot_as_of", "B8",
    """SELECT 'first' AS moment, count(*) AS row_count, sum(c_custkey)::BIGINT AS key_sum FROM customer
    UNION ALL SELECT 'later', count(*), sum(c_custkey)::BIGINT FROM customer WHERE c_acctbal > 0""",
)
def snapshot_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table as it was at two moments between its snapshots."""
    store, customer = store_for(spark), inp.table(spark, sf_dir, "customer")
    for hours, rows in enumerate((customer, customer.filter("c_acctbal > 0"), customer.filter("c_acctbal > 5000"))):
        store.replace("customer", rows, inp.RUN_TS + timedelta(hours=2 * hours))
    read = {m: store.read_as_of("customer", inp.RUN_TS + timedelta(hours=h)) for m, h in (("first", 1), ("later", 2))}
    first, later = (
        df.agg(F.count(F.lit(1)).alias("row_count"), F.sum("c_custkey").alias("key_sum")).select(F.lit(m).alias("moment"), "*") for m, df in read.items()
    )
    return first.unionByName(later)


@query(
    "baseline_snapshot", "B9",
    """SELECT o_orderstatus, count(*) AS row_count, sum(o_orderkey)::BIGINT AS key_sum FROM orders GROUP BY 1""",
)
def baseline_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = store_for(spark)
    name = ingestion.save_baseline(store, inp.table(spark, sf_dir, "orders"), "orders", inp.RUN_TS)
    return store.read(name).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("o_orderkey").alias("key_sum")
    )


@query(
    "quarantined_rows", "B10",
    f"""WITH {inp.VERDICT_ORDERS} SELECT r.file AS "FILE_NAME_RECEIVED", attempt_ts, o_orderkey, o_custkey, o_totalprice
    FROM raw r JOIN verdict v USING (file), (VALUES ('20250115_103000'), ('20250116_103000')) a(attempt_ts) WHERE v.status = 'REJECTED'""",
)
def quarantined_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows of refused files; a second attempt stands beside the first."""
    store, raw = store_for(spark), inp.raw_orders(spark, sf_dir)
    verdict = inp.judged_orders(spark, sf_dir).verdict
    for day in (0, 1):
        ingestion.quarantine(store, raw, verdict, "orders", inp.RUN_TS + timedelta(days=day))
    return store.read("quarantine").select(FILE, "attempt_ts", "o_orderkey", "o_custkey", "o_totalprice")


@query(
    "quarantine_errors", "B10 G1",
    f"""WITH {inp.VERDICT_ORDERS} SELECT 'orders' AS table_name, file AS filename, 'filename' AS column_name,
      'Column ''' || failing || ''': RLK tolerance exceeded: ' || printf('%.2f', ratio * 100) || '% > 10.00%' AS error_message, file AS raw_value,
      '000000009' AS error_no, 1 AS error_count FROM verdict WHERE status = 'REJECTED'""",
)
def quarantine_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingestion.quarantine_errors(inp.judged_orders(spark, sf_dir).verdict, "orders")


@query(
    "written_execution_log", "B11 B1",
    f"""{PARTS}, {LOG_SQL} SELECT table_name, filename, input_format, ingestion_mode, row_count, error_count, error_message, error_no,
      status, yyyy, mm, dd FROM log
    UNION ALL SELECT 'clients', 'clients_20250101_' || lpad(CAST(c_nationkey % 5 AS VARCHAR), 6, '0'), 'staging', '', count(*),
      count(*) FILTER (c_custkey % 10 = 0), CAST(count(*) FILTER (c_custkey % 10 = 0) AS VARCHAR) || ' errors', NULL, 'SUCCESS', 2025, 1, 15 FROM customer GROUP BY 2""",
)
def written_execution_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run over two raw tables and one that is absent, seen through its log table."""
    store = store_for(spark)
    clients = materialize(rfc_raw(spark, sf_dir), "raw")
    scans = {
        "orders": RawScan("READY", inp.landed_orders(spark, sf_dir)),
        "refunds": RawScan("ABSENT"),
        "clients": RawScan("READY", clients),
    }
    book = RuleBook(
        (inp.ORDER_TABLE, TableRule("refunds"), RFC_TABLE), {"orders": inp.ORDER_RULES, "clients": RFC_RULES}
    )
    run(spark, book, store, inp.RUN_TS, scan=lambda rule: scans[rule.name])
    log = store.read("execution_log")
    return log.select(
        "table_name", "filename", "input_format", "ingestion_mode", "row_count", "error_count", "error_message", "error_no",
        "status", "yyyy", "mm", "dd",
    )


@query(
    "written_quality_errors", "B12 B1",
    f"WITH {inp.VERDICT_ORDERS}, {ORDER_ERRORS_SQL} SELECT {ERROR_COLUMNS}, 'internal' AS zone, 2025 AS yyyy, 1 AS mm, 15 AS dd FROM errors",
)
def written_quality_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = store_for(spark)
    errors = inp.judged_orders(spark, sf_dir).errors(["o_orderkey"])
    ingestion.write_quality_errors(store, errors, "internal", F.lit(inp.RUN_TS).cast("timestamp"))
    return store.read("quality_errors").drop("log_ts")


KEY_LOADS = {"load_1": (0, 1994), "load_2": (1995, 1996), "load_3": (1997, 9999)}


@query(
    "keys_repeated_in_history", "E18 B4",
    """WITH t AS (SELECT l_orderkey, l_linenumber, CASE WHEN year(l_shipdate) <= 1994 THEN 'load_1' WHEN year(l_shipdate) <= 1996 THEN 'load_2' ELSE 'load_3' END AS load
        FROM lineitem),
      c AS (SELECT l_orderkey, l_linenumber, load, count(*) AS row_count FROM t GROUP BY ALL),
      f AS (SELECT *, min(load) OVER (PARTITION BY l_orderkey, l_linenumber) AS first_seen FROM c)
    SELECT load, l_orderkey, l_linenumber, row_count, CASE WHEN first_seen < load THEN first_seen END AS first_load FROM f
    WHERE row_count > 1 OR first_seen < load""",
)
def keys_repeated_in_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items in three loads by ship date: keys that a load repeats, within itself or from any load before."""
    store, items = store_for(spark), inp.table(spark, sf_dir, "lineitem")
    index = KeyIndex(store, "lineitem", ["l_orderkey", "l_linenumber"])
    result = None
    for load, (first, last) in KEY_LOADS.items():
        found = index.register(items.filter(F.year("l_shipdate").between(first, last)), load).select(F.lit(load).alias("load"), "*")
        store.finish(load)
        result = found if result is None else result.unionByName(found)
    return result


@query(
    "tables_of_a_run_at_once", "A13 F8",
    f"""WITH {inp.VERDICT_ORDERS}, t AS (SELECT substr(file, 8, 4)::INTEGER AS year, count(*) AS row_count, sum(k)::BIGINT AS key_sum FROM good GROUP BY 1)
    SELECT 'orders_' || year AS table_name, row_count, key_sum FROM t""",
)
def tables_of_a_run_at_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each year of orders as a table of one run; four load at a time, and each counts in its turn."""
    store, landed = store_for(spark), inp.landed_orders(spark, sf_dir)
    year = F.substring(FILE, 8, 4)
    names = sorted(f"orders_{r[0]}" for r in landed.select(year).distinct().collect())  # one a table
    book = RuleBook(tuple(TableRule(n, mode="full_snapshot") for n in names), {n: inp.ORDER_RULES for n in names})
    run(spark, book, store, inp.RUN_TS, scan=lambda rule: RawScan("READY", landed.filter(year == rule.name[-4:])), fail_fast_percent=None)
    loaded = [n for n in names if store.exists(f"{n}_all")]
    result = None
    for name in loaded:
        counts = store.read(f"{name}_all").agg(F.count(F.lit(1)).alias("row_count"), F.sum("o_orderkey").alias("key_sum"))
        counts = counts.select(F.lit(name).alias("table_name"), "*")
        result = counts if result is None else result.unionByName(counts)
    return result
