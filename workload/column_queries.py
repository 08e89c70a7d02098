"""Column operators: presence, completion, transforms, casts, order, final types, dates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import dates
from millrace.names import FILE
from millrace.operators import shape
from millrace.operators.typing import bad_name, raw_name, type_columns
from millrace.rules import TYPE_NAMES, ColumnRule
from millrace.sources.files import source_files
from millrace.sources.rule_tables import normalize_column_rules
from workload import inputs as inp
from workload.archive_and_file_queries import part_rule_cells
from workload.registry import query


@query(
    "missing_columns", "D1",
    f"""WITH {inp.RAW_ORDERS}, files AS (SELECT DISTINCT file FROM raw), m(column_name) AS (VALUES ('o_clerk'), ('o_comment'))
    SELECT 'orders' AS table_name, file AS filename, column_name, 'Missing column: ' || column_name AS error_message,
      CAST(NULL AS VARCHAR) AS raw_value, '000000010' AS error_no, 1 AS error_count FROM files, m""",
)
def missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = inp.raw_orders(spark, sf_dir)
    missing = shape.missing_columns(raw, [*inp.ORDER_COLUMNS, "o_clerk", "o_comment"])
    return shape.presence_errors(source_files(raw), missing, "orders")


@query(
    "mandatory_flags", "D2",
    """SELECT p_brand AS table_name, p_name || '_' || CAST(p_partkey AS VARCHAR) AS column_name,
      CASE WHEN p_partkey % 5 = 0 THEN 'optional' ELSE 'mandatory' END AS requirement FROM part""",
)
def mandatory_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = normalize_column_rules(part_rule_cells(spark, sf_dir))
    return shape.mandatory_flags(rules).select("table_name", "column_name", "requirement")


@query(
    "completed_schema", "D3",
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
      CAST(NULL AS VARCHAR) AS c_phone, CAST(NULL AS VARCHAR) AS c_address FROM customer""",
)
def completed_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = inp.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    return shape.complete_schema(customer, ["c_custkey", "c_name", "c_nationkey", "c_phone", "c_address"])


@query(
    "trimmed_columns", "D4",
    f"""WITH {inp.RAW_ORDERS} SELECT file AS "FILE_NAME_RECEIVED", o_orderkey, trim(o_orderpriority) AS o_orderpriority,
      CAST(length(o_orderpriority) AS INTEGER) AS length_before FROM raw""",
)
def trimmed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = inp.raw_orders(spark, sf_dir).withColumn("length_before", F.length("o_orderpriority"))
    trimmed = shape.trim_columns(raw, [FILE, *inp.ORDER_COLUMNS])
    return trimmed.select(FILE, "o_orderkey", "o_orderpriority", "length_before")


@query(
    "text_transforms", "D5 D6",
    """SELECT c_custkey, upper(c_name) AS c_name, lower(c_mktsegment) AS c_mktsegment,
      regexp_replace(c_name, '^Customer#0*', '', 'g') AS short_name, regexp_replace(c_name, '0+', 'z', 'g') AS zeros
    FROM customer""",
)
def text_transforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upper case, lower case, a pattern deleted (blank replacement) and a pattern replaced."""
    rules = [
        ColumnRule("c_name", 1, "STRING", "uppercase"),
        ColumnRule("c_mktsegment", 2, "STRING", "lowercase"),
        ColumnRule("short_name", 3, "STRING", "regex", "^Customer#0*", None),
        ColumnRule("zeros", 4, "STRING", "regex", "0+", "z"),
    ]
    customer = inp.table(spark, sf_dir, "customer").withColumns({"short_name": F.col("c_name"), "zeros": F.col("c_name")})
    return customer.select("c_custkey", *(shape.transformed(F.col(r.name), r).alias(r.name) for r in rules))


@query(
    "renamed_columns", "D7",
    """SELECT s_suppkey AS "SUPPLIER_CODE", s_name AS "SUPPLIER_LABEL", s_nationkey FROM supplier""",
)
def renamed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = inp.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return shape.rename_columns(supplier, {"s_suppkey": "SUPPLIER_CODE", "s_name": "SUPPLIER_LABEL"})


@query(
    "cast_columns", "D8",
    f"""WITH {inp.RAW_ORDERS} SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, TRY_CAST(o_custkey AS INTEGER) AS o_custkey,
      TRY_CAST(NULLIF(o_totalprice, '') AS DOUBLE) AS o_totalprice FROM raw""",
)
def cast_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = inp.raw_orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_totalprice")
    return shape.cast_columns(raw, {"o_orderkey": "bigint", "o_custkey": "int", "o_totalprice": "double"})


@query(
    "column_order", "D9",
    f"""WITH {inp.RAW_ORDERS} SELECT 1 AS position, 'o_orderpriority' AS column_name, count(o_orderpriority) AS filled FROM raw
    UNION ALL SELECT 2, 'o_orderdate', count(o_orderdate) FROM raw UNION ALL SELECT 3, 'o_totalprice', count(o_totalprice) FROM raw
    UNION ALL SELECT 4, 'o_orderstatus', count(o_orderstatus) FROM raw UNION ALL SELECT 5, 'o_custkey', count(o_custkey) FROM raw
    UNION ALL SELECT 6, 'o_orderkey', count(o_orderkey) FROM raw UNION ALL SELECT 7, 'FILE_NAME_RECEIVED', count(file) FROM raw""",
)
def column_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns by a reversed field order, with the filled cells of each."""
    rules = [ColumnRule(c, -i) for i, c in enumerate(inp.ORDER_COLUMNS)]
    ordered = shape.order_columns(inp.raw_orders(spark, sf_dir), rules)
    counts = ordered.agg(*(F.count(c).alias(c) for c in ordered.columns))
    cells = [part for i, c in enumerate(ordered.columns, 1) for part in (F.lit(i), F.lit(c), F.col(c))]
    return counts.select(F.stack(F.lit(len(ordered.columns)), *cells).alias("position", "column_name", "filled"))


@query(
    "final_schema", "D10",
    f"""WITH {inp.TYPED_ORDERS} SELECT k AS o_orderkey, cust AS o_custkey, trim(o_orderstatus) AS o_orderstatus, price::DOUBLE AS o_totalprice,
      CAST(NULL AS TIMESTAMP) AS o_shipped, trim(o_orderpriority) AS o_orderpriority, file AS "FILE_NAME_RECEIVED" FROM typed""",
)
def final_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text columns rebuilt to their declared types; an absent column is a typed NULL."""
    rules = [
        ColumnRule("o_orderkey", 1, "LONG"), ColumnRule("o_custkey", 2, "INTEGER"), ColumnRule("o_orderstatus", 3),
        ColumnRule("o_totalprice", 4, "DECIMAL(15,2)"), ColumnRule("o_shipped", 5, "DATE"), ColumnRule("o_orderpriority", 6),
    ]
    raw = shape.trim_columns(inp.raw_orders(spark, sf_dir), inp.ORDER_COLUMNS)
    rebuilt = shape.rebuild_typed(raw, rules)
    assert not shape.type_mismatches(rebuilt, rules)
    return rebuilt.withColumns(
        {"o_shipped": F.col("o_shipped").cast("timestamp_ntz"), "o_totalprice": F.col("o_totalprice").cast("double")}
    )


@query(
    "default_when_invalid", "D11",
    f"""WITH {inp.TYPED_ORDERS} SELECT k AS o_orderkey, CASE WHEN bad_cust THEN -1 ELSE cust END AS o_custkey,
      CASE WHEN bad_price THEN 0.01::DOUBLE ELSE price::DOUBLE END AS o_totalprice FROM typed""",
)
def default_when_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = inp.order_rules(
        o_custkey={"default": "-1"}, o_totalprice={"default": "0.01"}, o_orderdate={"action": "LOG_ONLY"}
    )
    typed = type_columns(inp.raw_orders(spark, sf_dir), rules, fill_defaults=True)
    return typed.frame.select("o_orderkey", "o_custkey", F.col("o_totalprice").cast("double").alias("o_totalprice"))


TYPE_SOURCES = {
    "STRING": ("p_name", "p_name"), "INTEGER": ("p_size", "CAST(p_size AS VARCHAR)"),
    "LONG": ("p_partkey", "CAST(p_partkey AS VARCHAR)"), "FLOAT": ("p_size", "CAST(p_size AS VARCHAR)"),
    "DOUBLE": ("p_partkey", "CAST(p_partkey AS VARCHAR)"), "BOOLEAN": ("p_size % 2 = 0", "CAST(p_size % 2 = 0 AS VARCHAR)"),
    "DATE": ("o_orderdate", None), "TIMESTAMP": ("o_orderdate", None), "DECIMAL(10,2)": ("p_size", "CAST(p_size AS VARCHAR)"),
}


@query(
    "declared_types", "D12",
    " UNION ALL ".join(
        f"SELECT '{name}' AS declared, '{'timestamp' if name in ('DATE', 'TIMESTAMP') else TYPE_NAMES.get(name, name.lower())}' AS spark_type, " + ("(SELECT count(*) FILTER (o_orderkey % 9 <> 0) FROM orders) AS typed_cells" if name in ("DATE", "TIMESTAMP") else "(SELECT count(*) FROM part) AS typed_cells")
        for name in TYPE_SOURCES
    ),
)
def declared_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every declared type name, the type its column gets and the cells that fit; every ninth date is none."""
    part = inp.table(spark, sf_dir, "part")
    date = F.when(F.col("o_orderkey") % 9 == 0, "2024-02-30").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    orders = inp.table(spark, sf_dir, "orders").select(date.alias("o_orderdate"))
    result = None
    for rows, names in ((part, [n for n in TYPE_SOURCES if n not in ("DATE", "TIMESTAMP")]), (orders, ["DATE", "TIMESTAMP"])):
        rules = [ColumnRule(f"c{i}", i, name) for i, name in enumerate(names)]
        typed = type_columns(rows.select(*(F.expr(TYPE_SOURCES[r.declared][0]).cast("string").alias(r.name) for r in rules)), rules).frame
        types = dict(typed.dtypes)
        counts = typed.agg(*(F.count(r.name).alias(r.name) for r in rules))
        cells = [cell for r in rules for cell in (F.lit(r.declared), F.lit(types[r.name]), F.col(r.name))]
        counted = counts.select(F.stack(F.lit(len(rules)), *cells).alias("declared", "spark_type", "typed_cells"))
        result = counted if result is None else result.unionByName(counted)
    return result


@query(
    "strict_dates", "E1",
    f"""WITH {inp.TYPED_ORDERS} SELECT k AS o_orderkey, odate AS parsed, bad_date AS invalid FROM typed""",
)
def strict_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = inp.raw_orders(spark, sf_dir)
    parsed = dates.parse_strict(F.col("o_orderdate"), "yyyyMMdd")
    rows = raw.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "o_orderdate", parsed.alias("parsed"))
    invalid = F.col("parsed").isNull() & dates.filled(F.col("o_orderdate")).isNotNull()
    return rows.select("o_orderkey", F.col("parsed").cast("timestamp_ntz").alias("parsed"), invalid.alias("invalid"))


@query(
    "default_date_pattern", "E2",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderdate END AS odate, o_orderkey % 3 = 0 AS invalid FROM orders""",
)
def default_date_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A date rule without a pattern takes the first known one; other notations are invalid."""
    orders = inp.table(spark, sf_dir, "orders")
    text = F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd")
    )
    rule = ColumnRule("odate", 2, "DATE", action="LOG_ONLY")
    typed = type_columns(orders.select("o_orderkey", text.alias("odate")), [rule]).frame
    return typed.select(
        "o_orderkey", F.col("odate").cast("timestamp_ntz").alias("odate"), F.col(bad_name(rule)).alias("invalid")
    )


@query(
    "named_date_patterns", "E3",
    """SELECT o_orderkey, o_orderdate AS iso, CASE WHEN o_orderkey % 10 <> 0 THEN o_orderdate END AS slashed,
      CASE WHEN o_orderkey % 11 <> 0 THEN o_orderdate END AS compact FROM orders""",
)
def named_date_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three notations rules may name, with impossible dates among them."""
    key = F.col("o_orderkey")
    texts = inp.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("iso"),
        F.when(key % 10 == 0, "30/02/2025").otherwise(F.date_format("o_orderdate", "dd/MM/yyyy")).alias("slashed"),
        F.when(key % 11 == 0, "20251345").otherwise(F.date_format("o_orderdate", "yyyyMMdd")).alias("compact"),
    )
    rules = [
        ColumnRule("iso", 1, "DATE", pattern="YYYY-MM-DD", action="LOG_ONLY"),
        ColumnRule("slashed", 2, "DATE", pattern="DD/MM/YYYY", action="LOG_ONLY"),
        ColumnRule("compact", 3, "DATE", pattern="YYYYMMDD", action="LOG_ONLY"),
    ]
    typed = type_columns(texts, rules).frame
    return typed.select("o_orderkey", *(F.col(r.name).cast("timestamp_ntz").alias(r.name) for r in rules))


@query(
    "date_failure_numbers", "E4",
    """WITH t AS (SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN '2025-13-45' WHEN 1 THEN '2025-1-5' WHEN 2 THEN '20250230'
        WHEN 3 THEN '   ' WHEN 4 THEN '2025-02-30' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS odate FROM orders)
    SELECT o_orderkey, odate, CASE WHEN odate IN ('2025-13-45', '2025-02-30') THEN '000000005'
      WHEN odate IN ('2025-1-5', '20250230') THEN '000000004' END AS error_no FROM t""",
)
def date_failure_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Right shape but impossible, wrong shape, blank and valid dates."""
    kind = F.col("o_orderkey") % 6
    text = (
        F.when(kind == 0, "2025-13-45").when(kind == 1, "2025-1-5").when(kind == 2, "20250230").when(kind == 3, "   ")
        .when(kind == 4, "2025-02-30").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    )
    rows = inp.table(spark, sf_dir, "orders").select("o_orderkey", text.alias("odate"))
    rule = ColumnRule("odate", 1, "DATE", pattern="YYYY-MM-DD", action="LOG_ONLY")
    typed = type_columns(rows, [rule], trim=False).frame
    number = F.when(F.col(bad_name(rule)), dates.failure_number(F.col(raw_name(rule)), rule.date_pattern))
    return typed.select("o_orderkey", F.col(raw_name(rule)).alias("odate"), number.alias("error_no"))


@query(
    "invalid_cells", "E5 D3 D4 D8",
    f"""WITH {inp.TYPED_ORDERS} SELECT file AS "FILE_NAME_RECEIVED", k AS o_orderkey, cust AS o_custkey, st AS o_orderstatus,
      price::DOUBLE AS o_totalprice, odate AS o_orderdate, prio AS o_orderpriority, bad_cust, bad_price, bad_date FROM typed""",
)
def invalid_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All typed values and invalid-cell flags of the raw orders."""
    typed = type_columns(inp.raw_orders(spark, sf_dir), inp.ORDER_RULES)
    flags = {"o_custkey": "bad_cust", "o_totalprice": "bad_price", "o_orderdate": "bad_date"}
    shown = {"o_orderdate": "timestamp_ntz", "o_totalprice": "double"}
    values = [F.col(c).cast(shown[c]).alias(c) if c in shown else F.col(c) for c in inp.ORDER_COLUMNS]
    rules = {r.name: r for r in typed.rules}
    return typed.frame.select(FILE, *values, *(F.col(bad_name(rules[c])).alias(a) for c, a in flags.items()))


