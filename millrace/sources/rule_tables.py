"""Rule tables: blank cells become NULL, texts become typed rule columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.tolerances import is_valid_tolerance
from millrace.names import col
from millrace.rules import ACTIONS, ColumnRule, RuleBook, TableRule

# Cell texts that mean "nothing given", and defaults of absent cells.
BLANK_TEXTS = ("", "nan", "none", "null")
TRUE_TEXTS = ("true", "1", "yes", "y")
FALSE_TEXTS = ("false", "0", "no", "n")
DEFAULT_ACTION = "ICT_DRIVEN"
DEFAULT_FILE_TOLERANCE = "10%"
DEFAULT_COLUMN_TOLERANCE = "20%"


def cell(df: DataFrame, name: str) -> Column:
    """Trimmed text of a rule cell; NULL when blank or when the column is absent."""
    if name not in df.columns:
        return F.lit(None).cast("string")
    text = F.trim(col(name).cast("string"))
    return F.when(F.lower(text).isin(*BLANK_TEXTS), None).otherwise(text)


def as_bool(text: Column, default: bool) -> Column:
    word = F.lower(text)
    return F.when(word.isin(*TRUE_TEXTS), True).when(word.isin(*FALSE_TEXTS), False).otherwise(default)


def normalize_column_rules(df: DataFrame) -> DataFrame:
    order = cell(df, "Field Order").try_cast("double").try_cast("int")
    return df.select(
        cell(df, "Delta Table Name").alias("table_name"),
        cell(df, "Column Name").alias("column_name"),
        F.coalesce(order, F.lit(0)).alias("field_order"),
        F.upper(F.coalesce(cell(df, "Field type"), F.lit("STRING"))).alias("field_type"),
        F.lower(cell(df, "Transformation Type")).alias("transformation"),
        cell(df, "Transformation pattern").alias("pattern"),
        cell(df, "Regex replacement").alias("replacement"),
        as_bool(cell(df, "Is Nullable"), False).alias("is_nullable"),
        F.upper(F.coalesce(cell(df, "Error action"), F.lit(DEFAULT_ACTION))).alias("error_action"),
        F.coalesce(F.lower(cell(df, "Is Special")) == "ismergekey", F.lit(False)).alias("is_merge_key"),
        cell(df, "Default when invalid").alias("default_value"),
    )


def normalize_table_rules(df: DataFrame, global_tolerance: str | None = None) -> DataFrame:
    tolerance = global_tolerance or DEFAULT_FILE_TOLERANCE
    return df.select(
        cell(df, "Delta Table Name").alias("table_name"),
        F.lower(F.coalesce(cell(df, "Input Format"), F.lit("csv"))).alias("input_format"),
        F.lower(F.coalesce(cell(df, "Output Zone"), F.lit("internal"))).alias("output_zone"),
        F.lower(F.coalesce(cell(df, "Ingestion Mode"), F.lit(""))).alias("ingestion_mode"),
        F.lower(cell(df, "Last Table Name")).alias("last_table"),
        as_bool(cell(df, "Trim"), True).alias("trim"),
        F.coalesce(cell(df, "Rejected line per file tolerance"), F.lit(tolerance)).alias("file_tolerance"),
        F.coalesce(cell(df, "Invalid column per line tolerance"), F.lit(DEFAULT_COLUMN_TOLERANCE)).alias(
            "column_tolerance"
        ),
    )


def rule_errors(table_rules: DataFrame, column_rules: DataFrame) -> DataFrame:
    """Error rows for unreadable tolerances and unknown actions in normalized rules."""
    tolerances = table_rules.select(
        "table_name",
        F.explode(
            F.array(
                F.struct(F.lit("Rejected line per file tolerance").alias("c"), F.col("file_tolerance").alias("v")),
                F.struct(F.lit("Invalid column per line tolerance").alias("c"), F.col("column_tolerance").alias("v")),
            )
        ).alias("t"),
    ).filter(~is_valid_tolerance(F.col("t.v")))
    bad_tolerances = tolerances.select(
        "table_name",
        F.col("t.c").alias("column_name"),
        F.concat(F.lit("Invalid tolerance: "), F.col("t.v")).alias("error_message"),
        F.col("t.v").alias("raw_value"),
    )
    bad_actions = column_rules.filter(~F.col("error_action").isin(*ACTIONS)).select(
        "table_name",
        "column_name",
        F.concat(F.lit("Unknown error action: "), F.col("error_action")).alias("error_message"),
        F.col("error_action").alias("raw_value"),
    )
    return bad_tolerances.unionByName(bad_actions).withColumn("error_count", F.lit(1))


class ColumnRules(Mapping):
    """Column rules by table, read when they are asked for: the rules of one table at a time."""

    def __init__(self, normalized: DataFrame):
        self.normalized = normalized

    def __getitem__(self, table: str) -> tuple[ColumnRule, ...]:
        rows = self.normalized.filter(F.col("table_name") == table).collect()
        if not rows:
            raise KeyError(table)
        return tuple(
            ColumnRule(
                name=row.column_name, order=row.field_order, declared=row.field_type, transform=row.transformation,
                pattern=row.pattern, replacement=row.replacement, nullable=row.is_nullable, action=row.error_action,
                merge_key=row.is_merge_key, default=row.default_value,
            )
            for row in rows
        )

    def __iter__(self):
        return (row.table_name for row in self.normalized.select("table_name").distinct().toLocalIterator())

    def __len__(self) -> int:
        return self.normalized.select("table_name").distinct().count()


def rule_book(table_rules: DataFrame, column_rules: DataFrame) -> RuleBook:
    """Rules of all tables from the two rule tables as they were delivered.

    The first table row gives the tolerance of tables that have none.
    """
    first = table_rules.select(cell(table_rules, "Rejected line per file tolerance").alias("t")).first()
    tables = normalize_table_rules(table_rules, first.t if first else None).toLocalIterator()
    return RuleBook(
        tables=tuple(
            TableRule(
                name=row.table_name, input_format=row.input_format, zone=row.output_zone, mode=row.ingestion_mode,
                last_table=row.last_table, trim=row.trim, file_tolerance=row.file_tolerance,
            )
            for row in tables
        ),
        columns=ColumnRules(normalize_column_rules(column_rules)),
    )


def load_rules(spark: SparkSession, table_path: str, column_path: str, fmt: str = "csv") -> RuleBook:
    """Rule book from two CSV or JSON files. Every cell is read as text."""
    def read(path: str) -> DataFrame:
        if fmt == "json":
            return spark.read.option("primitivesAsString", True).option("multiLine", True).json(path)
        return spark.read.option("header", True).option("escape", '"').csv(path)

    return rule_book(read(table_path), read(column_path))
