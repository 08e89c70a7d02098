"""Registered queries: each applies one operator to its whole table and derives the agreed columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import queries_sql as sql
from millrace.llm.ctph import fingerprint_edits
from millrace.llm.decontamination import decontaminate
from millrace.llm.langid import identify, train as train_languages
from millrace.llm.line_dedup import count_lines
from millrace.llm.merkle import as_text, fold, joined_digest, manifest, record_digest, siblings
from millrace.llm.mixing import mix, turn_weights
from millrace.llm.pii import KINDS, find_personal_data, train as train_personal_data
from millrace.llm.secret_scan import BASE_KINDS, find_secrets
from millrace.llm.simhash import simhash_components
from millrace.llm.toxicity import score_toxicity, train as train_toxicity
from millrace.llm.urls import judge_urls
from millrace.llm.warc import archive_and_read
from millrace.llm.whitening import whiten

#: Rules of the URL query: host, path, verdict.
URL_RULES = """
    VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
           ('net', '/es/', 'block'), ('net', '/fr/', 'block') AS rules(host, path, verdict)
"""
MAX_EPOCHS = 3


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def held_out(folds: int, fold: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % folds == fold


def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return count_lines(table(spark, folder, "documents"))


def op2_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return mix(docs, turn_weights(docs), MAX_EPOCHS).select("doc_id", "size", "source_size", "target", "taken")


def op3_warc_records(spark: SparkSession, folder: str) -> DataFrame:
    return archive_and_read(table(spark, folder, "pages"))


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text").withColumn("held_out", held_out(4, 2))
    labels = table(spark, folder, "labels").select("doc_id", "toxic")
    model = train_toxicity(docs.where(~F.col("held_out")).join(labels, "doc_id"))
    return score_toxicity(docs, model).drop("text")


def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.sql(f"SELECT * FROM {URL_RULES}")
    return judge_urls(table(spark, folder, "pages").select("page_id", "url"), rules).drop("url")


def op6_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint_edits(table(spark, folder, "documents"), carry=["doc_id"])


def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_components(table(spark, folder, "documents"), carry=["doc_id"])


def op8_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang").withColumn("held_out", held_out(3, 1))
    model = train_languages(docs.where(~F.col("held_out")))
    return identify(docs, model).select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op9_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "benchmark"))
    return found.drop("text")


def op10_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = find_personal_data(docs, train_personal_data(docs)).select("doc_id", "personal_data")
    base = F.filter("personal_data", lambda s: s["base"] == 1)

    def number(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select("doc_id", *map(number, KINDS), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("personal_data")).alias("spans"))


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten(table(spark, folder, "embeddings").select("vec_id", "embedding"), carry=["vec_id"])


def op12_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    more = (F.col("n_chars").cast("decimal(38,0)") + 1).cast("string")
    claimed = F.when(held_out(7, 0), record_digest([F.col("doc_id"), F.col("source"), F.col("lang"), more, F.col("text")]))
    leaf = record_digest([F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")])
    proved = manifest(docs.select("doc_id", "lang", leaf.alias("leaf"), claimed.alias("claimed")))
    return proved.select("*", fold(F.coalesce("claimed", "leaf"), F.col("path")).alias("folded")).select(
        "doc_id", as_text(F.col("leaf")).alias("leaf"), as_text(F.col("subroot")).alias("subroot"), as_text(F.col("root")).alias("root"),
        joined_digest(siblings(F.col("path"))).alias("proof_sha256"), as_text(F.col("folded")).alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


def op13_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = find_secrets(table(spark, folder, "documents").select("doc_id", "text"), carry=["doc_id"])
    base = F.filter("secrets", lambda s: s["base"] == 1)

    def number(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select("doc_id", *map(number, BASE_KINDS), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"))


QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "op1_line_dedup": (op1_line_dedup, None),
    "op2_mix_sources": (op2_mix_sources, sql.MIX),
    "op3_warc_records": (op3_warc_records, sql.WARC),
    "op4_toxicity": (op4_toxicity, None),
    "op5_url_filter": (op5_url_filter, sql.URLS),
    "op6_fingerprints": (op6_fingerprints, None),
    "op7_simhash": (op7_simhash, None),
    "op8_language": (op8_language, None),
    "op9_decontaminate": (op9_decontaminate, sql.DECONTAMINATION),
    "op10_personal_data": (op10_personal_data, None),
    "op11_whitening": (op11_whitening, None),
    "op12_manifest": (op12_manifest, sql.MANIFEST),
    "op13_secrets": (op13_secrets, None),
}
