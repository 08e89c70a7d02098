"""The corpus pipeline: toxicity, line dedup, near-duplicate documents, benchmark decontamination, mixing.

Each stage takes the documents its predecessor kept, written as Parquet and read
again, and its decisions take effect. All but the last return the columns of
documents; the last adds the words that the mix takes of each document.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm.common import materialize
from millrace.llm.decontamination import decontaminate
from millrace.llm.line_dedup import dedup_lines
from millrace.llm.mixing import mix, turn_weights
from millrace.llm.queries import MAX_EPOCHS, held_out, table
from millrace.llm.simhash import keep_one_per_group
from millrace.llm.toxicity import score_toxicity, train

#: No SQL for the rows of a run: the toxicity scores come from a trained model.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model rejects go; it learns from the labelled rows outside the held-out fold."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = train(docs.where(~held_out(4, 2)).select("doc_id", "text").join(labels, "doc_id"))
    return score_toxicity(docs, model).where("predicted = 0").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicate lines one stays; documents left without text go."""
    return dedup_lines(docs)


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return keep_one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark")).where("not contaminated").select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which the mix takes nothing go; ``taken`` counts words, repeats included."""
    return mix(docs, turn_weights(docs), MAX_EPOCHS).where("taken > 0")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity), ("line_dedup", line_dedup), ("simhash", simhash), ("decontamination", decontamination), ("mixing", mixing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
