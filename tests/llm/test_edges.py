"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names, for every operator."""

import hashlib

import pytest
from pyspark.sql import functions as F

from millrace.llm import ctph, langid, pii, toxicity
from millrace.llm.decontamination import decontaminate
from millrace.llm.line_dedup import count_lines, dedup_lines
from millrace.llm.mixing import mix
from millrace.llm.simhash import keep_one_per_group, simhash_components
from millrace.llm.urls import judge_urls
from millrace.llm.warc import archive_and_read

DOCS = "doc_id bigint, text string, source string, row string, size string, key string, component_id string"
LONG = "word " * 30_000


def extra(*values):
    return (*values, "r", "s", "k", "c")


ROWS = [
    extra(1, "One line here.\nAnother line there.", "a"),
    extra(1, "One line here.\nAnother line there.", "a"),
    extra(2, "", "a"), extra(3, None, None), extra(None, "No id on this one.", "b"), extra(None, None, None),
    extra(4, LONG, "b"), extra(5, "   \n\n\t", "b"), extra(6, "ü é 漢字 \U0001F600", None),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS)


@pytest.fixture(scope="module")
def model():
    bad = [f"you {w} go away now." for w in ("dunce", "oaf") for _ in range(40)]
    return toxicity.fit(bad, ["what a fine and quiet day it is."] * 80)


def rules(spark):
    return spark.sql("SELECT 'com' AS host, '/' AS path, 'block' AS verdict")


def benchmark(spark):
    return spark.createDataFrame([(1, "One line here another"), (2, None), (None, "word " * 12), (3, "")], "item_id bigint, text string")


def weights(spark):
    return spark.createDataFrame([("a", 5), (None, 2)], "source string, weight int")


def operators(spark, model):
    return {
        "lines": count_lines, "cut": dedup_lines, "mix": lambda d: mix(d, weights(spark)), "ctph": ctph.fingerprint_edits,
        "simhash": simhash_components, "groups": keep_one_per_group, "leaks": lambda d: decontaminate(d, benchmark(spark)),
        "toxic": lambda d: toxicity.score_toxicity(d, model), "language": lambda d: langid.identify(d, langid.train(d.withColumn("lang", F.lit("x")))),
        "pii": lambda d: pii.find_personal_data(d, pii.fit([])), "urls": lambda d: judge_urls(d, rules(spark), url="text"),
        "warc": lambda d: archive_and_read(d.withColumn("url", F.lit(None).cast("string")), page_id="doc_id", html="text"),
    }


@pytest.mark.parametrize("name", ["lines", "cut", "mix", "ctph", "simhash", "groups", "leaks", "toxic", "language", "pii", "urls", "warc"])
def test_odd_rows_and_empty_tables(spark, docs, model, name):
    run = operators(spark, model)[name]
    found = run(docs)
    assert len({c.lower() for c in found.columns}) == len(found.columns)
    rows = found.collect()
    if name == "groups":
        assert len(rows) < len(ROWS)
    elif name != "cut":
        assert len(rows) == len(ROWS)
    if name not in ("lines", "warc"):
        assert set(docs.columns) <= set(found.columns)
        assert all(r["row"] == "r" for r in rows)
    empty = run(docs.limit(0))
    assert empty.columns == found.columns and empty.collect() == []


def test_results_of_odd_rows(spark, docs, model):
    mixed = {(r["doc_id"], r["source"]): (r["size"], r["taken"]) for r in mix(docs, weights(spark)).collect()}
    assert mixed[2, "a"] == (0, 0) and mixed[3, None] == (0, 0) and mixed[4, "b"] == (30_000, 0)  # source b has no weight
    prints = {r["text"]: r["fingerprint"] for r in simhash_components(docs).collect()}
    assert prints[None] == prints[""] == prints["   \n\n\t"] == "0" * 16
    leaks = decontaminate(docs, benchmark(spark)).where("doc_id = 4").first()
    assert leaks["n_hit"] == 30_000 and leaks["contaminated"] and leaks["n_items"] == 0  # the hit item has no id
    assert leaks["items_sha256"] == hashlib.sha256(b"").hexdigest()
    languages = {r["text"]: r["lang_pred"] for r in langid.identify(docs, None).collect()}
    assert set(languages.values()) == {"und"}
    scores = {r["text"]: r["score"] for r in toxicity.score_toxicity(docs, model).collect()}
    assert scores[None] == scores[""] < 0.3
    kept = {r["doc_id"] for r in dedup_lines(docs).where("doc_id is not null").collect()}
    assert kept == {1, 2, 3, 4, 5, 6}  # rows that repeat id and text stay alike; blank texts are never emptied


def test_clashing_names_keep_the_result(spark):
    odd = spark.createDataFrame([("http://a.com/x", "mine", "h")], "url string, verdict string, host string")
    row = judge_urls(odd, rules(spark)).first()
    assert (row["host"], row["verdict"]) == ("a.com", "block")
