"""Manifests against trees built by hand, proofs that fail for changed rows, odd rows."""

import hashlib

import pytest
from pyspark.sql import functions as F

from millrace.llm.merkle import as_text, fold, joined_digest, manifest, record_digest, siblings

SCHEMA = "doc_id bigint, lang string, text string, row string, path string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(leaves):
    """The root and, for each leaf, its path: siblings ('' for none) with their side."""
    paths, at, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        for i, place in enumerate(at):
            other = place ^ 1
            paths[i].append((-1 if place % 2 else 1, level[other]) if other < len(level) else (0, ""))
            at[i] = place // 2
        level = [h(*level[k : k + 2]) for k in range(0, len(level), 2)]
    return level[0], paths


def record(*values):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def brute(rows):
    """(leaf, subroot, root, proof) of each row, sorted."""
    trees = {}
    for r in rows:
        trees.setdefault(r[1], []).append(((r[0] is not None, r[0] or 0), record(*r[:3])))
    names = sorted(trees, key=lambda name: (name is not None, (name or "").encode()))
    built = {name: tree([leaf for _, leaf in sorted(trees[name])]) for name in names}
    root, above = tree([built[name][0] for name in names])
    found = []
    for name, rest in zip(names, above):
        for (_, leaf), path in zip(sorted(trees[name]), built[name][1]):
            found.append((leaf, built[name][0], root, h(*(d for _, d in path + rest)), tuple(path + rest)))
    return sorted(found, key=str)


def run(spark, rows):
    docs = spark.createDataFrame([(*r, "r", "p") for r in rows], SCHEMA)
    return manifest(docs.withColumn("leaf", record_digest([F.col("doc_id"), F.col("lang"), F.col("text")])))


def found(result):
    rows = result.select(
        as_text(F.col("leaf")).alias("leaf"), as_text(F.col("subroot")).alias("subroot"), as_text(F.col("root")).alias("root"),
        joined_digest(siblings(F.col("path"))).alias("proof"),
        F.transform("path", lambda s: F.struct(s["side"].alias("side"), F.coalesce(as_text(s["digest"]), F.lit("")).alias("digest"))).alias("steps"),
    ).collect()
    return sorted(((*r[:4], tuple((s["side"], s["digest"]) for s in r["steps"])) for r in rows), key=str)


@pytest.mark.parametrize("sizes", [(1,), (2,), (3, 1), (5, 8, 1, 2), (257, 256, 511), (700, 1, 16, 17)])
def test_against_trees_by_hand(spark, sizes):
    names = [None, "", "de", "é", "z", "\U0001F600", "漢"]
    rows = [(7 * k % 1009, name, f"text {k}") for name, size in zip(names, sizes) for k in range(size)]
    assert found(run(spark, rows)) == brute(rows)


def test_a_tree_of_three_rounds_and_hot_language(spark):
    docs = spark.range(70_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 10 == 0, F.lit("b")).otherwise(F.lit("a")).alias("lang"),
        F.concat(F.lit("t"), "id").alias("text"), F.lit("r").alias("row"), F.lit("p").alias("path"),
    )
    result = manifest(docs.withColumn("leaf", record_digest([F.col("doc_id"), F.col("lang"), F.col("text")])))
    rows = [(i, "b" if i % 10 == 0 else "a", f"t{i}") for i in range(70_000)]
    right = {leaf: (subroot, root, proof) for leaf, subroot, root, proof, _ in brute(rows)}
    got = result.select(
        as_text(F.col("leaf")).alias("leaf"), as_text(F.col("subroot")).alias("s"), as_text(F.col("root")).alias("r"), joined_digest(siblings(F.col("path"))).alias("p")
    ).collect()
    assert {r["leaf"]: (r["s"], r["r"], r["p"]) for r in got} == right


def test_changed_rows_fail(spark):
    rows = [(k, "ab"[k % 2], f"text {k}") for k in range(21)]
    result = run(spark, rows).withColumn("shown", F.when(F.col("doc_id") == 4, record_digest([F.lit("other")])).otherwise(F.col("leaf")))
    judged = result.select("doc_id", (fold(F.col("shown"), F.col("path")) == F.col("root")).alias("ok")).collect()
    assert {r["doc_id"] for r in judged if not r["ok"]} == {4}


def test_odd_rows(spark):
    rows = [(1, "a", "x"), (1, "a", "x"), (1, "a", "y"), (None, "a", "z"), (None, "a", None), (2, None, ""), (None, None, None), (3, "b", "w " * 60_000)]
    result = run(spark, rows)
    assert found(result) == brute(rows)
    assert {r["row"] for r in result.collect()} == {"r"} and len({c.lower() for c in result.columns}) == len(result.columns)
    empty = run(spark, rows).limit(0)
    assert manifest(empty.select("doc_id", "lang", "leaf")).collect() == []
    no_leaf = spark.createDataFrame([(1, "a", None)], "doc_id bigint, lang string, leaf binary")
    assert bytes(manifest(no_leaf).first()["root"]) == b""
