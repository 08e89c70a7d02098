"""The pipeline's stages against brute-force versions on a small corpus with planted cases."""

import random
import re
from collections import defaultdict

import pytest

import corpus_pipeline
from test_free import brute_simhash
from test_native import brute_lines

WORDS = [f"{a}{b}{c}" for a in ("stel", "bor", "gan", "mir") for b in ("a", "o", "u") for c in ("den", "rik", "sol", "tam", "wex")]
INSULTS = ["blockhead", "numskull", "dimwit"]


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(60)) for _ in range(n)) + "."


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(11)
    items = [(k, sentence(rng, 20)) for k in range(5)]
    docs, labels = [], []
    for k in range(240):
        lines = [sentence(rng, rng.randrange(8, 30)) for _ in range(rng.randrange(2, 6))]
        toxic = k % 4 == 0
        if toxic:
            lines[0] = f"you {rng.choice(INSULTS)} {lines[0]}"
        if k % 10 == 1:
            lines.insert(1, f"see {items[k % 5][1]} there")
        if k % 12 == 2:
            lines.append("A notice that stands below very many documents of this kind.")
        docs.append([k, "\n".join(lines), "en", rng.choice(["x", "y", "z", None])])
        labels.append((k, 1, int(toxic)))
    for k in range(240, 260):  # copies, and near copies that differ in one word of the first line
        text = docs[k - 100][1]
        docs.append([k, text if k % 2 else text.replace(" ", " extra ", 1), "en", "y"])
    folder = str(tmp_path_factory.mktemp("corpus"))
    rows = [(*d, len(d[1])) for d in docs]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, {d[0]: d[1] for d in docs}, dict((i, t) for i, _, t in labels), items


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())


def test_each_stage_matches_brute_force(spark, corpus):
    folder, texts, toxic, items = corpus
    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), []
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = corpus_pipeline.materialize(stage(spark, docs, folder), name)
        after = {r.doc_id: r.text for r in docs.collect()}
        seen.append((name, len(before), len(after)))
        if name != "mixing":
            assert docs.columns == columns
        if name == "toxicity":
            bad = {i for i, t in before.items() if any(w in t for w in INSULTS)}
            assert set(after) == set(before) - bad and bad
        elif name == "line_dedup":
            lost = brute_lines(sorted(before.items()))
            rest = {i: "\n".join(line for p, line in enumerate(t.split("\n")) if (i, p) not in lost) for i, t in before.items()}
            assert after == {i: t for i, t in rest.items() if t.strip()}
            assert any(t != before[i] for i, t in after.items()) and len(after) < len(before)
        elif name == "simhash":
            assert set(after) == {c for _, _, c in brute_simhash(sorted(before.items()))}
        elif name == "decontamination":
            windows = {tuple(w[s : s + 10]) for _, t in items for w in [words(t)] for s in range(len(w) - 9)}
            dirty = {i for i, t in before.items() for w in [words(t)] if any(tuple(w[s : s + 10]) in windows for s in range(len(w) - 9))}
            assert set(after) == set(before) - dirty and dirty
        else:
            sums, rows = defaultdict(int), docs.collect()
            for r in rows:
                assert 0 < r.taken <= 3 * r.size and r.size == len(r.text.split())
                sums[r.source] += r.taken
            assert all(abs(sums[r.source] - r.target) <= 1 for r in rows)
    result = corpus_pipeline.run(spark, folder)
    assert sorted((r.doc_id, r.taken) for r in result.collect()) == sorted((r.doc_id, r.taken) for r in docs.collect())
    assert [n for n, _, _ in seen] == ["toxicity", "line_dedup", "simhash", "decontamination", "mixing"] and corpus_pipeline.ORACLE_SQL is None
