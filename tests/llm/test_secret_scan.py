"""Certain patterns against plain matching, links against all pairs, odd rows."""

import random
import re

from millrace.llm.secret_scan import BASE_KINDS, ENDPOINT, IDENTIFIER, KINDS, REACH, SECRET, base_spans, find_secrets, parts_of

SCHEMA = "doc_id bigint, text string, row string, secrets string, parts string"
CREDENTIAL = 'deploy notes\nuser_id = robot7\npass: hunter2hunter\nsee https://db.example.com:5432/x\n'


def plain_spans(text):
    found = []
    for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.ASCII):
        if len(m.group(2)) >= 6:
            found.append(("assign", *m.span()))
    found += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 20]
    return found + [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if m.end() - m.start() >= 24]


def by_pairs(parts):
    """Kept parts when every pair is looked at."""
    kept = []
    for p in parts:
        near = {q[4] for q in parts if q is not p and q[5] == p[5] and q[1] - p[2] <= REACH and p[1] - q[2] <= REACH}
        need = {IDENTIFIER: {SECRET}, SECRET: {IDENTIFIER}, ENDPOINT: {IDENTIFIER, SECRET}}[p[4]]
        if p[3] or need <= near:
            kept.append(p[:4])
    return sorted(kept, key=lambda s: (s[1], KINDS.index(s[0])))


def run(spark, texts):
    docs = spark.createDataFrame([(i, t, "r", "s", "p") for i, t in enumerate(texts)], SCHEMA)
    return {r["doc_id"]: [tuple(s) for s in r["secrets"]] for r in find_secrets(docs).collect()}


def test_certain_patterns():
    rng = random.Random(2)
    pieces = ["password", "Passwd", "SECRET", "token", "api_key", "APIKEY", "tokeſn", "ſecret", '"', "'", " ", ":", "=", "abcdef", "x9", "AKIA", "AKIA" + "Z9" * 8, "0af" * 9, "漢", "\U0001F600", "\n"]
    for _ in range(4000):
        text = "".join(rng.choices(pieces, k=rng.randint(1, 14)))
        assert sorted(base_spans(text)) == sorted(plain_spans(text)), text


def test_a_credential_of_three_parts(spark):
    whole, no_user = CREDENTIAL, CREDENTIAL.replace("user_id = robot7\n", "")
    apart, far = CREDENTIAL.replace("robot7\n", "robot7\n\n"), CREDENTIAL.replace("robot7\n", "robot7 " + "word " * 80 + "\n")
    found = run(spark, [whole, no_user, apart, far, "the user is here and the pass is closed, see https://a.example.com"])
    assert [(k, whole[s:e]) for k, s, e, _ in found[0]] == [("identifier", "robot7"), ("material", "hunter2hunter"), ("endpoint", "https://db.example.com:5432/x")]
    assert found[1] == found[2] == found[3] == found[4] == []


def test_weak_parts_beside_certain_ones(spark):
    text = f"key AKIA{'Q7' * 8} with aB3{'dE9' * 7} here"
    found = run(spark, [text, text.replace("AKIA", "MKIA")])
    assert [(k, b) for k, _, _, b in found[0]] == [("access", 1), ("material", 0)]
    assert all(b == 1 for _, _, _, b in found[1])


def test_links_against_all_pairs(spark):
    rng = random.Random(4)
    pieces = [
        "user = bob77", "login: anna_k", "pass = s3cr3t!x", "auth: zzzzzz9", "https://h.example.com/a", "host=db7.local", "token = abc123def",
        "AKIA" + "B4" * 9, "0a1b2c3d4e5f" * 3, "aB3dE9aB3dE9aB3dE9aB3", "\n\n", "plain words " * 9, "漢字 " * 40,
    ]
    texts = [" ".join(rng.choices(pieces, k=rng.randint(1, 40))) for _ in range(300)]
    found = run(spark, texts)
    assert any(s[3] == 0 for spans in found.values() for s in spans)
    for i, text in enumerate(texts):
        assert found[i] == by_pairs(parts_of(text)), text


def test_one_very_crowded_text(spark):
    text = "user = bob77 pass = s3cr3t!x " * 4000
    found = run(spark, [text, None, "", "   \n"])
    assert len(found[0]) == 8000 and found[1] == found[2] == found[3] == []


def test_odd_rows(spark):
    rows = [(1, CREDENTIAL, "r", "s", "p"), (1, CREDENTIAL, "r", "s", "p"), (None, CREDENTIAL, "r", "s", "p"), (2, None, "r", "s", "p")]
    docs = spark.createDataFrame(rows, SCHEMA)
    result = find_secrets(docs)
    assert result.columns == ["doc_id", "text", "row", "parts", "secrets"] or set(result.columns) == set(docs.columns)
    assert sorted(len(r["secrets"]) for r in result.collect()) == [0, 3, 3, 3]
    assert find_secrets(docs.limit(0)).collect() == [] and set(BASE_KINDS) < set(KINDS)
    assert find_secrets(docs, carry=["doc_id"]).columns == ["doc_id", "secrets"]
