"""Line dedup, mixing, URL rules and decontamination against brute force."""

import hashlib
import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from millrace.llm.common import connected_components, link_groups
from millrace.llm.decontamination import decontaminate
from millrace.llm.line_dedup import dedup_lines, line_decisions, similar
from millrace.llm.mixing import fill, mix
from millrace.llm.urls import judge_urls


def words(rng, n):
    return [" ".join(rng.choice(["stone", "river", "cloud", "amber", "quiet", "forty", "lamp", "north"]) + str(rng.randrange(400)) for _ in range(k)) for k in n]


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (201, 200), (200, 201)]
    found = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(found[i] == 0 for i in range(41)) and all(found[k] == 100 for k in range(100, 160)) and found[201] == 200
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_links_between_components_of_one_bucket_are_found(spark):
    # 5 is close to 4 only, 4 to 1: a comparison with the bucket's first node alone would miss 5 and 9.
    members = spark.createDataFrame([("x", n) for n in (1, 4, 7, 9, 50)], "bucket string, node bigint")
    found = {r["node"]: r["component"] for r in link_groups(members, lambda p: p.where("abs(a - b) <= 3")).collect()}
    assert found == {1: 1, 4: 1, 7: 1, 9: 1}



def test_a_crowd_joined_in_random_groups_leaves_few_pairs(spark):
    # Each node is like those within 80: a hub is like few of them, all pairs across components would be 20 times as many.
    nodes = 600
    members = spark.createDataFrame([("x", n) for n in range(nodes)], "bucket string, node bigint")
    known = spark.createDataFrame([(n, (n, ["x"])) for n in range(nodes)], "node bigint, signature struct<size: int, buckets: array<string>>")
    seen = []

    def verify(pairs):
        seen.append(pairs.count())
        return pairs

    near = lambda a, b: F.abs(a["size"] - b["size"]) <= 80
    found = {r["node"]: r["component"] for r in link_groups(members, verify, known, near).collect()}
    assert found == dict.fromkeys(range(nodes), 0)
    assert sum(seen) < 5000


def shingles(line):
    line = line.lower()
    return {line[i : i + 5] for i in range(len(line) - 4)} or {line}


def brute_lines(docs):
    places = [(i, hashlib.sha256(t.encode()).digest(), p, line) for i, t in docs for p, line in enumerate(t.split("\n")) if line.strip(" ")]
    parent = list(range(len(places)))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    sets = [shingles(p[3]) for p in places]
    for a in range(len(places)):
        for b in range(a):
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                parent[root(b)] = root(a)
    groups = defaultdict(list)
    for a, p in enumerate(places):
        groups[root(a)].append(p[:3])
    return {(i, p) for group in groups.values() for i, k, p in group if (i, k, p) != min(group)}


def test_near_duplicate_lines_match_brute_force(spark):
    rng = random.Random(5)
    base = words(rng, [rng.randrange(8, 40) for _ in range(60)])
    near = []
    for line in base:
        tokens = line.split(" ")
        for _ in range(rng.randrange(0, 3)):
            changed = list(tokens)
            changed[rng.randrange(len(changed))] = f"other{rng.randrange(999)}"
            near.append(" ".join(changed))
    lines = base + near + base[:10] + ["", "tiny", "tiny"]
    rng.shuffle(lines)
    docs = [(k, "\n".join(lines[k * 5 : k * 5 + 5])) for k in range(len(lines) // 5 + 1)]
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    found = {(r["doc_id"], p) for r in line_decisions(table).collect() for p in r["removed"]}
    expected = brute_lines(docs)
    assert not found - expected
    assert len(found) >= 0.98 * len(expected) > 30
    kept = {r["doc_id"]: r["text"] for r in dedup_lines(table).collect()}
    for doc_id, text in docs:
        rest = [line for p, line in enumerate(text.split("\n")) if (doc_id, p) not in found]
        assert kept.get(doc_id) == ("\n".join(rest) if "".join(rest).strip() or text == "" else None)


def test_only_the_exact_similarity_decides_a_pair(spark):
    lines = ["all rights reserved by the owner 2019", "all rights reserved by the owner 2018", "stone river cloud", "stone river cloud.", "所有权利均由本网站的所有者保留不得转载", "所有权利均由本网站的所有者保留不得转载。", "stone river amber"]
    pairs = [(a, b) for b in range(len(lines)) for a in range(b)]
    exact = {(a, b) for a, b in pairs if len(shingles(lines[a]) & shingles(lines[b])) >= 0.8 * len(shingles(lines[a]) | shingles(lines[b]))}
    found = similar(spark.createDataFrame(pairs, "a bigint, b bigint"), spark.createDataFrame(list(enumerate(lines)), "node bigint, line string"))
    assert {tuple(r) for r in found.collect()} == exact == {(0, 1), (2, 3), (4, 5)}


def test_short_lines_typos_end_edits_and_unspaced_lines_match_brute_force(spark):
    rng = random.Random(8)
    line = lambda n: words(rng, [n])[0]
    han = lambda n: "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(n))
    pairs = [(x, x + ".") for n in (1, 2, 3, 4, 6, 8) for x in [line(n) for _ in range(12)]]
    pairs += [(x, x + "。") for x in [han(n) for n in (9, 14, 30, 60) for _ in range(6)]] + [(x, chr(0x4DFF) + x) for x in [han(30) for _ in range(6)]]
    pairs += [(x, f"{x[:k]}#{x[k:]}") for x in [line(n) for n in (8, 12, 20, 40) for _ in range(6)] for k in [rng.randrange(len(x))]]
    pairs += [(x, x + "2") for x in [f"https://example.org/{rng.randrange(10**30)}/page-{k}" for k in range(12)]]
    lines = [x for pair in pairs for x in pair]
    docs = list(enumerate(lines))
    expected = brute_lines(docs)
    found = {(r["doc_id"], p) for r in line_decisions(spark.createDataFrame(docs, "doc_id bigint, text string")).collect() for p in r["removed"]}
    assert not found - expected
    assert len(expected) > 0.9 * len(pairs) and len(found) >= 0.99 * len(expected)


def test_levels_are_filled_until_no_source_is_above_its_cap(spark):
    sources = spark.createDataFrame([("a", 5, 10), ("b", 2, 1000), ("c", 1, 100), ("d", 5, 0), ("e", 0, 50)], "source string, weight bigint, source_size bigint")
    found = {r["source"]: r["target"] for r in fill(sources, 3).collect()}
    assert found["a"] == 30 and found["c"] == 300 and found["d"] == 0 and found["e"] == 0
    assert abs(found["b"] - (1160 - 330)) < 1e-6
    tight = {r["source"]: r["target"] for r in fill(sources.where("source in ('a', 'b')"), 1).collect()}
    assert tight == {"a": 10.0, "b": 1000.0}


def test_the_mix_takes_its_target_and_reruns_agree(spark):
    rng = random.Random(2)
    docs = [(k, " ".join(["w"] * rng.choice([1, 5, 60, 400])), rng.choice(["x", "y", "y", "y", None])) for k in range(300)] + [(9, "w w w", "x")] * 4
    table = spark.createDataFrame(docs, "doc_id bigint, text string, source string")
    weights = spark.createDataFrame([("x", 5), ("y", 2), (None, 1)], "source string, weight int")
    rows = mix(table, weights).collect()
    sums = defaultdict(int)
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"]
        sums[r["source"]] += r["taken"]
    targets = {r["source"]: r["target"] for r in rows}
    assert all(abs(sums[s] - targets[s]) <= 3 for s in targets)
    again = mix(table.repartition(3), weights)
    assert sorted((r["doc_id"], r["taken"]) for r in rows) == sorted((r["doc_id"], r["taken"]) for r in again.collect())


def test_url_rules_match_brute_force(spark):
    rng = random.Random(1)
    rules = [("com", "/", "allow"), ("a.com", "/x/", "block"), ("b.a.com", "/x/y", "allow"), ("net", "", "block"), ("a.com", "/x", "allow"), ("a.com", "/x", "block")]
    urls = ["http://" + ".".join(rng.choice("ab") for _ in range(rng.randrange(0, 3))) + rng.choice(["com", ".com", "a.com", ".net", ".A.com"])
            + rng.choice(["", "/", "/x", "/x/", "/x/y", "/x/yz/", "?q=/x/", "#/x"]) for _ in range(200)] + [None, "no scheme", "://"]
    table = spark.createDataFrame([(k, u) for k, u in enumerate(urls)], "page_id bigint, url string")
    found = {r["url"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in judge_urls(table, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()}
    for url in urls:
        match = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (match[1].lower(), match[2]) if match else ("", "")
        fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=(0, 0, 0, None, "allow"))
        assert found[url] == (host, path, best[3], best[4]), url


def test_windows_match_brute_force(spark):
    rng = random.Random(3)
    vocabulary = "one two three four five six seven Eight nine ten a b".split()
    text = lambda n: rng.choice([" ", ". ", "\n"]).join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, text(rng.choice([1, 3, 9, 10, 11, 25]))) for k in range(12)] + [(12, None), (13, "...")]
    items = [i for i in items if i[1] is None or len(i[1].split()) != 1] + [(99, "zebra")]
    docs = [(k, text(60)) for k in range(40)] + [(100 + k, f"{text(15)} {items[k][1]} {text(15)}") for k in range(8)] + [(200, "a zebra"), (201, None)]
    tokens = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())
    found = {r["doc_id"]: r for r in decontaminate(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    hits = 0
    for doc_id, doc in docs:
        own, hit, listed = tokens(doc), set(), set()
        for item_id, item in items:
            w = tokens(item)
            n = min(10, len(w))
            for s in range(len(w) - n + 1) if n else []:
                for at in range(len(own) - n + 1):
                    if own[at : at + n] == w[s : s + n]:
                        hit.update(range(at, at + n))
                        listed.add(str(item_id))
        row = found[doc_id]
        digest = hashlib.sha256(",".join(sorted(listed)).encode()).hexdigest()
        assert (row["n_words"], row["n_hit"], row["n_items"], row["items_sha256"], row["contaminated"]) == (len(own), len(hit), len(listed), digest, bool(hit))
        hits += bool(hit)
    assert hits >= 9
