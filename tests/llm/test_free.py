"""Archives, fingerprints, SimHash, models and personal data against brute force, round trips and held-out rows."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from millrace.llm import ctph, langid, pii, toxicity, warc
from millrace.llm.simhash import keep_one_per_group, simhash_components
from millrace.session import fresh_dir


def test_archives_give_back_every_byte(spark):
    rng = random.Random(1)
    large = "".join(rng.choice("abc é漢\r\n\r\n") for _ in range(150_000))
    pages = [(1, "http://a/\r\nX: y", large), (2, None, large), (3, "u", large), (4, "u", "small"), (5, "u", "small"), (6, "u", None), (7, "u", ""), (8, "u", "WARC/1.0\r\n\r\n" * 90)]
    roles = warc.record_roles(spark.createDataFrame(pages, "page_id bigint, url string, html string"))
    manifest = warc.write_archives(roles, fresh_dir(spark, "warc"))
    assert manifest.agg(F.sum("records")).first()[0] == len(pages)
    chunks = warc.read_chunks(manifest).collect()
    whole = {}
    for c in sorted(chunks, key=lambda c: c["chunk_no"]):
        assert len(c["chunk"]) <= warc.CHUNK_BYTES
        whole[c["page_id"]] = whole.get(c["page_id"], b"") + bytes(c["chunk"])
        assert c["bytes_so_far"] == len(whole[c["page_id"]]) and c["digest_so_far"] == hashlib.sha1(whole[c["page_id"]]).hexdigest()
    texts = {i: (h or "").encode() for i, _, h in pages}
    assert whole[3] == texts[3] and whole[1] == whole[2] == b""
    found = {r["page_id"]: r for r in warc.resolve(warc.read_chunks(manifest, with_data=False)).collect()}
    for i, data in texts.items():
        r = found[i]
        assert (r["payload_bytes"], r["payload_digest"], r["intact"]) == (len(data), hashlib.sha1(data).hexdigest(), True)
        assert (r["record_type"], r["refers_to"]) == (("revisit", 3) if i in (1, 2) else ("response", None))


def test_a_damaged_archive_is_not_read_silently(spark, tmp_path):
    roles = warc.record_roles(spark.createDataFrame([(1, "u", "x" * 5000)], "page_id bigint, url string, html string"))
    manifest = warc.write_archives(roles, f"file://{tmp_path}/w")
    path = next((tmp_path / "w").iterdir())
    data = path.read_bytes()
    path.write_bytes(data[: len(data) - 12])
    with pytest.raises(Exception):
        warc.read_chunks(manifest.withColumn("end", F.lit(len(data) - 12).cast("bigint"))).collect()


def test_edits_follow_the_descending_order(spark):
    rng = random.Random(4)
    ids = rng.sample(range(10**6), 700)
    docs = [(i, "".join(rng.choice("abcdé 漢") for _ in range(rng.choice([0, 1, 2, 30, 300])))) for i in ids]
    found = {r["doc_id"]: r for r in ctph.fingerprint_edits(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    ordered = sorted(docs, reverse=True)
    for (i, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1]):
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        r = found[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (ctph.fingerprint(text.encode()), ctph.fingerprint(edited.encode()))
        assert r["near_next"] == 1 or ctph.fingerprint(after.encode()) != r["fingerprint"]


def test_fingerprints_are_near_for_edits_and_far_otherwise(spark, monkeypatch):
    rng = random.Random(6)
    text = lambda n: " ".join(str(rng.randrange(10**6)) for _ in range(n))
    pairs = []
    for _ in range(60):
        a = text(rng.randrange(20, 800))
        middle = len(a) // 2
        pairs.append((ctph.fingerprint(a.encode()), ctph.fingerprint((a[:middle] + "XYZ" + a[middle:]).encode()), ctph.fingerprint(text(300).encode())))
    rows = spark.createDataFrame(pairs, "a string, b string, c string").select(ctph.likeness(F.col("a"), F.col("b")).alias("near"), ctph.likeness(F.col("a"), F.col("c")).alias("far")).collect()
    assert min(r["near"] for r in rows) > 0.6 and max(r["far"] for r in rows) < 0.4
    data = text(3000).encode()
    whole = ctph.fingerprint(data)
    monkeypatch.setattr(ctph, "BLOCK", 1000)
    assert ctph.fingerprint(data) == whole  # blocks don't show
    assert len(ctph.fingerprint(b"a" * 100_000)) < 200


def brute_simhash(docs):
    prints = []
    for _, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        runs = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    parent = list(range(len(docs)))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(docs)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                parent[root(a)] = root(b)
    least = {}
    for a, (i, _) in enumerate(docs):
        least[root(a)] = min(i, least.get(root(a), i))
    return [(i, f"{p:016x}", least[root(a)]) for a, ((i, _), p) in enumerate(zip(docs, prints))]


def test_simhash_components_match_brute_force(spark):
    rng = random.Random(8)
    docs = []
    for _ in range(25):
        base = [str(rng.randrange(500)) for _ in range(rng.randrange(1, 300))]
        for _ in range(rng.randrange(1, 12)):
            copy = list(base)
            for _ in range(rng.randrange(0, 3)):
                copy[rng.randrange(len(copy))] = f"É{rng.randrange(99)}"
            docs.append((rng.randrange(10**6), " ".join(copy)))
    docs = list({i: t for i, t in docs}.items()) + [(-5, ""), (77, "one"), (78, "ONE"), (79, "a b")]
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    expected = brute_simhash(docs)
    found = sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash_components(table, carry=["doc_id"]).collect())
    assert found == sorted(expected) and len({c for _, _, c in expected}) < len(docs)
    kept = sorted(r["doc_id"] for r in keep_one_per_group(table).collect())
    assert kept == sorted({c for _, _, c in expected})


def test_close_fingerprints_always_share_a_cell(spark):
    from millrace.llm.simhash import _cells

    rng = random.Random(9)
    pairs = []
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 3):
            b ^= 1 << bit
        pairs.append((a, b))
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    cells = {}
    rows = spark.createDataFrame([(signed(x),) for p in pairs for x in p], "node bigint").distinct()
    for r in _cells(rows).collect():
        cells.setdefault(r["node"], {}).setdefault(r["bucket"], r["home"])
    for a, b in pairs:
        x, y = cells[signed(a)], cells[signed(b)]
        assert any(x[k] or y[k] for k in x.keys() & y.keys())


def test_kneser_ney_probabilities_sum_to_one_and_tell_languages(spark):
    rng = random.Random(1)
    syllables = {"p": ["ba", "be", "bi", "tra"], "q": ["zor", "zu", "ma", "xi"]}
    text = lambda lang, n: " ".join("".join(rng.choice(syllables[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))
    rows = [(k, lang, text(lang, 80)) for k in range(60) for lang in "pq"]
    table = spark.createDataFrame(rows, "doc_id bigint, lang string, text string")
    model = langid.train(table.where("doc_id % 3 <> 1"))
    predicted = langid.identify(table.where("doc_id % 3 = 1"), model).collect()
    assert all(r["lang_pred"] == r["lang"] and 0 <= r["score"] <= 1 for r in predicted)
    assert np.mean([r["score"] for r in predicted]) > 0.8
    # For a seen context, the probabilities of all letters (seen or not) sum to one.
    letters = sorted({c for t in syllables.values() for s in t for c in s} | {" "})
    for context in ("  b", "zor", " tr"):
        grams = np.array([int.from_bytes("".join([*context, c]).encode("utf-16-be"), "big") for c in letters], np.uint64)
        logs = np.zeros((1, 2))
        total = np.zeros(2)
        for g in grams:
            logs[:], size = 0, np.zeros(1)
            model._score([np.array([g])], [0], logs, size)
            total += np.exp(logs[0])
        assert np.all(np.abs(total - 1) < 0.12)
    odd = spark.createDataFrame([("123 !?",), ("",), (None,)], "text string")
    assert {r["lang_pred"] for r in langid.identify(odd, model).collect()} == {"und"}


def many_grams():
    rng = random.Random(4)
    return {lang: ["".join(chr(first + rng.randrange(400)) for _ in range(120)) for _ in range(80)] for lang, first in (("u", 0x4E00), ("v", 0x5600))}


def test_every_gram_of_a_table_is_found():
    grams = np.unique(np.concatenate([g for texts in many_grams().values() for t in texts for g in langid._pieces(t)]))
    held = langid.Table(grams, np.zeros((len(grams), 2), np.float32))
    assert len(grams) > 18000 and (held.find(grams) == np.arange(len(grams))).all()
    assert (held.find(grams + np.uint64(1 << 63)) == -1).all()


def test_every_counted_gram_is_found(spark):
    texts = many_grams()
    rows = [(k, lang, t) for lang in texts for k, t in enumerate(texts[lang])]
    model = langid.train(spark.createDataFrame(rows, "doc_id bigint, lang string, text string"))
    grams = np.unique(np.concatenate([g for _, _, t in rows for g in langid._pieces(t)]))
    assert len(model.grams[3].keys) == len(grams) > 18000 and (model.grams[3].find(grams) >= 0).all()
    assert (model.grams[3].find(grams + np.uint64(1 << 63)) == -1).all()


def test_tables_too_large_for_memory_are_joined_whole(spark):
    texts = many_grams()
    rows = [(k, lang, t) for lang in texts for k, t in enumerate(texts[lang][:20])]
    learned = spark.createDataFrame(rows, "doc_id bigint, lang string, text string")
    asked = [t[60:] + other[:60] + " xyz" for a, b in zip(texts["u"], texts["v"]) for t, other in ((a, b[:5]), (b, a[:5]))] + ["123", None, "", rows[0][2], rows[0][2]]
    table = spark.createDataFrame([(k, t) for k, t in enumerate(asked)], "doc_id bigint, text string")
    inside, outside = langid.train(learned), langid.train(learned, broadcast_bytes=0)
    assert inside.written is None and not outside.grams and sum(g.count() for g, _ in outside.written) == sum(len(t.keys) for t in inside.grams)
    expected, found = ({r["doc_id"]: r for r in langid.identify(table, m).collect()} for m in (inside, outside))
    assert expected.keys() == found.keys() == set(range(len(asked)))
    for k, r in expected.items():
        assert found[k]["lang_pred"] == r["lang_pred"] and abs(found[k]["score"] - r["score"]) < 1e-3


def test_long_texts_count_alike_in_blocks(monkeypatch):
    text = "Été comme hiver 12 " * 400
    whole = np.concatenate(list(langid._pieces(text)))
    monkeypatch.setattr(langid, "BLOCK", 500)
    parts = np.concatenate(list(langid._pieces(text)))
    assert abs(len(parts) - len(whole)) <= 2 * (len(text) // 500 + 1) and len(np.setdiff1d(whole, parts)) == 0


@pytest.fixture(scope="module")
def model():
    rng = random.Random(3)
    usual = [f"{rng.choice('bcdfgl')}{rng.choice('aeo')}{rng.choice('lmnrst')}{rng.choice('aeiy')}{rng.choice('nst')}" for _ in range(300)]
    text = lambda: ". ".join(" ".join(rng.choice(usual) for _ in range(8)) for _ in range(6))
    insults = ["blockhead", "numskull", "dimwit"]
    bad = [f"{text()}. you {rng.choice(insults)} {rng.choice(usual)}. {text()}" for _ in range(120)]
    return toxicity.fit(bad, [text() for _ in range(200)]), text


def test_insults_with_gaps_and_inserted_characters_are_found(model):
    machine, text = model
    bad = ["blockhead", "block-head", "bl.ock.head", "blockxhead", "bloockhead", "n u m s k u l l", "dimwitt", "DIMWIT!"]
    assert all(machine.scores([f"{text()}. a {b} here. {text()}"])[0] >= 0.3 for b in bad)
    assert np.mean(machine.scores([text() for _ in range(100)]) >= 0.3) <= 0.02
    late = f"{text()} " * 300 + "dimwit"
    assert machine.scores([late])[0] >= 0.3 and machine.scores([""])[0] < 0.3


def test_kernel_matches_its_definition():
    kernel = toxicity.Kernel(["abcab", "xbz"])
    def rows(word):
        out = {}
        for i, j in toxicity.PAIRS:
            for k in range(len(word) - j):
                key = word[k] + word[k + i] + word[k + j]
                out[key] = out.get(key, 0) + toxicity.DECAY ** (j + 1)
        return out
    for word in ("abcab", "aabcab", "xxbz", "abab"):
        for at, landmark in enumerate(kernel.landmarks):
            a, b = rows(word), rows(landmark)
            norm = kernel._norms(np.array([len(word)]))[0] * np.sqrt(sum(v * v for v in b.values()))
            value = min(1.0, sum(v * b.get(k, 0) for k, v in a.items()) / norm)
            assert abs(kernel.values([word])[0, at] - (value if value >= toxicity.FLOOR else 0)) < 1e-5


def brute_spans(text):
    found = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
    for kind, pattern, low, high in ((2, r"[0-9]([\x20-]?[0-9])+", 13, 19), (3, r"\+[0-9][\x20().0-9-]+[0-9]", 9, 15)):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if low <= len(digits) <= high and (kind == 3 or pii.luhn(digits)):
                found.append((kind, *m.span()))
    return found


def test_detectors_match_the_patterns():
    rng = random.Random(1)
    for _ in range(20_000):
        text = "".join(rng.choice("1234.@a-+ ()9x é") for _ in range(rng.randrange(40)))
        assert pii.base_spans(text) == brute_spans(text)
    assert pii.base_spans("1" * 200_000 + "@" + "a" * 200_000) == []


def test_repeats_in_another_form_are_added_and_base_spans_stay():
    train = [f"call +1 ({k}) 555-{4000 + k} or mail a.b{k}@host{k}.example.com from 10.0.{k % 200}.1 in {1900 + k} with {k} of {10 * k} pieces" for k in range(200, 420)]
    field = pii.fit(train)
    spans = lambda t: [(k, t[s:e], b) for k, s, e, b in pii.find_spans(field, [t])[0]]
    assert spans("ask john.doe@web.example.org or john.doe@web soon") == [("email", "john.doe@web.example.org", 1), ("email", "john.doe@web", 0)]
    found = spans("call +1 (244) 555-4688 now, later 555-4688 again")
    assert ("phone", "+1 (244) 555-4688", 1) in found and ("phone", "555-4688", 0) in found
    assert spans("in 1999 we saw 42 birds and 1200 bees") == []
    for text in train[:40]:
        assert [s for s in spans(text) if s[2]] == [(pii.KINDS[k], text[a:b], 1) for k, a, b in brute_spans(text)]
