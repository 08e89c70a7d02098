"""DuckDB SQL for the queries that SQL can express."""

UPPER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

MIX = r"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
           ('0x' || substr(md5('42|' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS draw
    FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size, 3 * sum(size)::BIGINT AS cap,
           [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
    FROM sized GROUP BY source
), steps AS (
    SELECT *, row_number() OVER w AS step,
           sum(source_size) OVER () - coalesce(sum(cap) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS budget,
           sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
    FROM sources WINDOW w AS (ORDER BY cap / weight, source NULLS LAST)
), level AS (
    SELECT budget, weights FROM steps WHERE weight * budget <= cap * weights ORDER BY step LIMIT 1
), plan AS (
    SELECT source, source_size,
           CASE WHEN weight * budget > cap * weights THEN cap::DOUBLE ELSE (weight * budget)::DOUBLE / weights::DOUBLE END AS target
    FROM sources, level
), wholes AS (
    SELECT *, floor(target + 0.5)::BIGINT // greatest(source_size, 1) AS whole, floor(target + 0.5)::BIGINT % greatest(source_size, 1) AS rest FROM plan
), draws AS (
    SELECT source, draw, sum(size)::BIGINT AS words, (sum(sum(size)) OVER (PARTITION BY source ORDER BY draw))::BIGINT AS upto
    FROM sized GROUP BY source, draw
)
SELECT s.doc_id, s.size, p.source_size, p.target,
       (s.size * p.whole + CASE WHEN d.upto <= p.rest THEN s.size
                                WHEN d.upto - d.words <= p.rest AND d.words > 0 THEN s.size * (p.rest - d.upto + d.words) // d.words
                                ELSE 0 END)::BIGINT AS taken
FROM sized s JOIN wholes p ON s.source IS NOT DISTINCT FROM p.source
JOIN draws d ON s.source IS NOT DISTINCT FROM d.source AND s.draw = d.draw
"""

WARC = r"""
WITH payloads AS (
    SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), firsts AS (
    SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS first FROM payloads
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to, TRUE AS intact
FROM firsts
"""

URLS = rf"""
WITH parsed AS (
    SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), {UPPER}) AS host,
           coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages
), rules(rule_host, rule_path, verdict) AS (
    VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
           ('net', '/es/', 'block'), ('net', '/fr/', 'block')
)
SELECT page_id, host, path,
       (SELECT rule_host || rule_path FROM rules WHERE (host = rule_host OR suffix(host, '.' || rule_host)) AND starts_with(path, rule_path)
        ORDER BY length(rule_host || rule_path) DESC LIMIT 1) AS rule,
       coalesce((SELECT verdict FROM rules WHERE (host = rule_host OR suffix(host, '.' || rule_host)) AND starts_with(path, rule_path)
        ORDER BY length(rule_host || rule_path) DESC LIMIT 1), 'allow') AS verdict
FROM parsed
"""

DECONTAMINATION = rf"""
WITH docs AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {UPPER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), items AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {UPPER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s : s + least(len(w), 10) - 1], ' ') AS words
    FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM items WHERE len(w) > 0)
), lengths AS (
    SELECT DISTINCT n FROM windows
), places AS (
    SELECT doc_id, n, s, array_to_string(w[s : s + n - 1], ' ') AS words
    FROM (SELECT doc_id, w, n, unnest(range(1, (len(w) - n + 2)::BIGINT)) AS s FROM docs, lengths WHERE len(w) >= n)
), hits AS (
    SELECT p.doc_id, p.s, p.n, w.item_id FROM places p JOIN windows w ON p.n = w.n AND p.words = w.words
), counts AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS place FROM hits) GROUP BY doc_id
), listed AS (
    SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs d LEFT JOIN counts USING (doc_id) LEFT JOIN listed USING (doc_id)
"""

#: CRC-32 of a decimal number: its bytes and eight shifts for each, reduced from all ones.
CRC32 = r"""xor(list_reduce([4294967295] || flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda x, y: CASE WHEN y >= 0 THEN xor(x, y) WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END), 4294967295)"""


def _field(value: str) -> str:
    return f"coalesce(strlen(({value})::VARCHAR) || ':' || ({value})::VARCHAR, '-')"


def _record(n_chars: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", n_chars, "text"))) + ")"


MANIFEST = rf"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, lang, {_record("n_chars")} AS leaf, CASE WHEN {CRC32} % 7 = 0 THEN {_record("n_chars::HUGEINT + 1")} END AS claimed FROM documents
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY lang) AS nodes FROM leaves
), tree AS (
    SELECT lang, 0 AS level, place, leaf AS digest, nodes FROM placed
    UNION ALL
    SELECT lang, level + 1, place // 2, sha256(string_agg(digest, '' ORDER BY place)), (any_value(nodes) + 1) // 2
    FROM tree WHERE nodes > 1 GROUP BY lang, level, place // 2
), subroots AS (
    SELECT lang, digest, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS nodes FROM tree WHERE nodes = 1
), top AS (
    SELECT 0 AS level, place, digest, nodes FROM subroots
    UNION ALL
    SELECT level + 1, place // 2, sha256(string_agg(digest, '' ORDER BY place)), (any_value(nodes) + 1) // 2
    FROM top WHERE nodes > 1 GROUP BY level, place // 2
), steps AS (
    SELECT p.lang, p.place, list(CASE WHEN s.digest IS NULL THEN '' WHEN a.place % 2 = 1 THEN 'L' || s.digest ELSE 'R' || s.digest END ORDER BY a.level) AS path
    FROM placed p JOIN tree a ON a.lang IS NOT DISTINCT FROM p.lang AND a.place = p.place >> a.level AND a.nodes > 1
    LEFT JOIN tree s ON s.lang IS NOT DISTINCT FROM a.lang AND s.level = a.level AND s.place = xor(a.place, 1)
    GROUP BY p.lang, p.place
), top_steps AS (
    SELECT r.lang, list(CASE WHEN s.digest IS NULL THEN '' WHEN a.place % 2 = 1 THEN 'L' || s.digest ELSE 'R' || s.digest END ORDER BY a.level) AS path
    FROM subroots r JOIN top a ON a.place = r.place >> a.level AND a.nodes > 1
    LEFT JOIN top s ON s.level = a.level AND s.place = xor(a.place, 1)
    GROUP BY r.lang
), proofs AS (
    SELECT p.doc_id, p.leaf, coalesce(p.claimed, p.leaf) AS shown, r.digest AS subroot, coalesce(s.path, []) || coalesce(t.path, []) AS path
    FROM placed p JOIN subroots r ON r.lang IS NOT DISTINCT FROM p.lang
    LEFT JOIN steps s ON s.lang IS NOT DISTINCT FROM p.lang AND s.place = p.place
    LEFT JOIN top_steps t ON t.lang IS NOT DISTINCT FROM p.lang
), folded AS (
    SELECT *, (SELECT digest FROM top WHERE nodes = 1) AS root, sha256(coalesce(list_aggregate(list_transform(path, lambda x: x[2:]), 'string_agg', ''), '')) AS proof_sha256,
           list_reduce([shown] || path, lambda x, y: sha256(CASE WHEN y = '' THEN x WHEN y[1] = 'L' THEN y[2:] || x ELSE x || y[2:] END)) AS folded_root
    FROM proofs
)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM folded
"""
