"""SQL with the same rows as the registered queries, for DuckDB, where SQL can express them."""

from __future__ import annotations

from chronofold.llm.line_rules import BOILERPLATE, END, LONGEST_BOILERPLATE, NAVIGATION, SHOUT


def literal(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


# White space, and letters that are lower-cased.
STRIPPED = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LOWERED = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
WORDS = r"'[^\x20\x09-\x0D]+'"

OP3 = rf"""
WITH lines AS (
    SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), keyed AS (
    SELECT *, translate(trim(line, {STRIPPED}), {LOWERED}) AS k FROM lines
), common AS (
    SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10
), marked AS (
    SELECT doc_id, pos, line, k IN (SELECT k FROM common) AS gone FROM keyed
)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (WHERE gone))::BIGINT AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP4 = rf"""
WITH docs AS (
    SELECT doc_id, source, md5('17:' || coalesce(doc_id::VARCHAR, '')) AS key,
        len(regexp_extract_all(coalesce(text, ''), {WORDS}))::BIGINT AS size
    FROM documents
), sums AS (
    SELECT source, sum(size)::BIGINT AS source_size,
        row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
    FROM docs GROUP BY source
), weighed AS (
    SELECT *, [3, 1, 2][(rank % 3 + 1)::INT] AS weight, source_size * 2 AS room FROM sums
), levels AS (
    SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(room) OVER f, 0)::DOUBLE)
        / (sum(weight) OVER () - coalesce(sum(weight) OVER f, 0))::DOUBLE AS level
    FROM weighed
    WINDOW f AS (ORDER BY room::DOUBLE / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), final AS (
    SELECT arg_min(level, (room::DOUBLE / weight, rank)) AS level FROM levels WHERE level * weight <= room
), aims AS (
    SELECT w.*, least(room::DOUBLE, coalesce(f.level * w.weight, room::DOUBLE)) AS target
    FROM weighed w LEFT JOIN final f ON true
), budgets AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS epochs
    FROM aims
), placed AS (
    SELECT d.doc_id, d.size, b.source_size, b.target, b.epochs,
        floor(b.target)::BIGINT - b.epochs * b.source_size AS rest,
        coalesce(sum(d.size) OVER (PARTITION BY b.rank ORDER BY d.key
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
    FROM docs d JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, size, source_size, target,
    (epochs * size + greatest(0, least(size, rest - start)))::BIGINT AS taken
FROM placed
"""

OP8 = rf"""
WITH words AS (
    SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), {WORDS}) AS w,
    FROM documents
), windows AS (
    SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM words WHERE len(w) >= 3
), hashed AS (
    SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM windows
), twice AS (
    SELECT doc_id, i FROM hashed QUALIFY count(*) OVER (PARTITION BY doc_id, g) >= 2
), covered AS (
    SELECT doc_id, count(DISTINCT i + o)::BIGINT AS n FROM twice, (VALUES (0), (1), (2)) offsets(o) GROUP BY doc_id
), lines AS (
    SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM words
), worded AS (
    SELECT doc_id, line, len(regexp_extract_all(line, {WORDS})) AS n,
        length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS letters
    FROM lines WHERE regexp_matches(line, {WORDS})
), judged AS (
    SELECT *, regexp_matches(line, {literal(END)})
        AND length(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) * 100 <= n * 20
        AND len(regexp_extract_all(line, {literal(SHOUT)})) * 100 <= n * 30
        AND NOT regexp_matches(line, {literal(NAVIGATION)})
        AND (length(line) > {LONGEST_BOILERPLATE} OR NOT regexp_matches(line, {literal(BOILERPLATE)})) AS passes
    FROM worded
), sums AS (
    SELECT doc_id, (count(*) - count(DISTINCT line))::BIGINT AS n_dup_lines,
        coalesce(sum(letters) FILTER (WHERE passes), 0) AS good
    FROM judged GROUP BY doc_id
), counts AS (
    SELECT doc_id, len(w)::BIGINT AS n_words,
        length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols
    FROM words
), failing AS (
    SELECT c.*, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
        coalesce(good, 0) AS good,
        n_words < 50 OR 100 * coalesce(n, 0) > 50 * n_words AS base_failed
    FROM counts c LEFT JOIN sums USING (doc_id) LEFT JOIN covered USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND good * 100 >= word_chars * 50 AS kept
FROM failing
"""

OP6 = rf"""
WITH rules(rule_host, rule_path, said) AS (
    VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
        ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), parts AS (
    SELECT page_id,
        translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), {LOWERED}) AS host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
    FROM pages
), fitting AS (
    SELECT p.*, rule_host || rule_path AS rule, said
    FROM parts p LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host))
        AND starts_with(path, rule_path)
)
SELECT page_id, host, path, rule, coalesce(said, 'allow') AS verdict
FROM fitting QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC NULLS LAST) = 1
"""

OP7 = """
WITH sized AS (
    SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
    FROM pages
), topped AS (
    SELECT *, CASE WHEN payload_bytes >= 1000
        THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) END AS top
    FROM sized
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN top > page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN top > page_id THEN top END AS refers_to
FROM topped
"""

PLAIN_WORDS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

OP10 = rf"""
WITH items AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {LOWERED}), {PLAIN_WORDS}) AS w FROM benchmark
), starts AS (
    SELECT item_id, w, least(13, len(w)) AS k, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i
    FROM items WHERE len(w) > 0
), looked_for AS (
    SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM starts
), docs AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {LOWERED}), {PLAIN_WORDS}) AS w FROM documents
), placed AS (
    SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
    FROM docs, (SELECT DISTINCT k FROM looked_for) WHERE len(w) >= k
), found AS (
    SELECT doc_id, i, l.k, item_id
    FROM (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM placed) p
    JOIN looked_for l ON l.g = p.g AND l.k = p.k
), hit AS (
    SELECT doc_id, count(DISTINCT n) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + k)) AS n FROM found) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
    coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

ORACLE = {
    "op3_line_dedup": OP3,
    "op4_mix_sources": OP4,
    "op6_url_rules": OP6,
    "op7_warc_zip": OP7,
    "op8_line_rules": OP8,
    "op10_decontaminate": OP10,
}
