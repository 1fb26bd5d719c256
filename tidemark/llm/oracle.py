"""Plain SQL for the queries that SQL can express, in DuckDB's dialect."""

from __future__ import annotations

from tidemark.llm import licenses

TOP_K = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0
),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
),
placed AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
    FROM scored
)
SELECT * FROM placed WHERE rank <= 20
"""

NEAR_DUPLICATES = r"""
WITH RECURSIVE cut AS (
    SELECT doc_id, list_filter(
        string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
        lambda x: x <> '') AS w
    FROM documents
),
sets AS (
    SELECT doc_id, CASE
        WHEN len(w) >= 4 THEN list_distinct(list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3]))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
    FROM cut
),
grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, a.n AS n_a, b.n AS n_b, count(*) AS c
    FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
),
links AS (SELECT a, b FROM shared WHERE 100 * c >= 80 * (n_a + n_b - c)),
reached(node, root) AS (
    SELECT doc_id, doc_id FROM sets UNION SELECT b, root FROM reached JOIN links ON node = a
),
least AS (SELECT node, min(root) AS component_id FROM reached GROUP BY node)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN least ON doc_id = node
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical(text: str) -> str:
    """The canonical form of a license text as an SQL expression."""
    lower = f"lower({text})"
    form = f"regexp_replace({lower}, {_quoted(licenses.COPYRIGHT_LINE)}, ' ', 'g')"
    for old, new in licenses.SPELLINGS:
        form = f"replace({form}, {_quoted(old)}, {_quoted(new)})"
    return rf"trim(regexp_replace({form}, '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"


def license_sql() -> str:
    rows = ", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, text in licenses.known_texts())
    return rf"""
WITH known AS (
    SELECT form, min(license) AS license
    FROM (SELECT license, {_canonical("body")} AS form FROM (VALUES {rows}) AS t(license, body)) GROUP BY form
),
docs AS (SELECT doc_id, coalesce(text, '') AS body, count(*) AS n_rows FROM documents GROUP BY ALL),
parts AS (
    SELECT doc_id, body, unnest(list_distinct(list_concat(string_split_regex(body, '\n[\t ]*\n'), string_split(body, chr(10))))) AS part FROM docs
),
found AS (
    SELECT p.doc_id, p.body, k.license FROM parts p JOIN known k ON {_canonical("p.part")} = k.form AND k.form <> ''
),
named AS (
    SELECT doc_id, body, array_to_string(list_sort(list_distinct(list(license))), ' ') AS part_licenses, count(*) AS n_parts
    FROM found GROUP BY ALL
)
SELECT d.doc_id, k.license, coalesce(n.part_licenses, '') AS part_licenses, coalesce(n.n_parts, 0) * d.n_rows AS n_parts, d.n_rows
FROM docs d LEFT JOIN known k ON {_canonical("d.body")} = k.form AND k.form <> ''
LEFT JOIN named n ON d.doc_id IS NOT DISTINCT FROM n.doc_id AND d.body = n.body
"""


CHAT_FORMAT = r"""
WITH said AS (
    SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
),
placed AS (
    SELECT *, row_number() OVER o AS place, lag(role) OVER o AS earlier FROM said
    WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text)
),
moved AS (
    SELECT *, CASE
        WHEN role = 'system' AND place = 1 THEN 13
        WHEN role = 'user' AND (place = 1 OR earlier IN ('system', 'assistant')) THEN 15
        WHEN role = 'assistant' AND earlier = 'user' THEN 5 END AS marks
    FROM placed
),
counted AS (
    SELECT *, len(regexp_extract_all(text, '<\\*s>|<\\*/s>|\[\\*/?(INST|SYS|ROLE)\]|\[\\*/(INST|SYS|ROLE)\]')) AS escapes FROM moved
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
    CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(3 + sum(coalesce(marks, 17 + coalesce(1 + length(role), 0)) + length(text) + escapes) AS BIGINT) AS formatted_chars,
    count(*) FILTER (marks IS NULL) AS n_strays,
    count(*) FILTER (marks IS NULL) = 0 AND arg_max(role, place) = 'assistant' AS complete
FROM counted GROUP BY conv_id
"""

#: The checksum of a word's bytes comes from the 256 remainders of single bytes by the polynomial 0xEDB88320.
TARGET_SAMPLING = r"""
WITH remainders AS (
    SELECT list(r ORDER BY i) AS t FROM (
        SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS r
        FROM range(256) AS b(i)
    )
),
texts AS (SELECT doc_id, text, 'd' AS side, row_number() OVER () AS place FROM documents UNION ALL SELECT NULL, text, 'b', NULL FROM benchmark),
cut AS (
    SELECT doc_id, side, place, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
    FROM texts
),
used AS (SELECT doc_id, side, place, unnest(w) AS word FROM cut),
vocabulary AS (SELECT DISTINCT word FROM used),
digits AS (SELECT word, hex(encode(word)) AS h FROM vocabulary),
bytes AS (SELECT word, list_transform(range(len(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)) AS b FROM digits),
buckets AS (
    SELECT word, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket
    FROM bytes, remainders
),
held AS (
    SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t FROM used JOIN buckets USING (word) GROUP BY bucket
),
sums AS (SELECT sum(s) AS all_s, sum(t) AS all_t FROM held),
gains AS (
    SELECT bucket, floor(1000 * ln(CAST((t + 1) * (all_s + 10000) AS DOUBLE) / CAST((s + 1) * (all_t + 10000) AS DOUBLE))) AS gain FROM held, sums
),
weights AS (
    SELECT place, sum(gain) AS weight FROM used JOIN buckets USING (word) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY place
),
noised AS (
    SELECT c.doc_id, len(c.w) AS n_features, CAST(coalesce(g.weight, 0) AS BIGINT) AS weight,
        CAST('0x' || substr(sha256('2024:' || coalesce(CAST(c.doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
    FROM cut c LEFT JOIN weights g ON c.place = g.place WHERE c.side = 'd'
),
scored AS (SELECT doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + CAST(0.5 AS DOUBLE)) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score FROM noised),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS r, count(*) FILTER (n_features >= 20) OVER () AS n FROM scored
)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score, CASE WHEN n_features >= 20 AND r <= 10 * n // 100 THEN r END AS rank FROM ranked
"""

ORACLE_SQL = {
    "op1_exact_top_k": TOP_K,
    "op5_near_duplicates": NEAR_DUPLICATES,
    "op8_license_digests": license_sql(),
    "op11_chat_format": CHAT_FORMAT,
    "op13_target_sampling": TARGET_SAMPLING,
}
