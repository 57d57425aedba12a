"""SQL for the queries that SQL can express, for an engine with RE2 patterns."""

from __future__ import annotations

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_PARTS = "'(?s)^.*?://([^/?#]*)([^?#]*)'"

_CRC32 = (
    "xor(list_reduce(flatten(list_transform(range(1, len({0}) + 1), "
    "lambda i: [ascii({0}[i]), 0, 0, 0, 0, 0, 0, 0])), lambda a, b: "
    "xor(xor(a, b) >> 1, 3988292384 * (xor(a, b) & 1)), 4294967295::UBIGINT), 4294967295::UBIGINT)"
)

ORACLES: dict[str, str] = {
    "op11_conversation_trie": rf"""
        WITH turns AS (
            SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place,
                coalesce(role, '') AS role, coalesce(text, '') AS text
            FROM conversations WHERE conv_id IS NOT NULL
        ), ids AS (
            SELECT conv_id, conv_id - conv_id % 20 AS source, {_CRC32.format("CAST(conv_id AS VARCHAR)")} % 4 AS h
            FROM (SELECT DISTINCT conv_id FROM turns)
        ), rebuilt AS (
            SELECT i.conv_id, 0 AS own, place, role, text
            FROM ids i JOIN turns t ON t.conv_id = i.source AND place <= h
            UNION ALL
            SELECT conv_id, 1, place, role, text FROM ids JOIN turns USING (conv_id) WHERE place > h
        ), paths AS (
            SELECT conv_id, coalesce(path, []) AS path
            FROM ids LEFT JOIN (
                SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY own, place) AS path
                FROM rebuilt GROUP BY conv_id
            ) USING (conv_id)
        ), members AS (
            SELECT conv_id, d, path[1:d] AS node, d = len(path) AS ends
            FROM (SELECT *, unnest(range(0, len(path) + 1)) AS d FROM paths)
        ), nodes AS (
            SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs,
                coalesce(len(regexp_extract_all(node[d].text, '[^\x20\x09-\x0D]+')), 0) * (count(*) - 1) AS own,
                coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '') AS ended
            FROM members GROUP BY node, d
        ), children AS (
            SELECT node[1:d - 1] AS node, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1
        ), sums AS (
            SELECT node[1:a] AS node, sum(own) AS saved, sum(leaf) AS leaves
            FROM (
                SELECT node, own, CAST(n IS NULL AS INTEGER) AS leaf, unnest(range(0, d + 1)) AS a
                FROM nodes LEFT JOIN children USING (node)
            ) GROUP BY 1
        )
        SELECT x.conv_id, x.d AS depth, p.conv_id AS parent_conv_id, x.n_convs,
            coalesce(c.n, 0) AS n_children, CAST(s.leaves AS BIGINT) AS n_leaves,
            CAST(s.saved AS BIGINT) AS saved_tokens, sha256(x.ended) AS ends_sha256
        FROM nodes x JOIN sums s USING (node) LEFT JOIN children c USING (node)
            LEFT JOIN nodes p ON x.d > 0 AND p.node = x.node[1:x.d - 1]
    """,
    "op5_line_dedup": r"""
        WITH texts AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
        lines AS (
            SELECT doc_id, i, lines[i] || CASE WHEN i < len(lines) THEN chr(10) ELSE '' END AS line
            FROM (SELECT *, unnest(range(1, len(lines) + 1)) AS i FROM texts)
            WHERE i < len(lines) OR lines[i] <> ''
        ), cut AS (
            SELECT *, regexp_extract_all(line, '[^.!?。！？]*[.!?。！？]+[ \x09-\x0D]*|[^.!?。！？]+') AS parts,
                coalesce(sum(length(line)) OVER (
                    PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
            FROM lines
        ), sentences AS (
            SELECT doc_id, i, k, parts[k] AS sentence, len(parts) AS n,
                place + coalesce(sum(length(parts[k])) OVER (
                    PARTITION BY doc_id, i ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
            FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS k FROM cut)
        ), units AS (
            SELECT doc_id, i, 0 AS k, place, 2 AS least_words, 6 AS least_chars, line AS unit FROM cut
            UNION ALL
            SELECT doc_id, i, k, place, 8, 40, sentence FROM sentences WHERE n > 1
        ), plain AS (
            SELECT * FROM (
                SELECT *, array_to_string(regexp_extract_all(lower(unit), '[\p{L}\p{N}]+'), ' ') AS plain FROM units)
            QUALIFY k = 0 OR plain <> first_value(plain) OVER (PARTITION BY doc_id, i ORDER BY k)
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY plain ORDER BY doc_id, place) > 1 AS gone,
                count(*) OVER (PARTITION BY plain) > 1 AS repeated
            FROM plain
            WHERE plain <> '' AND (length(plain) >= least_chars OR len(string_split(plain, ' ')) >= least_words)
        ), flagged AS (
            SELECT s.doc_id, s.place, s.sentence, coalesce(bool_or(gone), FALSE) AS gone,
                coalesce(bool_or(repeated), FALSE) AS repeated,
                array_to_string(regexp_extract_all(lower(sentence), '[\p{L}\p{N}]+'), ' ') AS plain,
                len(regexp_extract_all(lower(sentence), '[\p{L}\p{N}]+')) AS words
            FROM sentences s LEFT JOIN ranked r ON r.doc_id = s.doc_id AND r.i = s.i AND r.k IN (0, s.k)
            GROUP BY s.doc_id, s.i, s.k, s.place, s.sentence
        ), runs AS (
            SELECT *, count(*) FILTER (NOT gone) OVER before AS g, 
                count(*) FILTER (NOT repeated AND (words >= 8 OR length(plain) >= 40)) OVER before AS r
            FROM flagged WINDOW before AS (PARTITION BY doc_id ORDER BY place)
        ), spans AS (
            SELECT doc_id, string_agg(first || ':' || n, ' ' ORDER BY first) AS removed, max(words) AS longest
            FROM (
                SELECT doc_id, CAST(min(place) AS BIGINT) AS first, CAST(sum(length(sentence)) AS BIGINT) AS n,
                    sum(words) AS words
                FROM runs WHERE gone GROUP BY doc_id, g
            ) GROUP BY doc_id
        ), repeats AS (
            SELECT doc_id, max(words) AS longest
            FROM (SELECT doc_id, sum(words) AS words FROM runs WHERE repeated GROUP BY doc_id, r) GROUP BY doc_id
        ), kept AS (
            SELECT doc_id, count(*) AS n_units, count(*) FILTER (gone) AS n_removed,
                CAST(coalesce(sum(length(sentence)) FILTER (gone), 0) AS BIGINT) AS removed_chars,
                coalesce(string_agg(sentence, '' ORDER BY place) FILTER (NOT gone), '') AS text
            FROM flagged GROUP BY doc_id
        )
        SELECT d.doc_id, coalesce(n_units, 0) AS n_units, coalesce(n_removed, 0) AS n_removed,
            coalesce(removed_chars, 0) AS removed_chars,
            CAST(coalesce(s.longest, 0) AS BIGINT) AS longest_removed,
            CAST(coalesce(r.longest, 0) AS BIGINT) AS longest_repeated,
            coalesce(s.removed, '') AS removed,
            CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END AS text
        FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id LEFT JOIN spans s ON s.doc_id = d.doc_id
            LEFT JOIN repeats r ON r.doc_id = d.doc_id
    """,
    "op7_url_filters": f"""
        WITH parts AS (
            SELECT row_number() OVER () AS n, page_id,
                coalesce(translate(regexp_extract(url, {_PARTS}, 1), '{_UPPER}', '{_UPPER.lower()}'), '') AS host,
                coalesce(regexp_extract(url, {_PARTS}, 2), '') AS path
            FROM pages
        ), rules (rule_host, rule_path, verdict) AS (
            VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
                ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')
        ), fits AS (
            SELECT n, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
                arg_max(verdict, length(rule_host || rule_path)) AS verdict
            FROM parts JOIN rules
                ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
            GROUP BY n
        )
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
        FROM parts LEFT JOIN fits USING (n)
    """,
    "op13_hard_negatives": """
        WITH used AS (
            SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS vector
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
                CAST(list_inner_product(a.vector::DOUBLE[], r.vector::DOUBLE[]) AS BIGINT) AS score
            FROM used a JOIN used r ON len(a.vector) = len(r.vector) AND a.vec_id <> r.vec_id
            WHERE a.vec_id % 50 = 0
        ), positives AS (
            SELECT * FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        )
        SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id,
            p.score AS positive_score, n.score AS negative_score,
            CAST(row_number() OVER (
                PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank
        FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
            AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
        QUALIFY rank <= 3
    """,
}
