"""SQL for the operators that it can express. The others are held against plain versions in the tests."""

from __future__ import annotations

_WORDS = r"""
words AS (
    SELECT doc_id, text, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents
)"""

OP7 = rf"""
WITH {_WORDS},
windows AS (
    SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS passage
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM words WHERE len(w) >= 13)
),
firsts AS (SELECT passage, min(doc_id) AS first_id FROM windows GROUP BY passage),
gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i
    FROM windows JOIN firsts USING (passage) WHERE first_id < doc_id
),
tokens AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM words),
marked AS (
    SELECT tokens.doc_id, tokens.i, word, gone.i IS NOT NULL AS removed
    FROM tokens LEFT JOIN gone ON tokens.doc_id = gone.doc_id AND tokens.i = gone.i
),
counted AS (
    SELECT doc_id, count(*) FILTER (WHERE removed) AS n_removed,
           string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT removed) AS kept
    FROM marked GROUP BY doc_id
)
SELECT words.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM words LEFT JOIN counted USING (doc_id)
"""

OP9 = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents
),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS shingle
    FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM words WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
    SELECT a.doc_id AS x, b.doc_id AS y
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    JOIN sizes p ON p.doc_id = a.doc_id JOIN sizes q ON q.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, p.n, q.n
    HAVING 100 * count(*) >= 75 * (p.n + q.n - count(*))
),
reach AS (
    SELECT doc_id AS x, doc_id AS y FROM documents
    UNION
    SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
)
SELECT reach.x AS doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(reach.y) AS component_id
FROM reach LEFT JOIN sizes ON sizes.doc_id = reach.x GROUP BY reach.x
"""

OP10 = rf"""
WITH {_WORDS},
tokens AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM words),
windows AS (
    SELECT doc_id, i, word AS a, lead(word, 1) OVER line AS b, lead(word, 2) OVER line AS c
    FROM tokens WINDOW line AS (PARTITION BY doc_id ORDER BY i)
),
found AS (
    SELECT doc_id, i, c IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, a, b, c) > 1 AS twice FROM windows
),
covered AS (
    SELECT doc_id, twice OR coalesce(lag(twice, 1) OVER line, false) OR coalesce(lag(twice, 2) OVER line, false) AS inside
    FROM found WINDOW line AS (PARTITION BY doc_id ORDER BY i)
),
repeated AS (SELECT doc_id, count(*) FILTER (WHERE inside) AS n FROM covered GROUP BY doc_id),
measured AS (
    SELECT words.doc_id, coalesce(text, '') AS text, len(w)::BIGINT AS n_words,
           coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
           length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
           coalesce(n, 0)::BIGINT AS n_repeat_words
    FROM words LEFT JOIN repeated USING (doc_id)
),
judged AS (
    SELECT *, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
           n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
           length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper,
           length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS n_letters
    FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 100 * n_symbols > 10 * word_chars OR 100 * n_dup_lines > 50 * greatest(1, len(lines))
            OR word_chars < 2 * n_words OR word_chars > 20 * n_words
            OR 100 * n_upper > 60 * greatest(1, n_letters)) AS kept
FROM judged
"""

OP12 = r"""
WITH normalised AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
)
SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(norm) AS text_sha256
FROM normalised
"""

OP13 = r"""
WITH kept AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.x, b.x)::BIGINT AS score
    FROM kept a JOIN kept b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
),
ranked AS (
    SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank
    FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT same
    WHERE 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10
"""

ORACLES: dict[str, str] = {
    "op7_substring": OP7,
    "op9_jaccard": OP9,
    "op10_rules": OP10,
    "op12_exact": OP12,
    "op13_negatives": OP13,
}
