"""The same results as SQL for DuckDB, by another way than the operators take.

op1, op8 and op9 are exact here (all pairs that share a shingle; all windows), so what signatures, bands or anchors
miss would show. op2, op3, op6, op7 and the pipeline have none: merges by rank, a fitted model, an iterative
solution. Tests compare op2 with the library and parts of op3 and op7 (isotonic steps, marginals) with plain versions, check that
op6 meets its targets, and of the pipeline only columns, ids and decoding.
"""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_OP1 = rf"""
WITH RECURSIVE words AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
rep AS (SELECT text, min(doc_id) AS rep, any_value(w) AS w FROM words GROUP BY text),
grams AS (
    SELECT rep, array_to_string(w[i : i + 4], chr(10)) AS g
    FROM (SELECT rep, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM rep WHERE len(w) > 0)
),
counts AS (SELECT rep, g, count(*) AS n FROM grams GROUP BY ALL),
sizes AS (SELECT rep, sum(n) AS n FROM counts GROUP BY rep),
pairs AS (
    SELECT x.rep AS a, y.rep AS b, sum(least(x.n, y.n)) AS common
    FROM counts x JOIN counts y ON x.g = y.g AND x.rep < y.rep GROUP BY ALL
),
links AS (
    SELECT a, b FROM pairs JOIN sizes p ON p.rep = a JOIN sizes q ON q.rep = b WHERE common >= 0.8 * (p.n + q.n - common)
),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT rep AS node, rep AS seen FROM rep UNION SELECT node, b FROM reach JOIN both_ways ON seen = a),
roots AS (SELECT node, min(seen) AS class_id FROM reach GROUP BY node)
SELECT doc_id, class_id, doc_id = class_id AS kept
FROM words JOIN rep USING (text) JOIN roots ON node = rep
"""

_OP4 = r"""
WITH coded AS (SELECT vec_id, [x > 0 FOR x IN embedding] AS bits FROM embeddings),
pairs AS (
    SELECT q.vec_id AS query_id, v.vec_id,
        list_sum(list_transform(list_zip(q.bits, v.bits), lambda p: (p[1] <> p[2])::INTEGER))::INTEGER AS distance
    FROM coded q, coded v WHERE q.vec_id % 20 = 0
)
SELECT query_id, rank, vec_id, distance
FROM (
    SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id))::INTEGER AS rank FROM pairs
)
WHERE rank <= 10
"""

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

_OP8 = rf"""
WITH RECURSIVE split AS (
    SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL
),
lines AS (
    SELECT doc_id, i - 1 AS line, trim(parts[i], {_BLANKS}) AS t
    FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM split) WHERE trim(parts[i], {_BLANKS}) <> ''
),
texts AS (SELECT t, row_number() OVER (ORDER BY t) AS k FROM (SELECT DISTINCT t FROM lines)),
grams AS (SELECT DISTINCT k, t[i : i + 7] AS g FROM (SELECT k, t, unnest(range(1, greatest(length(t) - 7, 1) + 1)) AS i FROM texts)),
sizes AS (SELECT k, count(*) AS n FROM grams GROUP BY k),
pairs AS (
    SELECT x.k AS a, y.k AS b, count(*) AS common FROM grams x JOIN grams y ON x.g = y.g AND x.k < y.k GROUP BY ALL
),
links AS (
    SELECT a, b FROM pairs JOIN sizes p ON p.k = a JOIN sizes q ON q.k = b WHERE common >= 0.8 * (p.n + q.n - common)
),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT k AS node, k AS seen FROM texts UNION SELECT node, b FROM reach JOIN both_ways ON seen = a),
roots AS (SELECT node, min(seen) AS root FROM reach GROUP BY node),
placed AS (SELECT doc_id, line, root FROM lines JOIN texts USING (t) JOIN roots ON node = k),
firsts AS (SELECT root, min({{'d': doc_id, 'l': line}}) AS f FROM placed GROUP BY root)
SELECT doc_id, line::INTEGER AS line, f.d AS first_doc_id, f.l::INTEGER AS first_line, doc_id = f.d AND line = f.l AS kept
FROM placed JOIN firsts USING (root)
"""

_OP9 = rf"""
WITH words AS (SELECT doc_id, {_WORDS} AS w FROM documents),
windows AS (
    SELECT doc_id, i, md5(array_to_string(w[i : i + 49], chr(10))) AS h
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words WHERE len(w) >= 50)
),
twice AS (SELECT h FROM windows GROUP BY h HAVING count(DISTINCT (doc_id, i)) > 1),
starts AS (SELECT DISTINCT doc_id, i - 1 AS a, i + 49 AS b FROM windows JOIN twice USING (h)),
marked AS (
    SELECT *, coalesce(a > max(b) OVER (PARTITION BY doc_id ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS new
    FROM starts
),
grouped AS (SELECT *, sum(new::INTEGER) OVER (PARTITION BY doc_id ORDER BY a) AS run FROM marked),
runs AS (SELECT doc_id, run, min(a) AS a, max(b) AS b FROM grouped GROUP BY ALL),
spans AS (SELECT doc_id, sum(b - a) AS n, string_agg(a || ':' || b, ',' ORDER BY a) AS spans FROM runs GROUP BY doc_id)
SELECT words.doc_id, len(w) AS n_words, coalesce(n, 0)::BIGINT AS n_repeated_words, coalesce(spans, '') AS spans
FROM words LEFT JOIN spans USING (doc_id)
"""


# Weights are logarithms in doubles, all else whole numbers; `//` rounds down as no number is below 0.
_OP13 = r"""
WITH words AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
    FROM documents WHERE text IS NOT NULL
),
sizes AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
whole AS (SELECT count(*) AS docs, sum(n)::HUGEINT AS total FROM sizes),
asked AS (
    SELECT item_id, t, count(*) AS times FROM (
        SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
        FROM benchmark WHERE text IS NOT NULL
    ) GROUP BY ALL
),
tf AS (SELECT doc_id, t, count(*) AS tf FROM words WHERE t IN (SELECT t FROM asked) GROUP BY ALL),
weights AS (
    SELECT t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::HUGEINT AS w
    FROM (SELECT t, count(*) AS df FROM tf GROUP BY t), whole
),
impacts AS (
    SELECT doc_id, t, (1000000000::HUGEINT * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // total)) AS impact
    FROM tf JOIN sizes USING (doc_id), whole
),
scores AS (
    SELECT item_id, doc_id, sum(times * w * impact)::BIGINT AS score
    FROM asked JOIN weights USING (t) JOIN impacts USING (t) GROUP BY ALL
)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY rank <= 10
"""


def _op5() -> str:
    from orestrata.llm import line_rules as rules

    furniture = " OR ".join(f"contains(lower(t), '{x}')" for x in rules.BOILERPLATE)
    ends = ", ".join(f"'{x}'" for x in rules._ENDS)
    closing = "''".join(rules._CLOSING.split("'"))
    symbols = "[#*$%&|<>]"
    return rf"""
WITH words AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
windows AS (
    SELECT doc_id, i, array_to_string(w[i : i + 7], chr(10)) AS g
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM words WHERE len(w) >= 8)
),
again AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM again, range(8) r(k) GROUP BY doc_id),
lines AS (
    SELECT doc_id, i, parts[i] AS t, trim(parts[i], {_BLANKS}) AS solid
    FROM (SELECT doc_id, string_split(text, chr(10)) AS parts, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM words)
),
measured AS (
    SELECT *, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS chars,
        length(t) - length(regexp_replace(t, '[ \t]', '', 'g')) + 1 AS roughly,
        length(t) - length(regexp_replace(t, '[|»›•]', '', 'g')) AS bars,
        length(t) - length(regexp_replace(t, '{symbols}', '', 'g')) AS symbols,
        right(rtrim(t, {_BLANKS} || '{closing}'), 1) AS finish
    FROM lines
),
judged AS (
    SELECT *, chars > 0 AND ((bars >= 3 AND bars * 3 >= roughly) OR {furniture} OR symbols * 10 >= chars
        OR (roughly >= 10 AND finish NOT IN ({ends}))) AS bad
    FROM measured
),
per_doc AS (
    SELECT doc_id, sum(chars) FILTER (NOT bad) AS left_chars,
        count(*) FILTER (chars > 0) - count(DISTINCT t) FILTER (chars > 0) AS copies,
        coalesce(string_agg(t, chr(10) ORDER BY i) FILTER (NOT bad), '') AS cleaned
    FROM judged GROUP BY doc_id
),
base AS (
    SELECT doc_id, len(w) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
        length(text) - length(regexp_replace(text, '{symbols}', '', 'g')) AS n_symbols, copies AS n_dup_lines,
        coalesce(covered.n, 0) AS n_repeat_words, left_chars, cleaned
    FROM words JOIN per_doc USING (doc_id) LEFT JOIN covered USING (doc_id)
),
judgement AS (
    SELECT *, n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > {rules.MAX_REPEATED_PERCENT} * n_words AS base_failed,
        CASE WHEN word_chars > 0 THEN 1 - coalesce(left_chars, 0)::DOUBLE / word_chars ELSE 0.0::DOUBLE END AS lost
    FROM base
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, lost,
    NOT base_failed AND lost <= {rules.MAX_LOST} AS kept, sha256(cleaned) AS cleaned_sha256
FROM judgement
"""


ORACLE: dict[str, str] = {
    "op1_minhash_near_dedup": _OP1,
    "op4_hamming_top_k": _OP4,
    "op5_line_rules": _op5(),
    "op8_fuzzy_lines": _OP8,
    "op9_repeated_passages": _OP9,
    "op13_ranked_search": _OP13,
}
