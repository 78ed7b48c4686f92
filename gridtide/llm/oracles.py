"""DuckDB SQL for the queries that SQL can express over whole tables."""

from __future__ import annotations

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {}

ORACLES["op7_exact_dedup"] = f"""
WITH normal AS (SELECT doc_id, {LOWER} AS norm FROM documents)
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(norm) AS text_sha256
FROM normal
WINDOW same AS (PARTITION BY norm)
"""

ORACLES["op8_line_dedup"] = f"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
    FROM documents
),
keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
    FROM lines
),
shared AS (
    SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
),
marked AS (SELECT keyed.*, coalesce(keyed.doc_id <> shared.keeper, false) AS gone FROM keyed LEFT JOIN shared USING (k))
SELECT doc_id,
       count(*) AS n_lines,
       count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked
GROUP BY doc_id
"""

ORACLES["op1_preference_pairs"] = """
WITH turns AS (
    SELECT conv_id // 2 AS pair_id, conv_id % 2 AS side, turn,
           coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
    FROM conversations
),
sides AS (
    SELECT pair_id, turn,
           max(struct_pack(role := role, text := text)) FILTER (side = 0) AS a,
           max(struct_pack(role := role, text := text)) FILTER (side = 1) AS b
    FROM turns GROUP BY pair_id, turn
),
split AS (
    SELECT pair_id, coalesce(min(turn) FILTER (a IS DISTINCT FROM b), 1000000) AS cut FROM sides GROUP BY pair_id
),
said AS (
    SELECT pair_id, turn, turn < cut AS prompt, 'c' AS side, a.role AS role, '<|' || a.role || '|>' || chr(10) || a.text || chr(10) AS out
    FROM sides JOIN split USING (pair_id) WHERE a IS NOT NULL
    UNION ALL
    SELECT pair_id, turn, turn < cut, 'r', b.role, '<|' || b.role || '|>' || chr(10) || b.text || chr(10)
    FROM sides JOIN split USING (pair_id) WHERE b IS NOT NULL
),
placed AS (
    SELECT *, sum(length(out)) FILTER (NOT prompt) OVER (PARTITION BY pair_id, side ORDER BY turn) AS stop FROM said
)
SELECT pair_id,
       count(DISTINCT turn) FILTER (prompt) AS n_prompt_turns,
       coalesce(string_agg(out, '' ORDER BY turn) FILTER (prompt AND side = 'c'), '') AS prompt,
       coalesce(string_agg(out, '' ORDER BY turn) FILTER (NOT prompt AND side = 'c'), '') AS chosen,
       coalesce(string_agg(out, '' ORDER BY turn) FILTER (NOT prompt AND side = 'r'), '') AS rejected,
       coalesce(string_agg((stop - length(out) + length(role) + 5) || ':' || stop, ',' ORDER BY turn)
                FILTER (NOT prompt AND side = 'c' AND role = 'assistant'), '') AS chosen_mask,
       coalesce(string_agg((stop - length(out) + length(role) + 5) || ':' || stop, ',' ORDER BY turn)
                FILTER (NOT prompt AND side = 'r' AND role = 'assistant'), '') AS rejected_mask
FROM placed GROUP BY pair_id
"""

ORACLES["op13_source_divergence"] = rf"""
WITH texts AS (
    SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           {LOWER} AS text
    FROM documents
),
words AS (
    SELECT row, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM texts
),
kept AS (
    SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT row) >= 30
),
counts AS (
    SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL
),
langs AS (SELECT lang, sum(n) AS total, count(*) AS terms FROM kept GROUP BY lang),
groups AS (
    SELECT lang, source, coalesce(sum(n), 0) AS total
    FROM (SELECT DISTINCT lang, source FROM texts) LEFT JOIN counts USING (lang, source)
    GROUP BY ALL
),
shares AS (
    SELECT lang, source, term, coalesce(counts.n, 0) AS n,
           1 + (1000000000 * (coalesce(counts.n, 0) + 5)::HUGEINT) // (groups.total + 5 * langs.terms) AS p,
           1 + (1000000000 * (kept.n + 5)::HUGEINT) // (langs.total + 5 * langs.terms) AS q
    FROM groups JOIN kept USING (lang) JOIN langs USING (lang) LEFT JOIN counts USING (lang, source, term)
),
pairs AS (
    SELECT g.lang, g.source, 'pair' AS part, h.source AS item,
           coalesce((SELECT sum(abs(x.p - y.p)) FROM shares x JOIN shares y USING (lang, term)
                     WHERE x.lang = g.lang AND x.source = g.source AND y.source = h.source), 0) AS value
    FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
),
terms AS (
    SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM shares WHERE n > 0 AND p > q
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
    FROM (FROM pairs UNION ALL FROM terms)
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""

ITEM_WORDS = rf"regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLES["op2_substring_dedup"] = r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM docs),
runs AS (
    SELECT doc_id, p, md5(string_agg(word, ' ') OVER next_words) AS run
    FROM words
    WINDOW next_words AS (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)
    QUALIFY count(*) OVER next_words = 20
),
later AS (SELECT doc_id, p FROM runs QUALIFY row_number() OVER (PARTITION BY run ORDER BY doc_id, p) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS p FROM later)
SELECT docs.doc_id,
       count(words.p) AS n_words,
       count(gone.p) AS n_removed,
       sha256(coalesce(string_agg(word, ' ' ORDER BY words.p) FILTER (gone.p IS NULL), '')) AS kept_sha256
FROM docs
LEFT JOIN words ON docs.doc_id = words.doc_id
LEFT JOIN gone ON words.doc_id = gone.doc_id AND words.p = gone.p
GROUP BY docs.doc_id
"""

ORACLES["op4_benchmark_decontamination"] = f"""
WITH docs AS (SELECT doc_id, {ITEM_WORDS} AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM docs),
items AS (SELECT item_id, {ITEM_WORDS} AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[p : p + least(10, len(w)) - 1], ' ') AS run
    FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS p FROM items WHERE len(w) > 0)
),
ahead AS (
    SELECT doc_id, p, list(word) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS w
    FROM words
),
places AS (
    SELECT doc_id, p, n, array_to_string(w[1 : n], ' ') AS run
    FROM ahead, (SELECT DISTINCT n FROM windows)
    WHERE len(w) >= n
),
found AS (SELECT doc_id, p, n, item_id FROM places JOIN windows USING (n, run)),
hit AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS place FROM found) GROUP BY doc_id),
held AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found)
    GROUP BY doc_id
)
SELECT doc_id,
       len(w) AS n_words,
       coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN held USING (doc_id)
"""


def _crc_table() -> list[int]:
    """The bytewise table of the reflected polynomial."""
    table = list(range(256))
    for _ in range(8):
        table = [c >> 1 ^ (0xEDB88320 if c & 1 else 0) for c in table]
    return table


ORACLES["op11_importance_resampling"] = f"""
WITH texts AS (
    SELECT doc_id AS id, true AS ours, {ITEM_WORDS} AS w FROM documents
    UNION ALL
    SELECT item_id, false, {ITEM_WORDS} FROM benchmark
),
words AS (SELECT id, ours, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM texts),
ahead AS (
    SELECT id, ours, list(word) OVER (PARTITION BY ours, id ORDER BY p ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS w FROM words
),
features AS (SELECT id, ours, array_to_string(w[1 : n], ' ') AS f FROM ahead, (SELECT unnest([1, 2, 3]) AS n) WHERE len(w) >= n),
coded AS (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM features)),
buckets AS (
    SELECT f, xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(range(strlen(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
        lambda crc, b: xor(crc >> 8, {_crc_table()}[(xor(crc, b) & 255) + 1]::BIGINT)
    )) % 10000 AS bucket
    FROM coded
),
placed AS (SELECT id, ours, bucket FROM features JOIN buckets USING (f)),
counts AS (
    SELECT bucket, count(*) FILTER (ours) AS s, count(*) FILTER (NOT ours) AS t,
           sum(count(*) FILTER (ours)) OVER () AS all_s, sum(count(*) FILTER (NOT ours)) OVER () AS all_t
    FROM placed GROUP BY bucket
),
gains AS (
    SELECT bucket, floor(1000 * ln(((t + 1) * (all_s + 10000))::DOUBLE / ((s + 1) * (all_t + 10000))::DOUBLE))::BIGINT AS gain FROM counts
),
weighed AS (
    SELECT id, count(*) AS n_features, sum(gain)::BIGINT AS weight FROM placed JOIN gains USING (bucket) WHERE ours GROUP BY id
),
scored AS (
    SELECT id AS doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score,
           len(w) >= 20 AS able
    FROM texts LEFT JOIN weighed USING (id) WHERE ours
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id) AS place, count(*) FILTER (able) OVER () AS n FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= 5 * n // 100 THEN place END AS rank FROM ranked
"""

ORACLES["op12_suffix_dedup"] = """
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(hex(encode(coalesce(text, '')))) // 2 AS n FROM documents),
strings AS (
    SELECT doc_id, p, md5(substr(h, 2 * p + 1, 800)) AS string
    FROM (SELECT doc_id, h, unnest(range(0, n - 399)) AS p FROM docs WHERE n >= 400)
),
repeated AS (SELECT doc_id, p FROM strings QUALIFY count(*) OVER (PARTITION BY string) > 1),
marked AS (
    SELECT doc_id, p, p > coalesce(lag(p) OVER of_doc, -401) + 400 AS new FROM repeated WINDOW of_doc AS (PARTITION BY doc_id ORDER BY p)
),
numbered AS (SELECT doc_id, p, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY p) AS span FROM marked),
spans AS (SELECT doc_id, span, min(p) AS first, max(p) + 400 AS past FROM numbered GROUP BY doc_id, span),
ends AS (
    SELECT doc_id, first, past, coalesce(lag(past) OVER (PARTITION BY doc_id ORDER BY first), 0) AS before FROM spans
),
removed AS (
    SELECT doc_id, count(*) AS n_spans, sum(past - first) AS n_removed, max(past) AS tail,
           string_agg(substr(h, 2 * before + 1, 2 * (first - before)), '' ORDER BY first) AS kept
    FROM ends JOIN docs USING (doc_id) GROUP BY doc_id
)
SELECT doc_id,
       n AS n_bytes,
       coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN n_spans IS NULL THEN h ELSE kept || substr(h, 2 * tail + 1) END)) AS kept_sha256
FROM docs LEFT JOIN removed USING (doc_id)
"""
