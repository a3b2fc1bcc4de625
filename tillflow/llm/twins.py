"""DuckDB SQL for the queries that SQL can express."""

_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES = {}

ORACLES["op1_line_dedup"] = f"""
WITH lines AS (
    SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
keyed AS (SELECT *, {_LOWER.format(f"trim(line, {_SPACE})")} AS key FROM lines),
owned AS (
    SELECT *, length(key) >= 10 AND doc_id > min(doc_id) OVER (PARTITION BY key) AS gone
    FROM keyed)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), ''))
           AS kept_sha256
FROM owned GROUP BY doc_id
"""

# Base32 of a hexadecimal digest: as bits, then 5 at a time.
_BITS = """array_to_string(list_transform(string_split({}, ''), lambda c:
    substr('0000000100100011010001010110011110001001101010111100110111101111',
           strpos('0123456789abcdef', c) * 4 - 3, 4)), '')"""
_BASE32 = """array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1
        + 16 * CAST(substr(bits, CAST(5 * i + 1 AS BIGINT), 1) AS INT)
        + 8 * CAST(substr(bits, CAST(5 * i + 2 AS BIGINT), 1) AS INT)
        + 4 * CAST(substr(bits, CAST(5 * i + 3 AS BIGINT), 1) AS INT)
        + 2 * CAST(substr(bits, CAST(5 * i + 4 AS BIGINT), 1) AS INT)
        + CAST(substr(bits, CAST(5 * i + 5 AS BIGINT), 1) AS INT), 1)), '')"""

ORACLES["op2_warc"] = f"""
WITH sized AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
           {_BITS.format("sha1(coalesce(html, ''))")} AS bits,
           max(page_id) OVER (PARTITION BY coalesce(html, '')) AS keeper
    FROM pages)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id < keeper THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < keeper THEN keeper END AS refers_to
FROM sized
"""

ORACLES["op5_near_dups"] = f"""
WITH RECURSIVE worded AS (
    SELECT doc_id, list_filter(regexp_split_to_array({_LOWER.format("coalesce(text, '')")},
                                                     '[ \\x09-\\x0D]+'), lambda w: w <> '') AS w
    FROM documents),
grams AS (
    SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5
        THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3),
            lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS gram
    FROM worded),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
    FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id),
links AS (
    SELECT x, y FROM common JOIN sizes s ON s.doc_id = x JOIN sizes t ON t.doc_id = y
    WHERE 100 * c >= 85 * (s.n + t.n - c)),
reach AS (
    SELECT doc_id AS origin, doc_id AS hop FROM sizes
    UNION SELECT origin, y FROM reach JOIN links ON hop = x),
least AS (SELECT origin, min(hop) AS c FROM reach GROUP BY origin)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(c, d.doc_id) AS component_id,
       coalesce(c, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN least l ON l.origin = d.doc_id
"""

ORACLES["op6_chat_parts"] = """
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
shown AS (
    SELECT *, length(replace(replace(replace(text, chr(92), 'xx'), '<', 'xx'), '[', 'xx')) + 15
        + CASE WHEN role IN ('user', 'assistant') THEN 0 ELSE 1 + length(role) END AS size
    FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT)
           AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), ''))
           AS loss_sha256,
       CAST(sum(size) AS BIGINT) AS formatted_chars
FROM shown GROUP BY conv_id
"""

ORACLES["op7_topk_nra"] = """
WITH usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM usable q JOIN usable c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT)
        AS rank
    FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

_LETTERS = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _terms(pattern: str) -> str:
    """All terms of a text, with A-Z lower-cased."""
    return f"regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{pattern}')"


ORACLES["op11_source_divergence"] = f"""
WITH docs AS (
    SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           {_terms(_LETTERS)} AS terms
    FROM documents),
occurring AS (SELECT d, lang, source, unnest(terms) AS term FROM docs),
counted AS (SELECT d, lang, source, term, count(*) AS c FROM occurring GROUP BY ALL),
kept AS (SELECT lang, term FROM counted GROUP BY lang, term HAVING count(*) >= 30),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
cells AS (
    SELECT g.lang, g.source, k.term, CAST(coalesce(sum(c.c), 0) AS HUGEINT) AS c
    FROM groups g JOIN kept k USING (lang)
    LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
    GROUP BY g.lang, g.source, k.term),
shares AS (
    SELECT lang, source, term, c, 1 + CAST((1000000000 * (c + 5))
        // (sum(c) OVER (PARTITION BY lang, source) + 5 * v) AS BIGINT) AS p
    FROM cells JOIN sizes USING (lang)),
whole AS (SELECT lang, term, sum(c) AS c FROM cells GROUP BY lang, term),
whole_shares AS (
    SELECT lang, term, 1 + CAST((1000000000 * (c + 5))
        // (sum(c) OVER (PARTITION BY lang) + 5 * v) AS BIGINT) AS q
    FROM whole JOIN sizes USING (lang)),
pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
           CAST(coalesce((SELECT sum(abs(x.p - y.p)) FROM shares x JOIN shares y
                          ON x.lang = y.lang AND x.term = y.term
                          WHERE x.lang = a.lang AND x.source = a.source
                            AND y.source = b.source), 0) AS BIGINT) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source),
tops AS (
    SELECT lang, source, 'term' AS part, term AS item, p - q AS value
    FROM shares JOIN whole_shares USING (lang, term) WHERE c > 0 AND p > q),
ranked AS (
    SELECT *, CAST(row_number() OVER (
        PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INT) AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM tops))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""

ORACLES["op13_fp_search"] = f"""
WITH docs AS (
    SELECT row_number() OVER () AS d, doc_id, {_terms(_ALNUM)} AS terms FROM documents),
sized AS (SELECT d, doc_id, len(terms) AS n FROM docs WHERE len(terms) > 0),
corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sized),
asked AS (SELECT item_id, unnest({_terms(_ALNUM)}) AS term FROM benchmark),
repeats AS (SELECT item_id, term, count(*) AS times FROM asked GROUP BY ALL),
occurring AS (SELECT d, unnest(terms) AS term FROM docs),
counted AS (
    SELECT d, term, count(*) AS tf FROM occurring
    WHERE term IN (SELECT term FROM repeats) GROUP BY ALL),
weights AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(c.docs) + 2 AS DOUBLE)
                                      / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM counted, corpus c GROUP BY term),
scored AS (
    SELECT r.item_id, s.doc_id, s.d, CAST(sum(r.times * w.w * ((1000000000 * t.tf)
        // (1000 * t.tf + 8 * (25 + (75 * s.n * c.docs) // c.terms)))) AS BIGINT) AS score
    FROM repeats r JOIN counted t USING (term) JOIN weights w USING (term)
    JOIN sized s ON s.d = t.d, corpus c
    GROUP BY r.item_id, s.doc_id, s.d),
ranked AS (
    SELECT item_id, doc_id, score, CAST(row_number() OVER (
        PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank
    FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
