"""DuckDB SQL for the rows of the queries."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

RULE_LEDGER = rf"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {WORDS} AS w,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls
    FROM documents),
windows AS (
    SELECT r, i, array_to_string(w[i:i + 4], ' ') AS g FROM d, unnest(range(1, len(w) - 3)) AS t(i)),
twice AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows),
repeated AS (
    SELECT r, count(DISTINCT i + j) AS n FROM twice, unnest(range(0, 5)) AS t(j) WHERE n > 1 GROUP BY r),
m AS (
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
        CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
        CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
        coalesce(repeated.n, 0) AS n_repeat_words, len(ls) AS n_lines,
        len(list_filter(w, lambda x: x = upper(x) AND x <> lower(x))) AS n_upper_words,
        length(text) - length(regexp_replace(text, '[!?]', '', 'g')) AS n_marks
    FROM d LEFT JOIN repeated USING (r)),
b AS (
    SELECT *, CAST((CASE WHEN n_words < 10 THEN 1 ELSE 0 END)
        + (CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END)
        + (CASE WHEN 10 * n_symbols > 3 * n_words THEN 4 ELSE 0 END)
        + (CASE WHEN n_lines > 0 AND 100 * n_dup_lines > 30 * n_lines THEN 8 ELSE 0 END)
        + (CASE WHEN n_words > 0 AND word_chars < 2 * n_words THEN 16 ELSE 0 END)
        + (CASE WHEN n_words > 0 AND word_chars > 15 * n_words THEN 32 ELSE 0 END)
        + (CASE WHEN 2 * n_upper_words > n_words THEN 64 ELSE 0 END)
        + (CASE WHEN 4 * n_marks > n_words THEN 128 ELSE 0 END) AS BIGINT) AS fail_bits
    FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits
FROM b
"""

SUBSTRING_DEDUP = rf"""
WITH d AS (
    SELECT row_number() OVER () AS r, coalesce(doc_id, 9223372036854775807) AS k, doc_id, {WORDS} AS w FROM documents),
windows AS (
    SELECT r, k, i, sha256(array_to_string(w[i:i + 49], ' ')) AS g FROM d, unnest(range(1, len(w) - 48)) AS t(i)),
later AS (SELECT r, i, k > min(k) OVER (PARTITION BY g) AS cut FROM windows),
gone AS (SELECT r, list(DISTINCT i + j) AS hits FROM later, unnest(range(0, 50)) AS t(j) WHERE cut GROUP BY r),
kept AS (
    SELECT doc_id, w, CASE WHEN hits IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(hits, i)) END AS f
    FROM d LEFT JOIN gone USING (r))
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - len(f) AS BIGINT) AS n_removed,
    sha256(array_to_string(f, ' ')) AS kept_sha256
FROM kept
"""

NEAR_DUPLICATES = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
    SELECT doc_id, hash(array_to_string(w[i:i + 4], ' ')) AS g FROM d, unnest(range(1, greatest(len(w) - 3, 2))) AS t(i)
    WHERE len(w) > 0 GROUP BY ALL),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
    SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach(a, b) AS (
    SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(r.b, d.doc_id)) AS component_id,
    d.doc_id <= coalesce(r.b, d.doc_id) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a, min(b) AS b FROM reach GROUP BY a) r ON r.a = d.doc_id
"""

_RULES = (
    (r"(?is)<!--.*?-->", ""),
    (r"(?is)<script\b.*?</script\s*>", ""),
    (r"(?is)<style\b.*?</style\s*>", ""),
    (r"(?is)<title\b.*?</title\s*>", ""),
    (r"(?i)<(?:br|/?p|/?div|/?li|/?ul|/?ol|/?tr|/?table|/?h[1-6]|/?article|/?section|/?nav|/?header|/?footer|/?body)\b[^>]*>", "\n"),
    (r"<[!/A-Za-z][^>]*>", ""),
)


def _html_text(html: str) -> str:
    for pattern, replacement in _RULES:
        html = f"regexp_replace({html}, '{pattern}', '{replacement}', 'g')"
    # Of numeric entities the pages have only the apostrophe.
    entities = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&apos;", "''"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"))
    for name, character in entities:
        html = f"replace({html}, '{name}', '{character}')"
    html = f"regexp_replace({html}, '[ \\t\\r\\f\\x0B]+', ' ', 'g')"
    html = f"regexp_replace({html}, ' ?\\n[ \\n]*', chr(10), 'g')"
    return f"regexp_replace({html}, '^[ \\n]+|[ \\n]+$', '', 'g')"


def _uuid(text: str) -> str:
    return f"'urn:uuid:' || regexp_replace(md5({text}), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '\\1-\\2-\\3-\\4-\\5')"


WARC_DERIVATIVES = rf"""
WITH p AS (
    SELECT {_uuid("'response|' || coalesce(CAST(page_id AS VARCHAR), '') || '|' || coalesce(url, '')")} AS id, url,
        coalesce(html, '') AS html,
        'HTTP/1.1 200 OK' || chr(13) || chr(10) || 'Content-Type: text/html; charset=utf-8' || chr(13) || chr(10)
            || 'Content-Length: ' || strlen(coalesce(html, '')) AS head
    FROM pages),
t AS (
    SELECT *, {_html_text("html")} AS text, {_html_text(r"regexp_extract(html, '(?is)<title\b[^>]*>(.*?)</title\s*>', 1)")} AS title,
        len(regexp_extract_all(html, '(?i)<a\b[^>]*\bhref=')) AS links,
        'sha256:' || sha256(head || chr(13) || chr(10) || chr(13) || chr(10) || html) AS block_digest_of,
        'sha256:' || sha256(html) AS payload_digest_of FROM p),
r AS (
    SELECT {_uuid("'metadata|' || id")} AS record_id, 'metadata' AS warc_type, id AS refers_to, url AS target_uri,
        'application/warc-fields' AS content_type,
        array_to_string(['source-record-id: ' || id, 'source-block-digest: ' || block_digest_of, 'source-payload-digest: ' || payload_digest_of,
            'http-status: 200', 'http-header-Content-Type: text/html; charset=utf-8', 'http-header-Content-Length: ' || strlen(html),
            'charset: utf-8', 'title: ' || title, 'outlinks: ' || links, 'conversion-status: converted',
            'conversion-record-id: ' || {_uuid("'conversion|' || id")}, ''], chr(13) || chr(10)) AS block
    FROM t
    UNION ALL
    SELECT {_uuid("'conversion|' || id")}, 'conversion', id, url, 'text/plain; charset=utf-8', text FROM t)
SELECT record_id, warc_type, refers_to, target_uri, '2024-02-29T00:00:00Z' AS warc_date, content_type, block,
    'sha256:' || sha256(block) AS block_digest, 'sha256:' || sha256(block) AS payload_digest, CAST(strlen(block) AS BIGINT) AS length
FROM r
"""

TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

RANKED_SEARCH = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {TERMS} AS w FROM documents),
size AS (SELECT count(*) FILTER (len(w) > 0) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d),
q AS (SELECT DISTINCT item_id, unnest({TERMS}) AS term FROM benchmark),
p AS (
    SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n, unnest(w) AS term FROM d)
    WHERE term IN (SELECT term FROM q) GROUP BY ALL),
t AS (
    SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, size GROUP BY term, n_docs),
s AS (
    SELECT item_id, r, doc_id,
        CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
    FROM q JOIN p USING (term) JOIN t USING (term), size GROUP BY item_id, r, doc_id),
ranks AS (
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
    FROM s WHERE score > 0)
SELECT * FROM ranks WHERE rank <= 10
"""

EXACT_TOP_K = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = len(embedding)),
s AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id IS DISTINCT FROM c.vec_id WHERE q.vec_id % 50 = 0),
ranks AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
    FROM s)
SELECT * FROM ranks WHERE rank <= 5
"""

STRUCTURE_REPAIR = r"""
WITH RECURSIVE tab AS (
    SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
        lambda c, k: xor(c >> 1, 3988292384 * (c & 1)))) AS t),
f AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce(list_prepend(4294967295,
        list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
            lambda c: CAST(ascii(c) AS BIGINT))),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS fate
    FROM conversations, tab),
d AS (
    SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
        CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM f, unnest(CASE WHEN fate = 3 THEN [1, 2] ELSE [1] END) AS copies(copy) WHERE fate <> 0),
i AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM d),
k AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS k FROM i),
o AS (
    SELECT *, left(role, 1) AS initial, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
        WHEN k > 1 THEN 'duplicate' WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault,
        lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
    FROM k),
-- States: 0 nothing yet, 1 after the system turn, 2 after a user, 3 after an assistant.
ins(q, q1, cost, letters, turns) AS (VALUES (0, 0, 0, '', ''), (0, 2, 3, 'I', 'user:'), (0, 3, 6, 'II', 'user:' || chr(10) || 'assistant:'),
    (1, 1, 0, '', ''), (1, 2, 3, 'I', 'user:'), (1, 3, 6, 'II', 'user:' || chr(10) || 'assistant:'),
    (2, 2, 0, '', ''), (2, 3, 3, 'I', 'assistant:'), (3, 3, 0, '', ''), (3, 2, 3, 'I', 'user:')),
keeps(q, initial, q1) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
free(q, role, q1) AS (VALUES (0, 'user', 2), (1, 'user', 2), (2, 'assistant', 3), (3, 'user', 2)),
ways AS (
    SELECT conv_id, i, q, q AS q1, 4 AS cost, 'D' AS letter, NULL AS turn FROM o, range(4) AS states(q)
    UNION ALL SELECT conv_id, i, q, q1, CASE fault WHEN 'truncated' THEN 3 ELSE 0 END, 'K', role || ':' || text
        FROM o JOIN keeps USING (initial) WHERE fault IN ('', 'truncated')
    UNION ALL SELECT conv_id, i, q, q1, CASE fault WHEN 'truncated' THEN 6 ELSE 3 END, 'R', free.role || ':' || text
        FROM o, free WHERE fault IN ('', 'truncated')),
dp AS (
    SELECT conv_id, 0::BIGINT AS i, 0::BIGINT AS q, {'cost': 0::BIGINT, 'audit': '', 'turns': ''} AS best FROM conversations GROUP BY conv_id
    UNION ALL
    SELECT dp.conv_id, ways.i, ways.q1, min({'cost': best.cost + ins.cost + ways.cost,
        'audit': best.audit || ins.letters || ways.letter,
        'turns': best.turns || CASE WHEN ins.turns = '' THEN '' WHEN dp.q = 0 THEN ins.turns ELSE chr(10) || ins.turns END
            || CASE WHEN ways.turn IS NULL THEN '' WHEN ins.q1 = 0 THEN ways.turn ELSE chr(10) || ways.turn END})
    FROM dp JOIN ins ON ins.q = dp.q
        JOIN ways ON ways.conv_id IS NOT DISTINCT FROM dp.conv_id AND ways.i = dp.i + 1 AND ways.q = ins.q1
    GROUP BY dp.conv_id, ways.i, ways.q1),
total AS (
    SELECT conv_id, count(i) AS n, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal,
        coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps
    FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN (SELECT conv_id AS o_id, o.* EXCLUDE (conv_id) FROM o) r
        ON c.conv_id IS NOT DISTINCT FROM r.o_id GROUP BY conv_id),
ends AS (
    SELECT dp.conv_id, min({'cost': best.cost + ins.cost, 'audit': best.audit || ins.letters,
        'turns': best.turns || CASE WHEN ins.turns = '' THEN '' WHEN dp.q = 0 THEN ins.turns ELSE chr(10) || ins.turns END}) AS best
    FROM dp JOIN ins ON ins.q = dp.q JOIN total ON total.conv_id IS NOT DISTINCT FROM dp.conv_id AND total.n = dp.i
    WHERE ins.q1 IN (0, 3) GROUP BY dp.conv_id)
SELECT total.conv_id, CAST(gaps AS BIGINT) AS gaps, blank, duplicate, truncated, illegal, best.cost AS cost, best.audit AS audit,
    sha256(best.turns) AS repaired_sha256
FROM total JOIN ends ON total.conv_id IS NOT DISTINCT FROM ends.conv_id
"""
