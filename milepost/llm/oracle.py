"""The queries that SQL can express, in SQL."""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOW}, '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], chr(31)) AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM shingles a JOIN shingles b USING (s) WHERE a.doc_id < b.doc_id GROUP BY ALL),
pairs AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
links AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
reached(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(least_reached, d.doc_id)) AS component_id
FROM d LEFT JOIN sizes USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS least_reached FROM reached GROUP BY a) USING (doc_id)
"""

OP3 = rf"""
WITH d AS (
    SELECT doc_id, coalesce(lang, '') AS g0, coalesce(source, '') AS g1, coalesce(text, '') AS t, {_WORDS} AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
    FROM documents),
spans AS (
    SELECT doc_id, i, array_to_string(w[i:i + 4], chr(31)) AS s
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
again AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, s) AS c FROM spans) WHERE c > 1),
repeated AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM again, unnest(range(0, 5)) AS u(k) GROUP BY doc_id),
base AS (
    SELECT d.doc_id, g0, g1, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
           length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines,
           coalesce(n, 0) AS n_repeat_words, len(l) AS n_lines,
           len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_adjacent,
           len(list_distinct(w)) AS n_distinct
    FROM d LEFT JOIN repeated USING (doc_id)),
shares AS (
    SELECT doc_id, g0, g1, n_words, m.measure, m.low_too, least(m.share, 1000) AS share FROM base, unnest([
        {{'measure': 'symbols', 'share': 1000 * n_symbols // greatest(word_chars, 1), 'low_too': false}},
        {{'measure': 'dup_lines', 'share': 1000 * n_dup_lines // greatest(n_lines, 1), 'low_too': false}},
        {{'measure': 'adjacent', 'share': 1000 * n_adjacent // greatest(n_words, 1), 'low_too': false}},
        {{'measure': 'word_length', 'share': 100 * word_chars // greatest(n_words, 1), 'low_too': true}},
        {{'measure': 'distinct', 'share': 1000 * n_distinct // greatest(n_words, 1), 'low_too': true}}]) AS u(m)),
placed AS (
    SELECT *, row_number() OVER o AS at_own, count(*) OVER g AS n_own, row_number() OVER ol AS at_lang, count(*) OVER gl AS n_lang,
           row_number() OVER oa AS at_any, count(*) OVER ga AS n_any
    FROM shares WINDOW g AS (PARTITION BY measure, g0, g1), o AS (PARTITION BY measure, g0, g1 ORDER BY share),
        gl AS (PARTITION BY measure, g0), ol AS (PARTITION BY measure, g0 ORDER BY share),
        ga AS (PARTITION BY measure), oa AS (PARTITION BY measure ORDER BY share)),
own AS (
    SELECT measure, g0, g1, any_value(n_own) AS n, min(share) FILTER (4 * at_own >= n_own) AS q1, min(share) FILTER (4 * at_own >= 3 * n_own) AS q3,
           min(share) FILTER (100 * at_own >= 99 * n_own) AS tail
    FROM placed GROUP BY ALL),
by_lang AS (
    SELECT measure, g0, any_value(n_lang) AS n, min(share) FILTER (4 * at_lang >= n_lang) AS q1, min(share) FILTER (4 * at_lang >= 3 * n_lang) AS q3,
           min(share) FILTER (100 * at_lang >= 99 * n_lang) AS tail
    FROM placed GROUP BY ALL),
of_any AS (
    SELECT measure, min(share) FILTER (4 * at_any >= n_any) AS q1, min(share) FILTER (4 * at_any >= 3 * n_any) AS q3,
           min(share) FILTER (100 * at_any >= 99 * n_any) AS tail
    FROM placed GROUP BY ALL),
limits AS (
    SELECT measure, o.g0, o.g1, CASE WHEN o.n >= 50 THEN o.q1 WHEN b.n >= 50 THEN b.q1 ELSE a.q1 END AS q1,
           CASE WHEN o.n >= 50 THEN o.q3 WHEN b.n >= 50 THEN b.q3 ELSE a.q3 END AS q3,
           CASE WHEN o.n >= 50 THEN o.tail WHEN b.n >= 50 THEN b.tail ELSE a.tail END AS tail
    FROM own o JOIN by_lang b USING (measure, g0) JOIN of_any a USING (measure)),
away AS (
    SELECT doc_id, share, q3 - q1 AS spread, tail, n_words, greatest(share - q3, CASE WHEN low_too THEN q1 - share ELSE 0 END, 0) AS off
    FROM shares JOIN limits USING (measure, g0, g1)),
verdict AS (
    SELECT doc_id, bool_and(CASE WHEN spread > 0 THEN 4 * off * off * n_words <= 25 * spread * spread * greatest(n_words, 400)
                                 ELSE share <= tail END) AS fine
    FROM away GROUP BY doc_id)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND fine AS kept
FROM base JOIN verdict USING (doc_id)
"""

OP6 = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS digest FROM pages),
f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY digest) ELSE page_id END AS first FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM f
"""

OP7 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
sized AS (SELECT item, w, least(len(w), 13) AS m FROM items WHERE len(w) > 0),
windows AS (
    SELECT DISTINCT item, m, array_to_string(w[i:i + m - 1], ' ') AS s
    FROM (SELECT item, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM sized)),
spans AS (
    SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS s
    FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM windows) WHERE len(w) >= m)),
found AS (SELECT doc_id, m, i, item FROM spans JOIN windows USING (m, s)),
hits AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS place FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM found GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
"""

def _op12(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Rounds are fixed, so each is a step of its own: assign, then move the entries."""
    floor_mean = "CAST((s - ((s % n) + n) % n) // n AS BIGINT)"
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""
far{k} AS (SELECT vec_id, part, entry, CAST(sum((c.x - e.x) * (c.x - e.x)) AS BIGINT) AS far
    FROM cells c JOIN book{k} e USING (part, pos) GROUP BY ALL),
near{k} AS (SELECT vec_id, part, arg_min(entry, (far, entry)) AS entry, min(far) AS far FROM far{k} GROUP BY ALL)""")
        if k < rounds:
            steps.append(f"""
moved{k} AS (SELECT part, entry, pos, sum(x) AS s, count(*) AS n FROM near{k} JOIN cells USING (vec_id, part) GROUP BY ALL),
book{k + 1} AS (SELECT part, entry, pos, coalesce({floor_mean}, x) AS x FROM book{k} LEFT JOIN moved{k} USING (part, entry, pos))""")
    return f"""
WITH kept AS (
    SELECT vec_id, label, embedding AS v, len(embedding) // {parts} AS width FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
flat AS (SELECT vec_id, width, unnest(v) AS x, unnest(range(0, len(v))) AS i FROM kept),
cells AS MATERIALIZED (
    SELECT vec_id, i // width AS part, i % width AS pos, CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT) AS x FROM flat),
opening AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept QUALIFY entry < {entries}),
book0 AS (SELECT part, entry, pos, x FROM cells JOIN opening USING (vec_id)),{",".join(steps)},
digest AS (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM book{rounds}),
coded AS (
    SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(far) AS BIGINT) AS error
    FROM near{rounds} GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN kept USING (vec_id), digest
"""


OP12 = _op12()

OP13 = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
words AS (
    SELECT r, lang, source, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
    FROM (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS w FROM d)),
kept AS MATERIALIZED (SELECT lang, term, count(*) AS n FROM words GROUP BY ALL HAVING count(DISTINCT r) >= 3),
found AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
kinds AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY ALL),
grouped AS (
    SELECT lang, source, coalesce(n, 0) AS total, coalesce(v, 0) AS v FROM (SELECT DISTINCT lang, source FROM d)
    LEFT JOIN (SELECT lang, source, sum(n) AS n FROM found GROUP BY ALL) USING (lang, source) LEFT JOIN (SELECT lang, v FROM kinds) USING (lang)),
prob AS MATERIALIZED (
    SELECT g.lang, g.source, k.term, coalesce(f.n, 0) AS n, CAST(1 + 1000000000 * (coalesce(f.n, 0) + 1) // (g.total + g.v) AS BIGINT) AS p
    FROM grouped g JOIN kept k USING (lang) LEFT JOIN found f ON f.lang = g.lang AND f.source = g.source AND f.term = k.term),
pair AS (
    SELECT a.lang, a.source, b.source AS item, CAST(sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS BIGINT) AS value
    FROM prob a JOIN prob b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
    FROM grouped a JOIN grouped b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pair p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source),
of_lang AS (SELECT lang, term, CAST(1 + 1000000000 * (k.n + 1) // (i.n + i.v) AS BIGINT) AS q FROM kept k JOIN kinds i USING (lang)),
terms AS (
    SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // q AS value
    FROM prob JOIN of_lang USING (lang, term) WHERE prob.n > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
QUALIFY part = 'pair' OR rank <= 200
"""


ORACLE = {"op2_jaccard_join": OP2, "op3_quality_rules": OP3, "op6_warc_index": OP6, "op7_decontamination": OP7, "op12_cover_tree_codes": OP12, "op13_source_audit": OP13}
