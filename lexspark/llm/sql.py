"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from lexspark.llm.line_quality import BOILERPLATE, NAVIGATION, SENTENCE_END, SHOUTS, SYMBOLS
from lexspark.llm.revisits import TRACKING


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_FAILS = f"""
    NOT regexp_matches(l, {_quoted(SENTENCE_END)})
    OR len(regexp_extract_all(l, {_quoted(SYMBOLS)})) * 2 > len(ws)
    OR len(regexp_extract_all(l, {_quoted(SHOUTS)})) * 3 > len(ws)
    OR len(regexp_extract_all(l, {_quoted(NAVIGATION)})) * 4 > len(ws)
    OR len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) * 10 > len(ws) * 3
    OR {" OR ".join(f"contains(lower(l), {_quoted(p)})" for p in BOILERPLATE)}
"""

LINE_QUALITY = rf"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS t FROM documents
), w AS (
    SELECT doc_id, t,
        list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM d
), windows AS (
    SELECT doc_id, i, list_slice(words, i, i + 7) AS k
    FROM w, unnest(range(1, len(words) - 6)) AS u(i) WHERE len(words) >= 8
), twice AS (
    SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS c FROM windows) WHERE c > 1
), covered AS (
    SELECT doc_id, count(DISTINCT i + j) AS n FROM twice, range(8) AS r(j) GROUP BY doc_id
), split_lines AS (
    SELECT doc_id, l, list_filter(regexp_split_to_array(l, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
    FROM w, unnest(lines) AS u(l)
), lost AS (
    SELECT doc_id, sum(length(array_to_string(ws, ''))) AS n FROM split_lines WHERE {_FAILS} GROUP BY doc_id
), base AS (
    SELECT w.doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
        len(lines) - len(list_distinct(lines)) AS n_dup_lines,
        coalesce(covered.n, 0) AS n_repeat_words, coalesce(lost.n, 0) AS lost
    FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN lost USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
        AND 100 * (word_chars - lost) >= 50 * word_chars AS kept,
    CAST(word_chars - lost AS BIGINT) AS kept_chars
FROM base
"""

_HOST = "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?@]*@)?([^/?]*)"
_PATH = "^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)"

REVISITS = rf"""
WITH spelled AS (
    SELECT page_id, coalesce(html, '') AS html, coalesce(url, '') AS url,
        regexp_replace(trim(url), '#.*\z', '') AS bare
    FROM pages
), parts AS (
    SELECT page_id, html, url,
        regexp_replace(regexp_replace(lower(regexp_extract(bare, '{_HOST}', 1)), ':(80|443)?\z', ''),
            '^www[0-9]*\.', '') AS host,
        regexp_replace(regexp_extract(bare, '{_PATH}', 1), '/+\z', '') AS path,
        list_sort(list_filter(string_split(regexp_extract(bare, '[?](.*)\z', 1), '&'),
            lambda p: p <> '' AND NOT regexp_matches(p, '{TRACKING}'))) AS query
    FROM spelled
), base AS (
    SELECT page_id, md5(html) AS digest, strlen(html) AS length, length(url) AS c,
        CASE WHEN host <> '' THEN
            host || path || CASE WHEN len(query) > 0 THEN '?' || array_to_string(query, '&') ELSE '' END
        END AS canonical
    FROM parts
), visits AS (
    SELECT *, 4 * page_id + visit AS record_id, page_id + 1440 * visit AS captured_at,
        'day ' || CAST(page_id // 1440 AS VARCHAR) AS changed
    FROM base, range(4) AS r(visit) WHERE visit <= c % 4
), placed AS (
    SELECT *, last_value(CASE WHEN visit = 0 THEN page_id END IGNORE NULLS) OVER (
        PARTITION BY canonical ORDER BY captured_at, record_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING
    ) AS source FROM visits
), judged AS (
    SELECT p.*, b.digest AS found, b.length AS found_length, 'day ' || CAST(b.page_id // 1440 AS VARCHAR) AS found_changed,
        CASE WHEN p.canonical IS NULL THEN 'no_url' WHEN b.page_id IS NULL THEN 'no_response'
            WHEN visit = 3 THEN 'unverified'
            WHEN visit = 1 THEN CASE WHEN p.page_id % 7 <> 0 AND p.digest = b.digest THEN 'resolved' ELSE 'mismatch' END
            ELSE CASE WHEN p.changed = 'day ' || CAST(b.page_id // 1440 AS VARCHAR) THEN 'resolved' ELSE 'mismatch' END
        END AS status
    FROM placed p LEFT JOIN base b ON b.page_id = p.source AND p.canonical IS NOT NULL
    WHERE visit > 0
)
SELECT record_id, canonical, captured_at, status,
    CASE WHEN canonical IS NOT NULL THEN 4 * source END AS response_id,
    CASE WHEN status IN ('resolved', 'unverified') THEN found END AS digest,
    CASE WHEN status IN ('resolved', 'unverified') THEN
        'cache-control: max-age=' || CAST(60 * visit AS VARCHAR) || chr(10)
        || 'content-length: ' || CAST(found_length AS VARCHAR) || chr(10) || 'content-type: text/html' || chr(10)
        || 'etag: ' || CASE WHEN visit = 1 THEN 'W/' ELSE '' END || '"' || found || '"' || chr(10)
        || 'last-modified: ' || found_changed || chr(10) || 'x-visit: ' || CAST(visit AS VARCHAR)
    END AS headers
FROM judged
"""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: All pairs that share a shingle are counted, so this suits small tables only.
JACCARD = rf"""
WITH RECURSIVE w AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
        '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
    FROM documents
), s AS (
    SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS k
    FROM w, unnest(range(1, greatest(len(ws) - 3, 2))) AS u(i) WHERE len(ws) > 0
), sizes AS (
    SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
    FROM s AS a JOIN s AS b USING (k) WHERE a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM pairs JOIN sizes AS x ON x.doc_id = a JOIN sizes AS y ON y.doc_id = b
    WHERE 100 * c >= 80 * (x.n + y.n - c)
), reached AS (
    SELECT doc_id AS a, doc_id AS b FROM w
    UNION SELECT reached.a, links.b FROM reached JOIN links ON links.a = reached.b
), least AS (
    SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM least LEFT JOIN sizes USING (doc_id)
"""

CONTAMINATION = rf"""
WITH words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws
    FROM documents
), items AS (
    SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws
    FROM benchmark WHERE item_id IS NOT NULL
), windows AS (
    SELECT DISTINCT item_id, least(len(ws), 10) AS w, array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') AS k
    FROM items, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS u(i) WHERE len(ws) > 0
), places AS (
    SELECT doc_id, i, w, array_to_string(ws[i:i + w - 1], ' ') AS k
    FROM words, (SELECT DISTINCT w FROM windows), unnest(range(1, len(ws) - w + 2)) AS u(i) WHERE len(ws) >= w
), found AS (
    SELECT doc_id, i, w, item_id FROM places JOIN windows USING (w, k)
), hit AS (
    SELECT doc_id, count(DISTINCT i + j) AS n FROM found, unnest(range(w)) AS r(j) GROUP BY doc_id
), named AS (
    SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS ids FROM found GROUP BY doc_id
)
SELECT doc_id, len(ws) AS n_words, coalesce(n, 0) AS n_hit, coalesce(len(ids), 0) AS n_items,
    sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, coalesce(n, 0) > 0 AS contaminated
FROM words LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""


def _kmeans(clusters: int = 8, rounds: int = 10) -> str:
    """The rounds written out one after the other; ``s`` is distance * clusters + number of the nearest."""
    apart = "list_sum(list_transform(range(1, 65), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i])))"
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
    SELECT r, CAST(min({apart} * {clusters} + c.c) AS BIGINT) AS s FROM v, c{i} AS c GROUP BY r
)""")
        if i < rounds:
            steps.append(f"""c{i + 1} AS MATERIALIZED (
    WITH sums AS (
        SELECT s % {clusters} AS c, i, CAST(floor(sum(x[i]) / count(*)) AS BIGINT) AS m
        FROM a{i} JOIN v USING (r), unnest(range(1, 65)) AS u(i) GROUP BY ALL
    ), means AS (SELECT c, list(m ORDER BY i) AS x FROM sums GROUP BY c)
    SELECT old.c, coalesce(means.x, old.x) AS x FROM c{i} AS old LEFT JOIN means USING (c)
)""")
    return f"""
WITH v AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id,
        list_transform(embedding, lambda e: CAST(floor(1024 * CAST(e AS DOUBLE)) AS BIGINT)) AS x
    FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NULL OR isnan(e) OR isinf(e))) = 0
), c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY h, x) - 1 AS c, x
    FROM (SELECT sha256('3:' || vec_id) AS h, x FROM v ORDER BY h, x LIMIT {clusters})
), {", ".join(steps)}, done AS (
    SELECT vec_id, s % {clusters} AS c, s // {clusters} AS distance FROM a{rounds} JOIN v USING (r)
)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, distance,
    CAST(sum(distance) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
    CAST(sum(distance) OVER () AS BIGINT) AS inertia,
    sha256(array_to_string(x, ',')) AS centroid_sha256
FROM done JOIN c{rounds} USING (c)
"""


ORACLES = {
    "op12_zone_map_kmeans": _kmeans(),
    "op11_prefix_containment": CONTAMINATION,
    "op3_jaccard_join": JACCARD,
    "op10_revisits": REVISITS,
    "op9_line_quality": LINE_QUALITY,
}
