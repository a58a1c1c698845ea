"""SQL that DuckDB runs on the same tables, for the queries of ``plans.catalog``."""

from __future__ import annotations

from lexspark.functions.text import LOWER, STOPWORDS, UPPER
from lexspark.plans import catalog
from lexspark.sources import generate

STOP = ", ".join(f"'{w}'" for w in STOPWORDS)


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def token_list(text: str) -> str:
    """List of tokens of a text, by regular expressions."""
    words = rf"regexp_split_to_array(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), '[ \t\n\x0B\f\r]+')"
    bare = f"list_transform({words}, lambda w: regexp_replace(w, '[[:punct:]]', '', 'g'))"
    return f"list_filter({bare}, lambda w: w <> '' AND w NOT IN ({STOP}))"


def term_ctes(source: str = "documents", key: str = "doc_id", text: str = "text", name: str = "tf") -> str:
    """CTEs ending in ``name`` (key, word, n, total, word_frequency)."""
    return f"""
{name}_words AS (SELECT {key}, unnest({token_list(text)}) AS word FROM {source}),
{name}_counts AS (SELECT {key}, word, count(*) AS n FROM {name}_words GROUP BY ALL),
{name} AS (SELECT {key}, word, n, sum(n) OVER (PARTITION BY {key})::BIGINT AS total,
    n::DOUBLE / sum(n) OVER (PARTITION BY {key})::DOUBLE AS word_frequency FROM {name}_counts)"""


def idf_ctes(tf: str = "tf", name: str = "idf") -> str:
    return f"""
{name} AS (SELECT word, ln((SELECT count(DISTINCT doc_id) FROM {tf})::DOUBLE / (count(DISTINCT doc_id) + 1)) AS idf
    FROM {tf} GROUP BY word)"""


def search_sql(query: str, k: int = 3, dedupe: bool = False, idf_source: str | None = None) -> str:
    stale = f", {term_ctes(idf_source, name='old')}, {idf_ctes('old')}" if idf_source else f", {idf_ctes()}"
    repeats = "1" if dedupe else "count(*)"
    return f"""WITH {term_ctes()}{stale},
q AS (SELECT unnest({token_list(quoted(query))}) AS word),
terms AS (SELECT word, {repeats} AS m FROM q GROUP BY word),
scored AS (SELECT doc_id, round(sum(m * word_frequency * coalesce(idf, 0)) / (SELECT count(*) FROM q), 8) AS score
    FROM tf JOIN terms USING (word) LEFT JOIN idf USING (word) GROUP BY doc_id)
SELECT doc_id, score, text FROM scored JOIN documents USING (doc_id) ORDER BY score DESC, doc_id LIMIT {k}"""


def batch_ctes(
    queries: str, k: int = 3, dedupe: bool = False, source: str = "documents", idf_source: str | None = None
) -> str:
    """CTEs ending in ``ranked`` (query_id, rank, doc_id, score); ``queries`` has query_id and text."""
    repeats = "1" if dedupe else "count(*)"
    known = f"{term_ctes(idf_source, name='old')}, {idf_ctes('old')}" if idf_source else idf_ctes()
    return f"""{term_ctes(source)}, {known},
asked AS ({queries}),
q AS (SELECT query_id, unnest({token_list('text')}) AS word FROM asked),
terms AS (SELECT query_id, word, {repeats} AS m FROM q GROUP BY ALL),
sizes AS (SELECT query_id, count(*) AS n_tokens FROM q GROUP BY query_id),
scored AS (SELECT query_id, doc_id,
    round(sum(m * word_frequency * coalesce(idf, 0)) / any_value(n_tokens), 8) AS score
    FROM terms JOIN sizes USING (query_id) JOIN tf USING (word) LEFT JOIN idf USING (word) GROUP BY ALL),
ranked AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank,
    doc_id, score FROM scored QUALIFY rank <= {k})"""


def batch_sql(k: int = 3, dedupe: bool = False) -> str:
    return f"""WITH {batch_ctes('SELECT item_id AS query_id, text FROM benchmark', k, dedupe)}
SELECT query_id AS item_id, rank::INT AS rank, doc_id, score, text FROM ranked JOIN documents USING (doc_id)"""


REMAINING_TF = f"""WITH {term_ctes()}
SELECT doc_id, word, round(word_frequency, 8) AS word_frequency FROM tf
WHERE doc_id NOT IN (SELECT doc_id FROM labels)"""

# -- generators ----------------------------------------------------------------------------------


def mixed(number: str, times: int) -> str:
    for _ in range(times):
        p = generate.PRIME
        number = f"list_transform([{number}], lambda x: ((x * x % {p}) * (x * x % {p}) % {p} * x + 7) % {p})[1]"
    return number


def with_states(row_id: str) -> str:
    """Columns ``low`` and ``high``: the two states of a row."""
    p, half = generate.PRIME, generate.HALF
    low, high = f"(({row_id} % {half} * 48271 + 42 * 16807 + 1) % {p})", f"(({row_id} // {half} * 40692 + 5) % {p})"
    return f"{mixed(low, 2)} AS low, {mixed(high, 2)} AS high"


def draw(position: str) -> str:
    p = generate.PRIME
    one, two = f"((low + {position} * 69621) % {p})", f"((high + {position} * 39373) % {p})"
    return f"(({mixed(one, 2)} + {mixed(two, 1)}) % {p})"


POPULAR = "[" + ", ".join(f"'{w}'" for w in generate.POPULAR_WORDS) + "]"


def popular_word(position: str) -> str:
    return f"{POPULAR}[{draw(position)} % {len(generate.POPULAR_WORDS)} + 1]"


DOC_STATES = f"WITH rows AS (SELECT doc_id, {with_states('doc_id')} FROM documents)"

CORPUS_POPULAR = f"""{DOC_STATES} SELECT doc_id, array_to_string(list_transform(range(0, 35), lambda i: CASE
    WHEN i >= 2 THEN 'gibberish_' || {draw('i')} % 5000
    WHEN {draw('35')} % 10 < 1 THEN {popular_word('i')}
    ELSE 'word_' || {draw('i')} % 10000 END), ' ') || ' ' AS text FROM rows"""

CORPUS_CHARS = f"""{DOC_STATES} SELECT doc_id, translate(array_to_string(list_transform(range(0, 167),
    lambda i: to_base({draw('i')} % 387420489, 27, 6)), '')[1:1000],
    '0123456789ABCDEFGHIJKLMNOPQ', '{generate.ALPHABET}') AS text FROM rows"""

QUERY_WORKLOAD = f"""WITH rows AS (SELECT event_id, {with_states('event_id')} FROM events)
SELECT event_id AS query_id, 'word_' || {draw('0')} % 10000 AS text, 'long_tail' AS workload FROM rows
UNION ALL SELECT event_id, {popular_word('0')}, 'short_tail' FROM rows"""

# -- logs ----------------------------------------------------------------------------------------

RUNS = "SELECT event_type AS run, value AS latency_ms, user_id % 7 <> 0 AS ok FROM events"

IOSTAT_ROWS = """SELECT user_id % 6 + 2 AS threads, event_id, value,
    CASE WHEN event_type IN ('view', 'click') THEN 'cpu' ELSE 'disk' END AS kind
    FROM events WHERE event_type <> 'error'"""


def iostat_sql(samples: int | None) -> str:
    limit = f"QUALIFY row_number() OVER (PARTITION BY threads, kind ORDER BY event_id) <= {samples}" if samples else ""
    return f"""WITH kinds AS ({IOSTAT_ROWS}), used AS (SELECT * FROM kinds {limit})
SELECT 'run/system_log_' || threads || '_.log' AS file, threads::INT AS threads,
    count(*) FILTER (kind = 'cpu') AS cpu_samples, count(*) FILTER (kind = 'disk') AS disk_samples,
    round(avg(value) FILTER (kind = 'cpu'), 6) AS cpu_avg_idle, round(max(value) FILTER (kind = 'cpu'), 6) AS cpu_max_idle,
    round(quantile_cont(value, 0.95) FILTER (kind = 'cpu'), 6) AS cpu_95th_idle,
    round(avg(value) FILTER (kind = 'disk'), 6) AS disk_avg_util, round(max(value) FILTER (kind = 'disk'), 6) AS disk_max_util,
    round(quantile_cont(value, 0.95) FILTER (kind = 'disk'), 6) AS disk_95th_util
FROM used GROUP BY threads ORDER BY threads"""


BROKEN_JSON = "lang = 'es' AND source < 'src2'"

SINGLE_WORDS = f"""listed AS (SELECT item_id, {token_list('text')} AS words FROM benchmark),
single AS (SELECT item_id * 1000 + unnest(range(0, len(words))) AS query_id, unnest(words) AS text FROM listed)"""

EVERYWHERE = """SELECT item_id AS query_id, text || ' everywhere' AS text FROM benchmark
    UNION ALL SELECT -item_id - 1, 'everywhere' FROM benchmark"""

STATUS = f"""CASE WHEN lang = 'de' THEN 'not_a_string' WHEN lang = 'fr' THEN 'not_an_object' WHEN {BROKEN_JSON} THEN 'malformed'
        WHEN lang = 'es' OR len({token_list('text')}) = 0 THEN 'no_tokens' ELSE 'accepted' END"""

LAST_TURN = """(SELECT conv_id AS doc_id, 'turn ' || max_by(text, turn) AS text, max(turn) AS turn
    FROM conversations GROUP BY conv_id)"""

ORACLES = {
    "tokens": f"WITH {term_ctes()} SELECT doc_id, word, n FROM tf",
    "token_positions": f"""WITH listed AS (SELECT doc_id, {token_list('text')} AS words FROM documents)
SELECT doc_id, unnest(range(0, len(words)))::INT AS position, unnest(words) AS word FROM listed""",
    "doc_lengths": f"WITH {term_ctes()} SELECT DISTINCT doc_id, total AS total_words FROM tf",
    "term_frequency": f"WITH {term_ctes()} SELECT doc_id, word, round(word_frequency, 8) AS word_frequency FROM tf",
    "term_frequency_stored": f"""WITH {term_ctes()}
SELECT doc_id, word, round_even((n::DOUBLE / total)::FLOAT::DOUBLE, 6)::FLOAT AS word_frequency FROM tf""",
    "page_term_frequency": f"""WITH {term_ctes('pages', 'page_id', 'html')}
SELECT page_id, word, round(word_frequency, 8) AS word_frequency FROM tf""",
    "postings_for_words": f"""WITH {term_ctes()} SELECT word, doc_id, round(word_frequency, 8) AS word_frequency
FROM tf WHERE word IN ({', '.join(quoted(w) for w in catalog.LOOKUP_WORDS)})""",
    "corpus_stats": f"""WITH {term_ctes()}
SELECT count(DISTINCT doc_id) AS total_documents, count(DISTINCT word) AS vocabulary FROM tf""",
    "document_frequency": f"""WITH {term_ctes()}
SELECT word, count(DISTINCT doc_id) AS document_count FROM tf GROUP BY word""",
    "document_frequency_raw": f"""WITH {term_ctes()}
SELECT word, count(DISTINCT doc_id) AS document_count FROM tf_words GROUP BY word""",
    "idf": f"WITH {term_ctes()}, {idf_ctes()} SELECT word, round(idf, 8) AS idf FROM idf",
    "idf_merge_stale": f"""WITH {term_ctes("(SELECT * FROM documents WHERE lang = 'en')", name='a')},
{term_ctes("(SELECT * FROM documents WHERE coalesce(lang, '') <> 'en')", name='b')}, {idf_ctes('a', 'before')}, {idf_ctes('b', 'after')}
SELECT word, round(coalesce(after.idf, before.idf), 8) AS idf FROM before FULL JOIN after USING (word)""",
    "search_top3": search_sql(catalog.SEARCH_TEXT),
    "search_repeat_warm": search_sql(catalog.REPEATED_TEXT),
    "search_repeat_cold": search_sql(catalog.REPEATED_TEXT, dedupe=True),
    "search_stale_idf": search_sql(
        catalog.SEARCH_TEXT, k=20, idf_source="(SELECT * FROM documents WHERE lang = 'en')"
    ),
    "search_no_match": search_sql(catalog.UNKNOWN_TEXT),
    "batch_search_top3": batch_sql(),
    "batch_search_direct": batch_sql(),
    "batch_search_dedupe": batch_sql(k=10, dedupe=True),
    "batch_search_words": f"""WITH {SINGLE_WORDS}, {batch_ctes('SELECT query_id, text FROM single')}
SELECT query_id, rank::INT AS rank, doc_id, score FROM ranked""",
    "batch_search_stale": f"""WITH {SINGLE_WORDS},
{batch_ctes('SELECT query_id, text FROM single', idf_source="(SELECT * FROM documents WHERE lang = 'en')")}
SELECT query_id, rank::INT AS rank, doc_id, score FROM ranked""",
    "batch_search_everywhere": f"""WITH wide AS (SELECT doc_id, 'everywhere ' || text AS text FROM documents),
{batch_ctes(EVERYWHERE, source='wide')}
SELECT query_id, rank::INT AS rank, doc_id, score FROM ranked""",
    "search_json": f"""WITH {batch_ctes('''SELECT item_id AS query_id, text FROM benchmark
    UNION ALL SELECT -item_id - 1, 'to be or what' FROM benchmark''')}
SELECT query_id, CASE WHEN doc_id IS NULL THEN 'No documents found' ELSE 'Documents retrieved successfully' END AS message,
    (rank - 1)::INT AS position, doc_id::VARCHAR AS doc_id, score, documents.text
FROM asked LEFT JOIN ranked USING (query_id) LEFT JOIN documents USING (doc_id)""",
    "search_requests": """SELECT doc_id, replace(text, '+', ' ') AS query,
    octet_length(encode(text)) >= 1 AS valid FROM documents""",
    "search_requests_short": """SELECT doc_id, replace(text, '+', ' ') AS query,
    octet_length(encode(text)) BETWEEN 1 AND 1023 AS valid FROM documents""",
    "get_document": "SELECT doc_id, text FROM documents WHERE doc_id = 7",
    "get_documents": "SELECT doc_id, text FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)",
    "delete_documents": "SELECT doc_id, text FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "delete_postings": REMAINING_TF,
    "deletion_report": "SELECT event_id AS doc_id, event_id IN (SELECT doc_id FROM documents) AS deleted FROM events",
    "rejected_documents": f"SELECT doc_id, text FROM documents WHERE len({token_list('text')}) = 0",
    "json_ingest": f"""SELECT doc_id,
    CASE WHEN lang IN ('de', 'fr') OR {BROKEN_JSON} THEN NULL WHEN lang = 'es' THEN '' ELSE text END AS text,
    {STATUS} AS status
FROM documents""",
    "upsert_postings": f"""WITH {term_ctes()} SELECT doc_id, word,
    round(word_frequency / CASE toxic WHEN 1 THEN 4 WHEN 0 THEN 2 ELSE 1 END, 8) AS word_frequency
FROM tf LEFT JOIN labels USING (doc_id)""",
    "store_lifecycle": f"""WITH changed AS (SELECT d.doc_id,
    CASE WHEN l.doc_id IS NULL THEN text ELSE 'replaced ' || lang || ' ' || text END AS text
    FROM documents d LEFT JOIN labels l USING (doc_id) WHERE coalesce(l.toxic, 0) <> 1), {term_ctes('changed')}
SELECT doc_id, word, round(word_frequency, 8) AS word_frequency FROM tf""",
    "pidstat_summary": """SELECT (user_id % 6 + 2)::INT AS threads, 'server --' || event_type AS cmd,
    round(max(value), 6) AS max_cpu, round(avg(value), 6) AS mean_cpu, round(median(value), 6) AS median_cpu,
    round(avg(user_id), 6) AS avg_usr, round(avg(event_id % 40), 6) AS avg_sys
FROM events WHERE event_type IN ('view', 'click', 'purchase') GROUP BY ALL ORDER BY threads, cmd""",
    "iostat_summary": iostat_sql(None),
    "iostat_first_samples": iostat_sql(360),
    "run_report": """SELECT 'run/user_' || user_id || '.txt' AS file,
    row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS run, (event_id % 12 + 1)::INT AS threads,
    value AS throughput, user_id + 0.25::DOUBLE AS avg_latency_ms, event_id * 3 + 1 AS requests_made,
    event_id * 3 AS requests_completed FROM events""",
    "run_report_insert": """SELECT 'run/user_' || user_id || '.txt' AS file,
    row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS run, (event_id % 12 + 1)::INT AS threads,
    user_id::DOUBLE AS throughput, value AS avg_latency_ms FROM events""",
    "run_metrics": f"""WITH r AS ({RUNS}) SELECT run, count(*) AS requests_made, count(*) FILTER (ok) AS requests_completed,
    round(count(*) FILTER (ok) / 360::DOUBLE, 6) AS throughput,
    round(sum(latency_ms) FILTER (ok) / greatest(count(*) FILTER (ok), 1), 6) AS avg_latency_ms FROM r GROUP BY run""",
    "run_metrics_floor": f"""WITH r AS ({RUNS}) SELECT run, count(*) FILTER (ok) AS requests,
    count(*) FILTER (ok) // 360 AS throughput,
    round(sum(floor(latency_ms)) FILTER (ok) / count(*) FILTER (ok), 6) AS avg_latency_ms FROM r GROUP BY run""",
    "corpus_popular": CORPUS_POPULAR,
    "corpus_chars": CORPUS_CHARS,
    "query_workload": QUERY_WORKLOAD,
}
ORACLES["insert_generated"] = f"""WITH {term_ctes()}, n AS (SELECT doc_id, count(*) AS words FROM tf GROUP BY doc_id)
SELECT text, count(*) AS n_documents, sum(coalesce(words, 0))::BIGINT AS n_postings
FROM documents LEFT JOIN n USING (doc_id) GROUP BY text"""
ORACLES["upsert_duplicates"] = f"""WITH {term_ctes(LAST_TURN)}
SELECT doc_id, word, round(word_frequency, 8) AS word_frequency FROM tf"""
ORACLES["pidstat_files"] = """SELECT 'cpu_' || (user_id % 6 + 2) || '.log' AS file, 'server --' || event_type AS cmd,
    round(max(value), 6) AS max_cpu, round(median(value), 6) AS median_cpu
FROM events WHERE event_type IN ('view', 'click', 'purchase') GROUP BY ALL"""
ORACLES["stream_two_feeds"] = f"""WITH both_feeds AS (SELECT doc_id, text FROM documents
    UNION ALL SELECT -1000 * conv_id - turn - 1, text FROM conversations), {term_ctes('both_feeds')}
SELECT doc_id, word, round(word_frequency, 8) AS word_frequency FROM tf"""
ORACLES["stream_changes"] = f"""WITH kept AS (SELECT * FROM {LAST_TURN} WHERE turn % 4 <> 3), {term_ctes('kept')}
SELECT doc_id, word, round(word_frequency, 8) AS word_frequency FROM tf"""
ORACLES["stream_json"] = f"""WITH judged AS (SELECT {STATUS} AS status, text FROM documents)
SELECT status, CASE status WHEN 'accepted' THEN text ELSE '' END AS text, count(*) AS n FROM judged GROUP BY ALL"""
ORACLES["stream_ingest_tf"] = ORACLES["term_frequency"]
ORACLES["stream_deletes"] = REMAINING_TF
ORACLES["stream_idf"] = f"""WITH left_over AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'again ' || text ELSE text END AS text
    FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)), {term_ctes('left_over')}, {idf_ctes()}
SELECT word, round(idf, 8) AS idf FROM idf"""
ORACLES["stream_df"] = ORACLES["document_frequency"]
ORACLES["document_frequency_estimate"] = f"""WITH {term_ctes()}
SELECT word, count(DISTINCT doc_id) AS document_count, true AS within_bound FROM tf GROUP BY word"""
ORACLES["vocabulary_estimate"] = f"""WITH {term_ctes()}
SELECT count(DISTINCT word) AS vocabulary, true AS within_bound FROM tf"""
ORACLES["postings_blocks"] = f"""WITH {term_ctes()}, placed AS (SELECT word, doc_id, word_frequency,
    (row_number() OVER (PARTITION BY word ORDER BY word_frequency DESC, doc_id) - 1) // 128 AS block FROM tf)
SELECT word, block, doc_id, round(word_frequency, 8) AS word_frequency, (count(*) OVER b)::INT AS n,
    round(max(word_frequency) OVER b, 8) AS tf_max, round(min(word_frequency) OVER b, 8) AS tf_min
FROM placed WINDOW b AS (PARTITION BY word, block)"""
ORACLES["batch_search_blocks"] = batch_sql()
ORACLES["batch_search_bucketed"] = batch_sql()
ORACLES["posting_weights"] = f"""WITH {term_ctes()}, {idf_ctes()}
SELECT doc_id, word, round(word_frequency * idf, 8) AS weight FROM tf JOIN idf USING (word)"""
ORACLES["sql_search"] = ORACLES["search_top3"]
ORACLES["sql_tokens"] = ORACLES["tokens"]
ORACLES["sql_statements"] = f"""WITH {term_ctes()}, {idf_ctes()}
SELECT word, doc_id, round(word_frequency, 8) AS word_frequency, round(idf, 8) AS idf,
    count(*) OVER (PARTITION BY word) AS document_count
FROM tf JOIN idf USING (word) WHERE word IN ({', '.join(quoted(w) for w in catalog.LOOKUP_WORDS)})"""
ORACLES["search_as_of"] = ORACLES["search_stale_idf"]
ORACLES["stream_search"] = ORACLES["search_json"]
ORACLES["stream_df_changes"] = f"""WITH left_over AS (SELECT doc_id, text FROM documents
    WHERE doc_id NOT IN (SELECT doc_id FROM labels)), {term_ctes('left_over')}
SELECT word, count(DISTINCT doc_id) AS document_count FROM tf GROUP BY word"""
