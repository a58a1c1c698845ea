"""The registered queries: every operation of the library over the whole input tables.

Each takes ``(spark, sf_dir)`` and returns a DataFrame. ``plans.oracles`` has the SQL to compare with.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lexspark.functions import sql
from lexspark.functions.text import decode_query, is_valid_query
from lexspark.operators import batch_search as batch
from lexspark.operators import blocks as blocks_ops
from lexspark.operators import documents as docs_ops
from lexspark.operators import idf as idf_ops
from lexspark.operators import index as index_ops
from lexspark.operators import search as search_ops
from lexspark.plans import rendered_logs
from lexspark.session import materialise, scratch_path, small_splits
from lexspark.sources import generate, json_docs, logs
from lexspark.sources.bucketed import BucketedIndex
from lexspark.sources.store import DocumentStore
from lexspark.streaming import feeds

SEARCH_TEXT = "Then heon, on the ERES heron-thand and the sh tion!"
REPEATED_TEXT = "heon tion heon esen heon"
UNKNOWN_TEXT = "what is zzzunknownword"
LOOKUP_WORDS = ["heon", "tion", "esen"]
RUN_SECONDS = 360


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}*.parquet")


def index_and_idf(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents, stored postings and stored IDF: what a search service has at hand."""
    docs = table(spark, sf_dir, "documents")
    with small_splits(spark):
        postings = materialise(by_word(index_ops.build_index(docs)), "postings")
    return docs, postings, materialise(snapshot_of(docs, postings), "idf")


def by_word(postings: DataFrame) -> DataFrame:
    """Sorted within files, so that a scan for some words skips most row groups."""
    return postings.sortWithinPartitions("word", F.desc("word_frequency"))


def snapshot_of(docs: DataFrame, postings: DataFrame) -> DataFrame:
    total = idf_ops.document_count(index_ops.accepted_documents(docs)).scalar()
    return idf_ops.idf_snapshot(idf_ops.document_frequency(postings), total)


def corpus_idf(docs: DataFrame) -> DataFrame:
    """IDF straight from texts; the postings are stored so that texts are tokenised once."""
    postings = materialise(index_ops.build_index(docs), "postings")
    return snapshot_of(docs, postings).select("word", "idf")


# -- index and statistics ------------------------------------------------------------------------


def tokens(spark, sf_dir):
    counts = index_ops.term_counts(table(spark, sf_dir, "documents"))
    return counts.select("doc_id", "word", F.col("word_count").alias("n"))


def token_positions(spark, sf_dir):
    return index_ops.exploded_tokens(table(spark, sf_dir, "documents"))


def doc_lengths(spark, sf_dir):
    return index_ops.document_lengths(table(spark, sf_dir, "documents"))


def term_frequency(spark, sf_dir):
    postings = index_ops.build_index(table(spark, sf_dir, "documents"))
    return postings.withColumn("word_frequency", F.round("word_frequency", 8))


def term_frequency_stored(spark, sf_dir):
    return index_ops.build_index(table(spark, sf_dir, "documents"), stored_precision=True)


def page_term_frequency(spark, sf_dir):
    postings = index_ops.build_index(table(spark, sf_dir, "pages"), "page_id", "html")
    return postings.withColumn("word_frequency", F.round("word_frequency", 8))


def postings_for_words(spark, sf_dir):
    postings = index_ops.build_index(table(spark, sf_dir, "documents"))
    return index_ops.postings_lists(postings, LOOKUP_WORDS).withColumn(
        "word_frequency", F.round("word_frequency", 8)
    )


def corpus_stats(spark, sf_dir):
    postings = materialise(index_ops.build_index(table(spark, sf_dir, "documents")), "postings")
    vocabulary = idf_ops.vocabulary_size(postings)
    total = idf_ops.document_count(index_ops.accepted_documents(table(spark, sf_dir, "documents")))
    return total.select("total_documents", vocabulary.scalar().alias("vocabulary"))


def document_frequency(spark, sf_dir):
    return idf_ops.document_frequency(index_ops.build_index(table(spark, sf_dir, "documents")))


def document_frequency_estimate(spark, sf_dir):
    """Sketches per language, merged; whether each estimate is within its bound of the exact count."""
    docs = table(spark, sf_dir, "documents")
    raw = index_ops.exploded_tokens(docs).join(docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part")), "doc_id")
    parts = raw.groupBy("part", "word").agg(F.hll_sketch_agg("doc_id", idf_ops.SKETCH_LG_K).alias("sketch"))
    estimate = idf_ops.estimated_frequency(idf_ops.merge_sketches(parts)).withColumnRenamed("document_count", "_n")
    exact = idf_ops.document_frequency(index_ops.build_index(docs))
    near = F.abs(F.col("_n") - F.col("document_count")) <= F.ceil(F.col("document_count") * idf_ops.sketch_error())
    return exact.join(estimate, "word").select("word", "document_count", near.alias("within_bound"))


def vocabulary_estimate(spark, sf_dir):
    postings = materialise(index_ops.build_index(table(spark, sf_dir, "documents")), "postings")
    estimate = idf_ops.estimated_vocabulary(postings).scalar()
    exact = F.col("vocabulary")
    near = F.abs(estimate - exact) <= F.ceil(exact * idf_ops.sketch_error())
    return idf_ops.vocabulary_size(postings).select("vocabulary", near.alias("within_bound"))


def postings_blocks(spark, sf_dir):
    """The postings out of their blocks, with the block's number and frequencies."""
    made = blocks_ops.posting_blocks(index_ops.build_index(table(spark, sf_dir, "documents")))
    stored = materialise(blocks_ops.block_order(made), "blocks")
    each = stored.select("word", "block", "n", "tf_max", "tf_min", F.explode("postings").alias("p"))
    columns = {"word_frequency": F.col("p.word_frequency"), "tf_max": F.col("tf_max"), "tf_min": F.col("tf_min")}
    rounded = [F.round(c, 8).alias(name) for name, c in columns.items()]
    return each.select("word", "block", "n", F.col("p.doc_id").alias("doc_id"), *rounded)


def document_frequency_raw(spark, sf_dir):
    raw = index_ops.exploded_tokens(table(spark, sf_dir, "documents"))
    return idf_ops.document_frequency(raw, unique=False)


def idf(spark, sf_dir):
    return corpus_idf(table(spark, sf_dir, "documents")).withColumn("idf", F.round("idf", 8))


def idf_merge_stale(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    old = corpus_idf(docs.filter(F.col("lang") == "en"))
    new = corpus_idf(docs.filter(F.coalesce("lang", F.lit("")) != "en"))
    return idf_ops.merge_idf(old, new).withColumn("idf", F.round("idf", 8))


# -- search --------------------------------------------------------------------------------------


def search_top3(spark, sf_dir):
    docs, postings, snapshot = index_and_idf(spark, sf_dir)
    return search_ops.search(SEARCH_TEXT, postings, snapshot, docs)


def search_repeat_warm(spark, sf_dir):
    docs, postings, snapshot = index_and_idf(spark, sf_dir)
    return search_ops.search(REPEATED_TEXT, postings, snapshot, docs)


def search_repeat_cold(spark, sf_dir):
    docs, postings, snapshot = index_and_idf(spark, sf_dir)
    return search_ops.search(REPEATED_TEXT, postings, snapshot, docs, dedupe_query_terms=True)


def search_stale_idf(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    stale = corpus_idf(docs.filter(F.col("lang") == "en"))
    return search_ops.search(SEARCH_TEXT, index_ops.build_index(docs), stale, docs, k=20)


def search_no_match(spark, sf_dir):
    docs, postings, snapshot = index_and_idf(spark, sf_dir)
    return search_ops.search(UNKNOWN_TEXT, postings, snapshot, docs)


def _batch(spark, sf_dir, **options):
    docs, postings, snapshot = index_and_idf(spark, sf_dir)
    queries = table(spark, sf_dir, "benchmark")
    return batch.batch_search(queries, postings, snapshot, docs, query_col="item_id", **options)


def batch_search_top3(spark, sf_dir):
    return _batch(spark, sf_dir)


def batch_search_direct(spark, sf_dir):
    return _batch(spark, sf_dir, strategy="direct")


def batch_search_blocks(spark, sf_dir):
    """Candidates from the posting blocks in reach, with the stored profile."""
    docs, postings, snapshot = index_and_idf(spark, sf_dir)
    blocks = materialise(blocks_ops.block_order(blocks_ops.posting_blocks(postings)), "blocks")
    profile = materialise(batch.impact_profile(postings), "profile")
    queries = table(spark, sf_dir, "benchmark")
    return batch.batch_search(queries, postings, snapshot, docs, query_col="item_id", blocks=blocks, profile=profile)


def _bucketed(spark, sf_dir) -> BucketedIndex:
    path = scratch_path(spark, "bucketed")
    name = "lexspark_" + path.rsplit("-", 1)[1]
    return BucketedIndex(spark, name, path, buckets=8).build(table(spark, sf_dir, "documents"))


def posting_weights(spark, sf_dir):
    """Frequency times IDF of every posting, from tables that are bucketed by word."""
    return _bucketed(spark, sf_dir).weights().withColumn("weight", F.round("weight", 8))


def batch_search_bucketed(spark, sf_dir):
    index = _bucketed(spark, sf_dir)
    docs, queries = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return batch.batch_search(queries, index.postings(), index.idf(), docs, query_col="item_id", profile=index.profile())


def _registered(spark, sf_dir) -> str:
    """An index as SQL views and functions; returns their prefix."""
    prefix = "lexspark_"
    docs, postings, snapshot = index_and_idf(spark, sf_dir)
    sql.register(spark, docs, postings, snapshot, prefix)
    return prefix


def sql_search(spark, sf_dir):
    p = _registered(spark, sf_dir)
    return spark.sql(f"SELECT doc_id, score, text FROM {p}search({sql.literal(SEARCH_TEXT)}, 3)")


def sql_tokens(spark, sf_dir):
    p = _registered(spark, sf_dir)
    return spark.sql(
        f"""SELECT doc_id, word, count(*) AS n
        FROM (SELECT doc_id, explode_outer(ws) AS word FROM (SELECT doc_id, {p}tokens(text) AS ws FROM {p}documents))
        WHERE word IS NOT NULL GROUP BY doc_id, word"""
    )


def sql_statements(spark, sf_dir):
    """Postings of some words with the IDF and the number of documents of each, in one statement."""
    p = _registered(spark, sf_dir)
    words = ", ".join(sql.literal(w) for w in LOOKUP_WORDS)
    return spark.sql(
        f"""SELECT t.word, t.doc_id, round(t.word_frequency, 8) AS word_frequency, round(i.idf, 8) AS idf, c.document_count
        FROM {p}postings_of(array({words})) t JOIN {p}idf i ON i.word = t.word
        JOIN (SELECT word, count(DISTINCT doc_id) AS document_count FROM {p}postings GROUP BY word) c ON c.word = t.word"""
    )


def search_as_of(spark, sf_dir):
    """Current postings with the IDF snapshot that was made when only English documents were there."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.coalesce("lang", F.lit("")).alias("lang"))
    store = new_store(spark)
    store.append(docs.filter("lang = 'en'"))
    early = store.refresh_idf()
    store.append(docs.filter("lang <> 'en'"))
    store.refresh_idf()
    store.compact()
    return store.search(SEARCH_TEXT, k=20, as_of=early)


def batch_search_everywhere(spark, sf_dir):
    """A word that all documents have, alone and among others: its weight is negative."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("everywhere "), "text").alias("text"))
    postings = materialise(index_ops.build_index(docs), "postings")
    snapshot = materialise(snapshot_of(docs, postings), "idf")
    asked = table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), F.concat("text", F.lit(" everywhere")).alias("text")
    )
    alone = asked.select((-F.col("query_id") - 1).alias("query_id"), F.lit("everywhere").alias("text"))
    return batch.batch_search(asked.unionByName(alone), postings, snapshot)


def batch_search_stale(spark, sf_dir):
    """One query per benchmark word against a snapshot that knows the words of English documents only."""
    docs = table(spark, sf_dir, "documents")
    postings = materialise(index_ops.build_index(docs), "postings")
    stale = materialise(corpus_idf(docs.filter(F.col("lang") == "en")), "idf")
    return batch.batch_search(_word_queries(spark, sf_dir), postings, stale)


def batch_search_dedupe(spark, sf_dir):
    return _batch(spark, sf_dir, k=10, dedupe_query_terms=True)


def batch_search_words(spark, sf_dir):
    """One query per word of the benchmark, repeats included: the one-word workload."""
    _, postings, snapshot = index_and_idf(spark, sf_dir)
    return batch.batch_search(_word_queries(spark, sf_dir), postings, snapshot)


def _word_queries(spark, sf_dir):
    words = index_ops.exploded_tokens(table(spark, sf_dir, "benchmark"), "item_id")
    return words.select((F.col("item_id") * 1000 + F.col("position")).alias("query_id"), F.col("word").alias("text"))


def _json_queries(spark, sf_dir):
    asked = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    stopwords = asked.select((-F.col("query_id") - 1).alias("query_id"), F.lit("to be or what").alias("text"))
    return asked.unionByName(stopwords)


def _parsed(response: DataFrame) -> DataFrame:
    schema = "message string, results array<struct<doc_id:string,score:double,text:string>>"
    parsed = response.select("query_id", F.from_json("response", schema).alias("r"))
    return parsed.select("query_id", "r.message", F.posexplode_outer("r.results").alias("position", "hit")).select(
        "query_id", "message", "position", "hit.doc_id", "hit.score", "hit.text"
    )


def search_json(spark, sf_dir):
    docs, postings, snapshot = index_and_idf(spark, sf_dir)
    queries = _json_queries(spark, sf_dir)
    results = batch.batch_search(queries, postings, snapshot, docs)
    return _parsed(search_ops.results_as_json(results, queries))


def stream_search(spark, sf_dir):
    """A stream of queries against a store, in two batches."""
    store = new_store(spark)
    store.append(table(spark, sf_dir, "documents").select("doc_id", "text"))
    store.refresh_idf()
    path, offsets = scratch_path(spark, "responses"), scratch_path(spark, "offsets")
    delivered(
        _json_queries(spark, sf_dir),
        ["query_id >= 0", "query_id < 0"],
        lambda queries: feeds.answer_queries(store, queries, path, offsets),
    )
    return _parsed(feeds.answers(spark, path))


def _search_requests(spark, sf_dir, max_bytes=None):
    log = table(spark, sf_dir, "documents").select("doc_id", F.url_encode("text").alias("raw"))
    query = decode_query(F.col("raw"))
    return log.select("doc_id", query.alias("query"), is_valid_query(query, max_bytes).alias("valid"))


def search_requests(spark, sf_dir):
    return _search_requests(spark, sf_dir)


def search_requests_short(spark, sf_dir):
    """With a limit on the length of a query."""
    return _search_requests(spark, sf_dir, 1023)


# -- documents -----------------------------------------------------------------------------------


def get_document(spark, sf_dir):
    return docs_ops.get_document(table(spark, sf_dir, "documents"), "7")


def get_documents(spark, sf_dir):
    return docs_ops.get_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def delete_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs_ops.delete_by_id(docs, table(spark, sf_dir, "labels"))


def delete_postings(spark, sf_dir):
    postings = index_ops.build_index(table(spark, sf_dir, "documents"))
    remaining = docs_ops.delete_by_id(postings, table(spark, sf_dir, "labels"))
    return remaining.withColumn("word_frequency", F.round("word_frequency", 8))


def deletion_report(spark, sf_dir):
    requested = table(spark, sf_dir, "events").select(F.col("event_id").alias("doc_id"))
    return docs_ops.deletion_report(table(spark, sf_dir, "documents"), requested)


def rejected_documents(spark, sf_dir):
    return index_ops.rejected_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _bodies(spark, sf_dir):
    """``(doc_id, body)`` rendered from the documents; other languages than English come in broken forms."""
    lang = F.col("lang")
    good = F.to_json(F.struct("text"))
    body = (
        F.when(lang == "de", F.to_json(F.struct(F.col("n_chars").alias("text"))))
        .when(lang == "fr", F.concat(F.lit("["), good, F.lit("]")))
        .when((lang == "es") & (F.col("source") < "src2"), F.substring(good, F.lit(1), F.length(good) - 1))
        .when(lang == "es", F.lit('{"title":"x"}'))
        .otherwise(good)
    )
    return table(spark, sf_dir, "documents").select("doc_id", body.alias("body"))


def json_ingest(spark, sf_dir):
    return json_docs.decode_documents(_bodies(spark, sf_dir)).select("doc_id", "text", "status")


def upsert_postings(spark, sf_dir):
    """Half the frequency for labelled documents, then a quarter for the toxic ones."""
    current = materialise(index_ops.build_index(table(spark, sf_dir, "documents")), "postings")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    tf = F.col("word_frequency")
    writes = F.array(
        F.struct(F.lit(1).alias("version"), (tf / 2).alias("word_frequency")),
        F.when(F.col("toxic") == 1, F.struct(F.lit(2).alias("version"), (tf / 4).alias("word_frequency"))),
    )
    changes = (
        current.join(labels, "doc_id")
        .select("doc_id", "word", F.explode(writes).alias("w"))
        .filter(F.col("w").isNotNull())
        .select("doc_id", "word", "w.version", "w.word_frequency")
    )
    merged = index_ops.upsert_postings(current, changes, version_col="version")
    return merged.withColumn("word_frequency", F.round("word_frequency", 8))


def new_store(spark: SparkSession) -> DocumentStore:
    return DocumentStore(spark, scratch_path(spark, "store"), id_type="bigint")


def insert_generated(spark, sf_dir):
    """Insert under new ids; per text how many documents and postings it has, rejected ones included."""
    store = DocumentStore(spark, scratch_path(spark, "store"))
    store.insert(table(spark, sf_dir, "documents").select("text"))
    seen = store.snapshot()
    words = seen.postings().groupBy("doc_id").agg(F.count(F.lit(1)).alias("_words"))
    digest = F.unhex(F.sha2("text", 256)).alias("_digest")
    rows = seen.documents().select("doc_id", digest).join(words, "doc_id", "left").unionByName(
        seen.rejected().select("doc_id", digest, F.lit(0).cast("bigint").alias("_words"))
    )
    # Ids and digests are grouped; the texts themselves move once, each at most once per task.
    counts = rows.groupBy("_digest").agg(F.count_distinct("doc_id").alias("n_documents"), F.sum("_words").alias("n_postings"))
    texts = seen.documents().select(digest, "text").unionByName(seen.rejected().select(digest, "text"))
    texts = texts.groupBy("_digest").agg(F.first("text").alias("text"))
    return texts.join(counts, "_digest").select("text", "n_documents", "n_postings")


def upsert_duplicates(spark, sf_dir):
    """All turns of a conversation come in one batch under one id; the last one counts."""
    store = new_store(spark)
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), "turn", "text")
    store.upsert(turns.withColumn("text", F.concat(F.lit("turn "), "text")), order_col="turn")
    return _rounded(store)


def store_lifecycle(spark, sf_dir):
    """Insert all, replace the labelled documents by their language tag, delete the toxic ones,
    compact; the postings that remain."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    store = new_store(spark)
    store.upsert(docs.select("doc_id", "text"))
    replaced = docs.join(labels.select("doc_id"), "doc_id", "left_semi")
    store.upsert(replaced.select("doc_id", F.concat_ws(" ", F.lit("replaced"), "lang", "text").alias("text")))
    store.delete(labels.filter(F.col("toxic") == 1).select("doc_id"))
    store.compact()
    return store.postings().withColumn("word_frequency", F.round("word_frequency", 8))


# -- logs ----------------------------------------------------------------------------------------


def pidstat_summary(spark, sf_dir):
    lines = rendered_logs.pidstat_lines(table(spark, sf_dir, "events"))
    summary = logs.pidstat_summary(lines)
    rounded = [F.round(c, 6).alias(c) for c in ("max_cpu", "mean_cpu", "median_cpu", "avg_usr", "avg_sys")]
    return summary.select("threads", "cmd", *rounded)


def pidstat_files(spark, sf_dir):
    """The same from files: the lines are written as text and read back."""
    lines = rendered_logs.pidstat_lines(table(spark, sf_dir, "events"))
    path = scratch_path(spark, "logs")
    lines.select("line", F.regexp_extract("file", "[^/]*$", 0).alias("log")).write.partitionBy("log").text(path)
    read = logs.read_lines(spark, path).withColumn("file", F.regexp_extract("file", "cpu_[0-9]+[.]log", 0))
    summary = logs.pidstat_summary(read)
    return summary.select("file", "cmd", F.round("max_cpu", 6).alias("max_cpu"), F.round("median_cpu", 6).alias("median_cpu"))


def _iostat(spark, sf_dir, num_samples=None):
    summary = logs.iostat_summary(rendered_logs.iostat_lines(table(spark, sf_dir, "events")), num_samples)
    rounded = [
        F.round(c, 6).alias(c)
        for c in (
            "cpu_avg_idle", "cpu_max_idle", "cpu_95th_idle", "disk_avg_util", "disk_max_util", "disk_95th_util",
        )
    ]
    return summary.select("file", "threads", "cpu_samples", "disk_samples", *rounded)


def iostat_summary(spark, sf_dir):
    return _iostat(spark, sf_dir)


def iostat_first_samples(spark, sf_dir):
    """Over the first 360 rows of each kind and file."""
    return _iostat(spark, sf_dir, 360)


def run_report(spark, sf_dir):
    return logs.run_report(rendered_logs.report_lines(table(spark, sf_dir, "events")))


def run_report_insert(spark, sf_dir):
    lines = rendered_logs.report_lines(table(spark, sf_dir, "events"), insert_format=True)
    return logs.run_report(lines, logs.INSERT_REPORT)


def _requests(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("run"), F.col("value").alias("latency_ms"), (F.col("user_id") % 7 != 0).alias("ok")
    )


def run_metrics(spark, sf_dir):
    metrics = logs.run_metrics(_requests(spark, sf_dir), RUN_SECONDS)
    return metrics.withColumns({c: F.round(c, 6) for c in ("throughput", "avg_latency_ms")})


def run_metrics_floor(spark, sf_dir):
    metrics = logs.run_metrics_whole_ms(_requests(spark, sf_dir), RUN_SECONDS)
    return metrics.withColumn("avg_latency_ms", F.round("avg_latency_ms", 6))


# -- generators, one row per row of a given table ------------------------------------------------


def corpus_popular(spark, sf_dir):
    return generate.generate_word_documents(table(spark, sf_dir, "documents"), seed=42)


def corpus_chars(spark, sf_dir):
    return generate.generate_character_documents(table(spark, sf_dir, "documents"), seed=42)


def query_workload(spark, sf_dir):
    ids = table(spark, sf_dir, "events").select(F.col("event_id").alias("query_id"))
    kinds = {kind: generate.generate_queries(ids, kind, seed=42) for kind in ("long_tail", "short_tail")}
    named = [queries.withColumn("workload", F.lit(kind)) for kind, queries in kinds.items()]
    return named[0].unionByName(named[1])


# -- streams, run to the end of the input ---------------------------------------------------------


def delivered(df: DataFrame, parts: list, start: Callable[[DataFrame], StreamingQuery]) -> None:
    """Runs a stream over the rows of each condition in a batch of its own, in order.

    The rows of a part are written as files of a folder, as many as there are tasks, and the stream that ``start``
    begins takes what is new there, goes on from its checkpoint and ends. Parts without rows give no batch.
    """
    path = scratch_path(df.sparkSession, "feed")
    for part in parts:
        rows = df.filter(part)
        if not rows.isEmpty():
            rows.write.mode("append").parquet(path)
            start(df.sparkSession.readStream.schema(df.schema).parquet(path)).awaitTermination()


def thirds(key: str) -> list:
    return [F.pmod(F.col(key), F.lit(3)) == i for i in range(3)]


def _ingested(spark, sf_dir, store: DocumentStore | None = None) -> DocumentStore:
    store, offsets = store or new_store(spark), scratch_path(spark, "offsets")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    delivered(docs, thirds("doc_id"), lambda stream: feeds.ingest_documents(store, stream, offsets))
    return store


def _rounded(store: DocumentStore) -> DataFrame:
    return store.postings().withColumn("word_frequency", F.round("word_frequency", 8))


def stream_ingest_tf(spark, sf_dir):
    return _rounded(_ingested(spark, sf_dir))


def stream_two_feeds(spark, sf_dir):
    """Documents and conversation turns come in two feeds without names into one store."""
    store = _ingested(spark, sf_dir)
    turns = table(spark, sf_dir, "conversations").select(
        (-1000 * F.col("conv_id") - F.col("turn") - 1).alias("doc_id"), "text"
    )
    offsets = scratch_path(spark, "offsets")
    delivered(turns, thirds("doc_id"), lambda stream: feeds.ingest_documents(store, stream, offsets))
    return _rounded(store)


def _deleted(spark, sf_dir) -> DocumentStore:
    store = _ingested(spark, sf_dir)
    ids = table(spark, sf_dir, "labels").select("doc_id")
    offsets = scratch_path(spark, "offsets")
    delivered(ids, thirds("doc_id"), lambda stream: feeds.delete_documents(store, stream, offsets))
    return store


def stream_deletes(spark, sf_dir):
    return _rounded(_deleted(spark, sf_dir))


def stream_changes(spark, sf_dir):
    """Turns as changes of their conversation: every fourth deletes it, the others replace its text."""
    store = new_store(spark)
    turn = F.col("turn")
    changes = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("doc_id"),
        F.concat(F.lit("turn "), "text").alias("text"),
        F.when(turn % 4 == 3, "delete").otherwise("upsert").alias("op"),
        turn.alias("seq"),
    )
    parts, offsets = ["seq < 2", "seq >= 2 AND seq < 4", "seq >= 4"], scratch_path(spark, "offsets")
    delivered(changes, parts, lambda stream: feeds.apply_changes(store, stream, offsets))
    return _rounded(store)


def stream_json(spark, sf_dir):
    """JSON bodies from files into a store; what became of them."""
    path = scratch_path(spark, "bodies")
    _bodies(spark, sf_dir).select("body").write.text(path)
    store = DocumentStore(spark, scratch_path(spark, "store"))
    stream = spark.readStream.text(path).withColumnRenamed("value", "body")
    feeds.ingest_json(store, stream, scratch_path(spark, "offsets")).awaitTermination()
    seen = store.snapshot()
    kept = seen.documents().select(F.lit("accepted").alias("status"), "text")
    lost = seen.rejected().select(F.col("reason").alias("status"), F.lit("").alias("text"))
    return kept.unionByName(lost).groupBy("status", "text").agg(F.count(F.lit(1)).alias("n"))


def stream_idf(spark, sf_dir):
    """After inserts, upserts and deletes: the counts of all changes, less what is hidden."""
    store = _deleted(spark, sf_dir)
    docs = table(spark, sf_dir, "documents")
    again = docs.filter(F.col("doc_id") % 5 == 0).join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_anti")
    store.upsert(again.select("doc_id", F.concat_ws(" ", F.lit("again"), "text").alias("text")))
    ticks = table_stream(spark, sf_dir, "labels").select("doc_id")
    feeds.refresh_idf(store, ticks, scratch_path(spark, "offsets")).awaitTermination()
    return store.idf().select("word", F.round("idf", 8).alias("idf"))


def _saved_updates(counts: DataFrame, sink: str, offsets: str) -> StreamingQuery:
    """A running stream that keeps the updates of every batch under ``sink/batch=<number>``."""

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")

    writer = counts.writeStream.outputMode("update").option("checkpointLocation", offsets)
    return writer.trigger(availableNow=True).foreachBatch(save).start()


def stream_df(spark, sf_dir):
    counts = feeds.running_document_frequency(table_stream(spark, sf_dir, "documents"))
    sink = scratch_path(spark, "running-df")
    _saved_updates(counts, sink, scratch_path(spark, "df-offsets")).awaitTermination()
    return feeds.latest_counts(spark.read.parquet(sink))


def stream_df_changes(spark, sf_dir):
    """All documents come, every fifth twice; then the labelled ones go."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    start = 1_700_000_000
    at = lambda second: F.timestamp_seconds(F.lit(start + second))
    came = docs.select(F.concat(F.lit("+"), "doc_id").alias("change_id"), "text", F.lit(1).alias("delta"), at(0).alias("at"))
    again = came.filter(F.pmod(F.xxhash64("change_id"), F.lit(5)) == 0).withColumn("at", at(60))
    gone = docs.join(table(spark, sf_dir, "labels").select("doc_id").distinct(), "doc_id", "left_semi").select(
        F.concat(F.lit("-"), "doc_id").alias("change_id"), "text", F.lit(-1).alias("delta"), at(120).alias("at")
    )
    changes = came.unionByName(again).unionByName(gone)
    sink, offsets = scratch_path(spark, "running-df"), scratch_path(spark, "df-offsets")
    parts = [(F.col("delta") == d) & (F.col("at") == at(t)) for d, t in ((1, 0), (1, 60), (-1, 120))]
    delivered(changes, parts, lambda s: _saved_updates(feeds.running_frequency_of_changes(s), sink, offsets))
    return feeds.last_counts(spark.read.parquet(sink))


QUERIES = {
    f.__name__: f
    for f in (
        tokens, token_positions, doc_lengths, term_frequency, term_frequency_stored, page_term_frequency,
        postings_for_words, corpus_stats, document_frequency, document_frequency_raw, idf, idf_merge_stale,
        search_top3, search_repeat_warm, search_repeat_cold, search_stale_idf, search_no_match,
        batch_search_top3, batch_search_direct, batch_search_dedupe, batch_search_words, batch_search_everywhere,
        batch_search_stale, search_json, search_requests, search_requests_short, get_document, get_documents, delete_documents, delete_postings, deletion_report,
        rejected_documents, json_ingest, upsert_postings, insert_generated, upsert_duplicates, store_lifecycle,
        pidstat_summary, pidstat_files, iostat_summary, iostat_first_samples,
        run_report, run_report_insert, run_metrics, run_metrics_floor, corpus_popular, corpus_chars,
        document_frequency_estimate, vocabulary_estimate, postings_blocks, batch_search_blocks, posting_weights,
        batch_search_bucketed, sql_search, sql_tokens, sql_statements, search_as_of, stream_search, stream_df_changes,
        query_workload, stream_ingest_tf, stream_two_feeds, stream_deletes, stream_changes, stream_json, stream_idf,
        stream_df,
    )
}
