import json

import models
import pytest
from pyspark.sql import functions as F

from lexspark.session import scratch_path
from lexspark.sources.store import DocumentStore
from lexspark.streaming import feeds

SCHEMA = "doc_id bigint, text string"
DOCS = [(i, f"word{i % 7} common text{i}" if i % 5 else "the of") for i in range(40)]


@pytest.fixture
def store(spark):
    return DocumentStore(spark, scratch_path(spark, "store"), id_type="bigint")


def feed(spark, rows, schema, files=3):
    """A file stream that delivers the rows in several batches."""
    path = scratch_path(spark, "feed")
    for i in range(files):
        spark.createDataFrame(rows[i::files], schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def postings_of(store):
    return {(r.doc_id, r.word): r.word_frequency for r in store.postings().collect()}


def test_ingest_equals_batch_and_replay_changes_nothing(spark, store, monkeypatch):
    stream, offsets = feed(spark, DOCS, SCHEMA), scratch_path(spark, "offsets")
    publish, calls = store._publish, []

    def fails_once(*entry):
        publish(*entry)
        calls.append(entry)
        if len(calls) == 2:
            raise RuntimeError("lost after the change was made")

    monkeypatch.setattr(store, "_publish", fails_once)
    with pytest.raises(Exception, match="lost after"):
        feeds.ingest_documents(store, stream, offsets).awaitTermination()
    # The same checkpoint delivers the batch that failed again, under its number.
    feeds.ingest_documents(store, stream, offsets).awaitTermination()
    assert len(store.commits()) == 3
    assert postings_of(store) == models.index(DOCS)


def test_two_feeds_without_names_keep_all(spark, store):
    more = [(i + 100, text) for i, text in DOCS]
    for rows in (DOCS, more):
        feeds.ingest_documents(store, feed(spark, rows, SCHEMA), scratch_path(spark, "offsets")).awaitTermination()
    assert len(store.commits()) == 6
    assert postings_of(store) == models.index(DOCS + more)


def test_json_ingest(spark):
    store = DocumentStore(spark, scratch_path(spark, "store"))
    bodies = [(json.dumps({"text": t}),) for _, t in DOCS] + [("broken",), ("[]",)]
    feeds.ingest_json(store, feed(spark, bodies, "body string"), scratch_path(spark, "offsets")).awaitTermination()
    assert sorted(r.text for r in store.documents().collect()) == sorted(t for _, t in DOCS if models.tokens(t))


def test_delete_feed_and_idf_refresh(spark, store):
    feeds.ingest_documents(store, feed(spark, DOCS, SCHEMA), scratch_path(spark, "offsets")).awaitTermination()
    gone = [(i,) for i in range(0, 40, 3)]
    feeds.delete_documents(store, feed(spark, gone, "doc_id bigint"), scratch_path(spark, "offsets")).awaitTermination()
    left = [d for d in DOCS if d[0] % 3]
    assert postings_of(store) == models.index(left)
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 5).load()
    refresh = feeds.refresh_idf(store, ticks, scratch_path(spark, "offsets"), processingTime="1 second")
    while not any(c["kind"] == "idf" for c in store.commits()):
        refresh.awaitTermination(1)
    refresh.stop()
    assert {r.word: r.idf for r in store.idf().collect()} == pytest.approx(models.idf(models.index(left)))


def test_change_feed(spark, store):
    schema = SCHEMA + ", op string, seq int"
    rows = [(1, "apple", "upsert", 1), (1, None, "delete", 2), (2, "pear", "upsert", 3), (2, "plum", "upsert", 4)]
    feeds.apply_changes(store, feed(spark, rows, schema, files=1), scratch_path(spark, "offsets")).awaitTermination()
    assert postings_of(store) == {(2, "plum"): 1.0}


def test_running_document_frequency_ignores_repeats(spark):
    counts = feeds.running_document_frequency(feed(spark, DOCS + DOCS[:10], SCHEMA))
    sink = scratch_path(spark, "counts")

    def save(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")

    (
        counts.writeStream.outputMode("update").option("checkpointLocation", scratch_path(spark, "offsets"))
        .trigger(availableNow=True).foreachBatch(save).start().awaitTermination()
    )
    got = {r.word: r.document_count for r in feeds.latest_counts(spark.read.parquet(sink)).collect()}
    want = {}
    for _, word in models.index(DOCS):
        want[word] = want.get(word, 0) + 1
    assert got == want


def test_queries_are_answered_once_from_the_present_store(spark, store, monkeypatch):
    store.append(spark.createDataFrame(DOCS, SCHEMA))
    store.refresh_idf()
    path, offsets, folder = scratch_path(spark, "responses"), scratch_path(spark, "offsets"), scratch_path(spark, "asked")
    schema = "query_id bigint, text string"
    assert feeds.answers(spark, path).count() == 0

    def ask(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(schema).parquet(folder)
        feeds.answer_queries(store, stream, path, offsets).awaitTermination()

    ask((1, "word1 common"), (2, "the of"), (3, "fresh"))
    search, calls = store.batch_search, []

    def counted(*args, **options):
        calls.append(1)
        return search(*args, **options)

    monkeypatch.setattr(store, "batch_search", counted)
    store.append(spark.createDataFrame([(100, "fresh fruit")], SCHEMA))
    ask((4, "fresh"))
    assert len(calls) == 1
    got = {r.query_id: json.loads(r.response) for r in feeds.answers(spark, path).collect()}
    want = [{"doc_id": str(r.doc_id), "score": r.score, "text": r.text} for r in store.search("word1 common").collect()]
    assert [h["doc_id"] for h in got[1]["results"]] == [h["doc_id"] for h in want]
    assert got[2] == got[3] == {"message": "No documents found", "results": []}
    assert [h["doc_id"] for h in got[4]["results"]] == ["100"]


def test_a_replayed_batch_of_queries_gives_no_second_answer(spark, store):
    store.append(spark.createDataFrame(DOCS, SCHEMA))
    store.refresh_idf()
    path, offsets = scratch_path(spark, "responses"), scratch_path(spark, "offsets")
    queries = feed(spark, [(1, "word1"), (2, "word2")], "query_id bigint, text string", files=1)
    batches, insert = [], store.batch_search

    def fails_late(*args, **options):
        batches.append(1)
        return insert(*args, **options)

    store.batch_search = fails_late
    first = feeds.answer_queries(store, queries, path, offsets)
    first.awaitTermination()
    commits = spark._jvm.org.apache.hadoop.fs.Path(f"{offsets}/commits/0")
    commits.getFileSystem(spark._jsc.hadoopConfiguration()).delete(commits, False)  # as if lost after the answers
    feeds.answer_queries(store, queries, path, offsets).awaitTermination()
    assert len(batches) == 1 and feeds.answers(spark, path).count() == 2


def test_running_counts_take_deletions_back(spark):
    schema = "change_id string, text string, delta int, second long"
    came = [(f"+{i}", text, 1, 0) for i, text in DOCS]
    again = [(c, t, d, 60) for c, t, d, _ in came[:15]]
    gone = [(f"-{i}", text, -1, 120) for i, text in DOCS if i % 3 == 0]
    late = [("+0", DOCS[0][1], 1, 0), ("+900", "late words", 1, 0)]
    path, offsets, sink = scratch_path(spark, "feed"), scratch_path(spark, "offsets"), scratch_path(spark, "counts")
    kept_states = []
    for rows in (came, again, gone, [("+901", "new", 1, 50_000)], late):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(schema).parquet(path)
        stream = stream.select("change_id", "text", "delta", F.timestamp_seconds(F.col("second") + 1_700_000_000).alias("at"))

        def save(batch, batch_id):
            batch.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")

        query = (
            feeds.running_frequency_of_changes(stream).writeStream.outputMode("update")
            .option("checkpointLocation", offsets).trigger(availableNow=True).foreachBatch(save).start()
        )
        query.awaitTermination()
        kept_states.append(query.lastProgress["stateOperators"][-1]["numRowsTotal"])
    want = {"new": 1}
    for _, word in models.index([(i, t) for i, t in DOCS if i % 3]):
        want[word] = want.get(word, 0) + 1
    got = {r.word: r.document_count for r in feeds.last_counts(spark.read.parquet(sink)).collect()}
    assert got == want
    assert max(kept_states[:3]) >= len(DOCS) > kept_states[-1]  # ids are forgotten after the delay
