"""Structured Streaming jobs: continuous ingest, deletes, searches, IDF refresh and running counts.

The store jobs run in ``foreachBatch``. The key of a change is the stream's id, which its checkpoint keeps, and the
batch number: a batch that is replayed after a failure changes nothing twice, and two feeds never
share a key, whatever they are called.
"""

from __future__ import annotations

import uuid
from concurrent.futures import Future
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lexspark.functions.text import tokens
from lexspark.operators.search import DEFAULT_K, results_as_json
from lexspark.session import materialise
from lexspark.sources.store import DocumentStore


def _start(stream: DataFrame, name: str | None, checkpoint: str, apply: Any, trigger: dict[str, Any]) -> StreamingQuery:
    started: Future[str] = Future()

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        apply(batch, f"{started.result()}-{batch_id}")

    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(**trigger).foreachBatch(on_batch)
    query = (writer.queryName(name) if name else writer).start()
    started.set_result(query.id)
    return query


def ingest_documents(
    store: DocumentStore,
    documents: DataFrame,
    checkpoint: str,
    name: str | None = None,
    replace: bool = True,
    order_col: str | None = None,
    **trigger: Any,
) -> StreamingQuery:
    """Index a stream of ``(doc_id, text)`` under the given ids.

    ``replace=False`` is for feeds whose ids are always new: it records no deletions. Of rows with one id in
    a batch the last by ``order_col`` counts; without it they are an error.
    """

    def apply(batch: DataFrame, key: str) -> None:
        if replace:
            store.upsert(batch, key, order_col)
        else:
            store.append(batch, key)

    return _start(documents, name, checkpoint, apply, trigger or {"availableNow": True})


def ingest_json(
    store: DocumentStore, bodies: DataFrame, checkpoint: str, name: str | None = None, **trigger: Any
) -> StreamingQuery:
    """Index a stream of JSON bodies ``(body)`` under new ids."""
    return _start(bodies, name, checkpoint, store.insert_json, trigger or {"availableNow": True})


def delete_documents(
    store: DocumentStore, ids: DataFrame, checkpoint: str, name: str | None = None, **trigger: Any
) -> StreamingQuery:
    """Delete the documents named by a stream of ``(doc_id)``."""
    return _start(ids, name, checkpoint, store.delete, trigger or {"availableNow": True})


def apply_changes(
    store: DocumentStore, changes: DataFrame, checkpoint: str, name: str | None = None, **trigger: Any
) -> StreamingQuery:
    """Apply a stream of ``(doc_id, text, op, seq)``; per batch the last operation per id counts."""
    return _start(changes, name, checkpoint, store.apply_changes, trigger or {"availableNow": True})


def refresh_idf(
    store: DocumentStore,
    ticks: DataFrame,
    checkpoint: str,
    name: str | None = None,
    retain_missing: bool = False,
    **trigger: Any,
) -> StreamingQuery:
    """Write an IDF snapshot for every batch of ``ticks``, at once and then at the trigger's pace.

    To refresh by time, deletes alone included, pass a stream that always has rows, such as
    ``spark.readStream.format("rate").load()``, and ``processingTime``; with a feed of documents as ticks
    the snapshot follows the feed.
    """

    def refresh(_: DataFrame, key: str) -> None:
        store.refresh_idf(retain_missing, key)

    return _start(ticks, name, checkpoint, refresh, trigger or {"availableNow": True})


def answer_queries(
    store: DocumentStore, queries: DataFrame, path: str, checkpoint: str, k: int = DEFAULT_K, name: str | None = None, **trigger: Any
) -> StreamingQuery:
    """Answer a stream of ``(query_id, text)`` against the store, with JSON responses under ``path``.

    Every batch reads the store anew, so later queries see documents that came meanwhile. A batch is answered
    as a whole: its rows lie in a folder of their own, which one row of ``path/answered`` names with the key of
    the batch. A replayed batch finds its key there and is not answered again.
    """
    spark = store.spark

    def apply(batch: DataFrame, key: str) -> None:
        if not _answered(spark, path).filter(F.col("key") == key).isEmpty():
            return
        folder = uuid.uuid4().hex
        asked = materialise(batch.select("query_id", "text"), "asked-queries")
        results = store.batch_search(asked, k)
        results_as_json(results, asked).write.parquet(f"{path}/answers/{folder}")
        row = spark.createDataFrame([(key, folder)], "key string, folder string")
        row.coalesce(1).withColumn("answered_at", F.current_timestamp()).write.mode("append").parquet(f"{path}/answered")

    return _start(queries, name, checkpoint, apply, trigger or {"availableNow": True})


def _answered(spark: SparkSession, path: str) -> DataFrame:
    schema = "key string, folder string, answered_at timestamp"
    try:
        return spark.read.schema(schema).parquet(f"{path}/answered")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def answers(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """``(query_id, response, key, answered_at)`` of all batches that were answered as a whole."""
    known = _answered(spark, path)
    if known.isEmpty():
        return spark.createDataFrame([], f"query_id {id_type}, response string, key string, answered_at timestamp")
    rows = spark.read.schema(f"query_id {id_type}, response string").parquet(f"{path}/answers/*")
    folder = F.regexp_extract(F.col("_metadata.file_path"), "/answers/([0-9a-f]+)/", 1)
    placed = rows.select("query_id", "response", folder.alias("folder"))
    return placed.join(F.broadcast(known), "folder").drop("folder")


def running_document_frequency(documents: DataFrame) -> DataFrame:
    """``(word, document_count)`` of a stream of documents, as a stateful aggregation.

    A document brings each of its words once, so only ids have to be remembered to ignore
    documents that arrive again. That state holds every id of the stream, some tens of bytes each, and never
    shrinks; for feeds without end use ``refresh_idf``, whose counts live in the store and which also
    takes back deleted documents.
    """
    first_seen = documents.dropDuplicates(["doc_id"])
    words = first_seen.select(F.explode_outer(F.array_distinct(tokens(F.col("text")))).alias("word"))
    return words.filter(F.col("word").isNotNull()).groupBy("word").agg(F.count(F.lit(1)).alias("document_count"))


def latest_counts(updates: DataFrame) -> DataFrame:
    """Newest count per word from the collected updates of ``running_document_frequency``. Counts
    only grow, so the newest is the largest."""
    return updates.groupBy("word").agg(F.max("document_count").alias("document_count"))


def running_frequency_of_changes(changes: DataFrame, delay: str = "1 hour") -> DataFrame:
    """``(word, document_count)`` of a stream of changes, deletions taken back.

    ``changes`` are ``(change_id, text, delta, at)``: ``delta`` is 1 for a document that came and -1 for one that went
    (with the text it had), ``at`` the time of the change. A change that is delivered again within ``delay`` counts
    once, and one that comes later than that is late and left out; so ids are remembered for ``delay`` only and
    the state besides is one number per word.
    """
    once = changes.withWatermark("at", delay).dropDuplicatesWithinWatermark(["change_id"])
    words = once.select("delta", F.explode_outer(F.array_distinct(tokens(F.col("text")))).alias("word"))
    return words.filter(F.col("word").isNotNull()).groupBy("word").agg(F.sum("delta").alias("document_count"))


def last_counts(updates: DataFrame, batch_col: str = "batch") -> DataFrame:
    """The count per word of the last batch that changed it; words that no document has any more are left out."""
    last = updates.groupBy("word").agg(F.max_by("document_count", batch_col).alias("document_count"))
    return last.filter("document_count > 0")
