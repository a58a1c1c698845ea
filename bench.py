"""Headline timings. Prints one JSON line.

``BENCH_SF_DIR`` (default sf0.1) names the tables, ``BENCH_CPUS`` (default 8) the local cores. The tables
are first laid out in one file per core, as tables of normal size have more files than cores. Every
entry then runs once to warm up and once timed, over the whole tables.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

from lexspark.operators.batch_search import batch_search
from lexspark.operators.idf import document_frequency, idf_snapshot, indexed_document_count
from lexspark.operators.index import build_index
from lexspark.operators.search import search
from lexspark.plans import catalog
from lexspark.session import local_session, materialise, scratch_path
from lexspark.sources.generate import generate_character_documents, generate_queries, generate_word_documents
from lexspark.sources.store import DocumentStore

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

#: Registered queries timed as they are.
TIMED = (
    "document_frequency", "idf", "upsert_postings", "delete_postings", "json_ingest", "pidstat_summary",
    "iostat_summary", "run_report", "run_metrics", "stream_ingest_tf", "stream_df",
)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = local_session("lexspark-bench", CPUS)
    sf_dir = scratch_path(spark, "bench-tables")
    for name in ("documents", "benchmark", "labels", "conversations", "events", "pages"):
        table = catalog.table(spark, SF_DIR, name)
        table.repartition(int(CPUS)).write.parquet(f"{sf_dir}/{name}.parquet")
    docs = catalog.table(spark, sf_dir, "documents")
    ids = docs.select("doc_id")
    seconds: dict[str, float] = {}

    def timed(name, action):
        action()
        start = time.perf_counter()
        result = action()
        seconds[name] = round(time.perf_counter() - start, 3)
        return result

    def snapshot(postings):
        total = indexed_document_count(postings).scalar()
        return materialise(idf_snapshot(document_frequency(postings), total), "bench-idf")

    # Corpus: index, IDF, single and batch search.
    postings = timed("index_build", lambda: materialise(build_index(docs), "bench-postings"))
    idf = timed("idf_build", lambda: snapshot(postings))
    timed("search_top3", lambda: search(catalog.SEARCH_TEXT, postings, idf, docs).collect())
    queries = catalog.table(spark, sf_dir, "benchmark")
    timed("batch_search_top3", lambda: run(batch_search(queries, postings, idf, docs, query_col="item_id")))
    timed(
        "batch_search_direct",
        lambda: run(batch_search(queries, postings, idf, docs, query_col="item_id", strategy="direct")),
    )

    # The one-word workload over generated documents, one query per event.
    made = materialise(generate_word_documents(ids, seed=1), "bench-corpus")
    made_postings = materialise(build_index(made), "bench-postings")
    made_idf = snapshot(made_postings)
    events = catalog.table(spark, sf_dir, "events").select(F.col("event_id").alias("query_id"))
    asked = {kind: generate_queries(events, kind, seed=1) for kind in ("short_tail", "long_tail")}
    for kind, workload in asked.items():
        timed(f"batch_search_{kind}", lambda w=workload: run(batch_search(w, made_postings, made_idf, made)))
    distinct = {kind: workload.select("text").distinct().count() for kind, workload in asked.items()}

    # Insert of random 1,000-character documents into a store.
    random_docs = materialise(generate_character_documents(ids, seed=1), "bench-characters")
    timed("store_insert", lambda: DocumentStore(spark, scratch_path(spark, "bench-store")).insert(random_docs))

    for name in TIMED:
        timed(name, lambda name=name: run(catalog.QUERIES[name](spark, sf_dir)))

    n_docs, n_queries = docs.count(), events.count()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                "per_second": {
                    "documents_indexed": round(n_docs / seconds["index_build"], 1),
                    "documents_inserted": round(n_docs / seconds["store_insert"], 1),
                    **{
                        f"{kind}_{what}": round(n / seconds[f"batch_search_{kind}"], 1)
                        for kind in asked
                        for what, n in (("queries", n_queries), ("distinct_searches", distinct[kind]))
                    },
                },
            }
        )
    )


if __name__ == "__main__":
    main()
