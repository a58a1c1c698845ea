"""The registered queries against their SQL, and the pipeline."""

import duckdb
import pytest

import corpus_pipeline
from lexspark.llm.queries import QUERIES
from lexspark.llm.sql import ORACLES
from lexspark.session import materialise


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    duck = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "embeddings"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    answer = duck.execute(ORACLES[name])
    names = [d[0] for d in answer.description]
    result = QUERIES[name](spark, sf_dir)
    assert sorted(result.columns) == sorted(names)
    key = lambda row: tuple(str(x) for x in row)
    want = sorted(answer.fetchall(), key=key)
    assert sorted((tuple(r[c] for c in names) for r in result.collect()), key=key) == want


def test_there_is_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_stages_keep_columns_and_clean_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = {r["doc_id"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 1").collect()}
    columns, before = docs.columns, {r["doc_id"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), "stage")
        assert docs.columns == columns
        ids = [r["doc_id"] for r in docs.collect()]
        assert len(ids) == len(set(ids)) and set(ids) <= before
        if name == "language id":
            assert len(set(ids) & labels) >= 0.98 * len(before & labels)
        if name == "mixing":
            assert set(ids) == before
        before = set(ids)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {p["doc_id"] for p in pieces} == before
    whole = {(p["doc_id"], p["start"], p["length"]) for p in corpus_pipeline.run(spark, sf_dir).collect()}
    assert sum(length for _, _, length in whole) == sum(p["length"] for p in pieces)


def test_stages_take_empty_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, sf_dir), "stage")
        assert docs.count() == 0
