import math

import models
import pytest
from pyspark.sql import functions as F

from lexspark.operators import documents as docs_ops
from lexspark.operators import idf as idf_ops
from lexspark.operators import index as index_ops

DOCS = [
    (1, "apple apple pear"),
    (2, "apple banana"),
    (3, "The of"),
    (4, "Apple! cherry cherry cherry"),
    (5, "apple"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id bigint, text string")


def as_dict(df, *keys, value):
    return {tuple(r[k] for k in keys): r[value] for r in df.collect()}


def test_postings_equal_the_model(docs):
    built = as_dict(index_ops.build_index(docs), "doc_id", "word", value="word_frequency")
    assert built == models.index(DOCS)


def test_index_of_real_texts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    built = as_dict(index_ops.build_index(docs), "doc_id", "word", value="word_frequency")
    assert built == models.index(rows)


def test_frequencies_of_a_document_sum_to_one(spark, sf_dir):
    postings = index_ops.build_index(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    sums = postings.groupBy("doc_id").agg(F.sum("word_frequency").alias("s")).collect()
    assert all(abs(r.s - 1) < 1e-9 for r in sums)


def test_stored_precision_rounds_half_to_even(spark):
    text = " ".join(f"w{i}" for i in range(128))
    docs = spark.createDataFrame([(1, text)], "doc_id int, text string")
    row = index_ops.build_index(docs, stored_precision=True).first()
    assert row.word_frequency == pytest.approx(0.007812, abs=1e-9)


def test_partitioning_does_not_matter(docs):
    once = sorted(map(tuple, index_ops.build_index(docs.coalesce(1)).collect()))
    many = sorted(map(tuple, index_ops.build_index(docs.repartition(7)).collect()))
    assert once == many


def test_lengths_acceptance_and_lists(docs):
    assert as_dict(index_ops.document_lengths(docs), "doc_id", value="total_words") == {(1,): 3, (2,): 2, (4,): 4, (5,): 1}
    assert [r.doc_id for r in index_ops.rejected_documents(docs).collect()] == [3]
    assert index_ops.accepted_documents(docs).count() == 4
    postings = index_ops.build_index(docs)
    assert index_ops.postings_lists(postings, []).count() == 0
    assert {r.doc_id for r in index_ops.postings_lists(postings, ["pear", "banana"]).collect()} == {1, 2}


def test_upsert_postings(spark):
    schema = "doc_id int, word string, word_frequency double"
    old = spark.createDataFrame([(1, "a", 0.5), (1, "b", 0.5), (2, "a", 1.0)], schema)
    new = spark.createDataFrame(
        [(1, "a", 0.1, 1), (1, "a", 0.2, 2), (3, "c", 1.0, 1)], schema + ", version int"
    )
    merged = as_dict(index_ops.upsert_postings(old, new, version_col="version"), "doc_id", "word", value="word_frequency")
    assert merged == {(1, "a"): 0.2, (1, "b"): 0.5, (2, "a"): 1.0, (3, "c"): 1.0}
    again = index_ops.upsert_postings(
        index_ops.upsert_postings(old, new, version_col="version"), new, version_col="version"
    )
    assert as_dict(again, "doc_id", "word", value="word_frequency") == merged


def test_document_access(spark, docs):
    assert [r.text for r in docs_ops.get_document(docs, 2).collect()] == ["apple banana"]
    assert docs_ops.get_document(docs, "99").count() == 0
    assert docs_ops.get_document(docs, "not-an-id").count() == 0
    ids = spark.createDataFrame([(1,), (1,), (9,)], "doc_id bigint")
    assert docs_ops.get_documents(docs, ids).count() == 1
    assert docs_ops.delete_by_id(docs, ids).count() == 4
    assert as_dict(docs_ops.deletion_report(docs, ids), "doc_id", value="deleted") == {(1,): True, (9,): False}


def test_idf_values_and_signs(docs):
    postings = index_ops.build_index(docs)
    built = as_dict(
        idf_ops.build_idf(idf_ops.document_frequency(postings), idf_ops.indexed_document_count(postings)), "word", value="idf"
    )
    assert built[("pear",)] == pytest.approx(math.log(2))
    assert built[("apple",)] == pytest.approx(math.log(0.8)) and built[("apple",)] < 0
    counted = idf_ops.build_idf(idf_ops.document_frequency(postings), 2)
    assert as_dict(counted, "word", value="idf")[("pear",)] == 0.0
    assert idf_ops.build_idf(idf_ops.document_frequency(postings), 0).count() == 0


def test_document_frequency_of_raw_tokens(docs):
    raw = idf_ops.document_frequency(index_ops.exploded_tokens(docs), unique=False)
    indexed = idf_ops.document_frequency(index_ops.build_index(docs))
    assert sorted(map(tuple, raw.collect())) == sorted(map(tuple, indexed.collect()))


def test_merge_idf_keeps_vanished_words(spark):
    old = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "word string, idf double")
    new = spark.createDataFrame([("b", 3.0), ("c", 4.0)], "word string, idf double")
    assert as_dict(idf_ops.merge_idf(old, new), "word", value="idf") == {("a",): 1.0, ("b",): 3.0, ("c",): 4.0}


def test_build_index_does_not_shuffle(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = index_ops.build_index(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
