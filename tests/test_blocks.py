"""Posting blocks, bucketed tables and SQL functions against the plain forms."""

import models
import pytest
from pyspark.sql import functions as F

from lexspark.functions import sql
from lexspark.operators import blocks as blocks_ops
from lexspark.operators import idf as idf_ops
from lexspark.operators.batch_search import batch_search, impact_profile
from lexspark.operators.index import build_index, exploded_tokens
from lexspark.operators.search import search
from lexspark.session import materialise, scratch_path
from lexspark.sources import bucketed, generate
from lexspark.sources.bucketed import BucketedIndex

DOCS = [(i, " ".join([f"w{i % 5}"] * (i % 7 + 1) + ["common"] * (i % 3 + 1) + [f"x{i}", f"y{i % 11}"])) for i in range(120)]
QUERIES = [(1, "common w1 w2"), (2, "x7 y3"), (3, "w4 w4 nothing"), (4, "the of"), (5, "unknown"), (6, "common")]


@pytest.fixture(scope="module")
def index(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    postings = materialise(build_index(docs), "postings")
    total = F.lit(len(DOCS))
    return docs, postings, materialise(idf_ops.idf_snapshot(idf_ops.document_frequency(postings), total), "idf")


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_blocks_hold_all_postings_by_falling_frequency(index):
    _, postings, _ = index
    blocks = blocks_ops.posting_blocks(postings, block_postings=8)
    assert rows_of(blocks_ops.long_form(blocks)) == rows_of(postings)
    by_word = {}
    for row in blocks.collect():
        by_word.setdefault(row["word"], []).append(row)
    assert len(by_word["common"]) == 15
    for parts in by_word.values():
        parts.sort(key=lambda r: r["block"])
        entries = [(-p["word_frequency"], p["doc_id"]) for r in parts for p in r["postings"]]
        assert entries == sorted(entries) and all(r["n"] == 8 for r in parts[:-1])
        for r in parts:
            found = [p["word_frequency"] for p in r["postings"]]
            assert (r["n"], r["tf_max"], r["tf_min"]) == (len(found), max(found), min(found))
    assert blocks_ops.posting_blocks(postings.limit(0)).count() == 0


@pytest.mark.parametrize("k", [1, 3, 50])
def test_search_over_blocks_equals_direct(spark, index, k):
    docs, postings, idf = index
    queries = spark.createDataFrame(QUERIES, "query_id int, text string")
    blocks = materialise(blocks_ops.block_order(blocks_ops.posting_blocks(postings, block_postings=8)), "blocks")
    want = rows_of(batch_search(queries, postings, idf, docs, k, strategy="direct"))
    for options in ({"blocks": blocks}, {"blocks": blocks, "profile": impact_profile(postings)}, {}):
        assert rows_of(batch_search(queries, postings, idf, docs, k, **options)) == want


def test_bucketed_tables_join_without_moving_postings(spark, index):
    docs, postings, idf = index
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = BucketedIndex(spark, "test_bucketed", scratch_path(spark, "bucketed"), buckets=4).build(docs)
        weights = stored.weights()
        plan = weights._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        counted = idf_ops.document_frequency(stored.postings())._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in counted
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert rows_of(stored.postings().select("doc_id", "word", "word_frequency")) == rows_of(postings)
    values = {r["word"]: r["idf"] for r in idf.collect()}
    got = {(r["doc_id"], r["word"]): r["weight"] for r in weights.collect()}
    assert got == {(d, w): tf * values[w] for d, w, tf in rows_of(postings)}


def test_sql_functions_equal_the_library(spark, index):
    docs, postings, idf = index
    sql.register(spark, docs, postings, idf, "t_")
    for text in ("The Quick, it's a fox-hole\tx", "", "common w1 w1 \\ ' \" z_z", "Ünï É"):
        got = spark.sql(f"SELECT t_tokens({sql.literal(text)}) AS t").first()["t"]
        assert got == models.tokens(text)
    assert spark.sql("SELECT t_tokens(NULL) AS t").first()["t"] == []
    for query, k in (("common w1 w1 x7", 5), ("the of", 3), ("unknown", 3), ("y3", 0)):
        found = spark.sql(f"SELECT * FROM t_search({sql.literal(query)}, {k})")
        assert rows_of(found) == rows_of(search(query, postings, idf, docs, k))
    lists = spark.sql("SELECT doc_id, word, word_frequency FROM t_postings_of(array('x7', 'y3', 'y3', 'none'))")
    assert rows_of(lists) == rows_of(postings.filter("word IN ('x7', 'y3')"))
    tf = {r["word"]: r["word_frequency"] for r in spark.sql("SELECT * FROM t_term_frequencies('b b c the')").collect()}
    assert tf == {"b": 2 / 3, "c": 1 / 3}


def test_sketches_of_changes_merge(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    raw = exploded_tokens(docs)
    halves = [idf_ops.document_sketches(raw.filter(f)) for f in ("doc_id < 70", "doc_id >= 50")]  # 20 ids are in both
    merged = idf_ops.estimated_frequency(idf_ops.merge_sketches(halves[0].unionByName(halves[1])))
    exact = {r["word"]: r["document_count"] for r in idf_ops.document_frequency(raw, unique=False).collect()}
    got = {r["word"]: r["document_count"] for r in merged.collect()}
    assert set(got) == set(exact)
    assert all(abs(got[w] - n) <= 1 + n * idf_ops.sketch_error() for w, n in exact.items())
    vocabulary = idf_ops.estimated_vocabulary(raw).first()[0]
    assert abs(vocabulary - len(exact)) <= 1 + len(exact) * idf_ops.sketch_error()


def test_generated_texts_differ(spark):
    """The steps are one to one, so states of different ids differ."""
    ids = spark.range(0, 200_000).withColumnRenamed("id", "doc_id")
    assert generate.generate_character_documents(ids, length=60).select("text").distinct().count() == 200_000
    steps = spark.range(0, 1_000_000).select(generate._mix(F.col("id")).alias("s")).distinct().count()
    assert steps == 1_000_000


def test_postings_move_once_into_blocks(index):
    _, postings, _ = index
    plan = blocks_ops.posting_blocks(postings, block_postings=8)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Exchange rangepartitioning" not in plan


@pytest.mark.parametrize("block_postings", [1, 7, 8, 500])
def test_slots_of_frequent_words_do_not_show_in_blocks(index, monkeypatch, block_postings):
    _, postings, _ = index
    again = postings.unionByName(postings.filter("doc_id < 3")).unionByName(postings.limit(4).withColumn("doc_id", F.lit(None).cast("long")))
    want = rows_of(blocks_ops.long_form(blocks_ops.posting_blocks(again, block_postings=block_postings)).na.fill(-1))
    shape = rows_of(blocks_ops.posting_blocks(again, block_postings=block_postings).select("word", "block", "n", "tf_max", "tf_min"))
    monkeypatch.setattr(blocks_ops, "SAMPLED_SHARE", 1.0)
    monkeypatch.setattr(blocks_ops, "SAMPLED_PER_SLOT", 5)
    made = materialise(blocks_ops.posting_blocks(again, block_postings=block_postings), "blocks")
    assert rows_of(blocks_ops.long_form(made).na.fill(-1)) == want == rows_of(again.na.fill(-1).select("doc_id", "word", "word_frequency"))
    assert rows_of(made.select("word", "block", "n", "tf_max", "tf_min")) == shape


def test_larger_corpora_get_more_buckets(spark, index, monkeypatch):
    docs, postings, _ = index
    monkeypatch.setattr(bucketed, "BUCKET_TEXT_BYTES", 512)
    stored = BucketedIndex(spark, "test_more_buckets", scratch_path(spark, "bucketed"), buckets=2).build(docs)
    size = sum(len(text) for _, text in DOCS)
    assert size / 512 <= stored.buckets < 2 * size / 512
    assert rows_of(stored.postings().select("doc_id", "word", "word_frequency")) == rows_of(postings)
    parts = stored.postings().select(F.spark_partition_id()).distinct().count()
    assert parts > 2 and stored.weights().count() == postings.count()
    few = BucketedIndex(spark, "test_no_texts", scratch_path(spark, "bucketed"), buckets=2).build(docs.limit(0))
    assert few.buckets == 2 and few.weights().count() == 0
