import json
import random

import models
import pytest
from pyspark.sql import functions as F

from lexspark import session
from lexspark.operators import batch_search as ways
from lexspark.operators import idf as idf_ops
from lexspark.operators import index as index_ops
from lexspark.operators.batch_search import batch_search, impact_profile
from lexspark.operators.search import results_as_json, search, search_requests
from lexspark.session import materialise

DOCS = [
    (1, "apple apple pear"),
    (2, "apple banana"),
    (4, "Apple! cherry cherry cherry"),
    (5, "plum plum"),
    (6, "plum quince"),
    (7, "plum quince"),
    (8, "melon"),
]


def indexed(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    postings = materialise(index_ops.build_index(docs), "test-postings")
    total = idf_ops.indexed_document_count(postings).scalar()
    idf = materialise(idf_ops.idf_snapshot(idf_ops.document_frequency(postings), total), "test-idf")
    return docs, postings, idf


@pytest.fixture(scope="module")
def corpus(spark):
    return indexed(spark, DOCS)


def found(df):
    return [(r.doc_id, r.score) for r in df.collect()]


def expected(query, rows=DOCS, **options):
    postings = models.index(rows)
    return models.search(query, postings, models.idf(postings), **options)


@pytest.mark.parametrize("query", ["apple", "Apple PEAR cherry", "quince plum", "melon melon plum", "pear unknownword"])
def test_search_equals_the_model(corpus, query):
    docs, postings, idf = corpus
    result = search(query, postings, idf, docs)
    assert found(result) == expected(query)
    texts = dict(DOCS)
    assert all(r.text == texts[r.doc_id] for r in result.collect())


def test_repeated_tokens_count_or_not(corpus):
    _, postings, idf = corpus
    query = "plum plum quince"
    counted, once = found(search(query, postings, idf)), found(search(query, postings, idf, dedupe_query_terms=True))
    assert counted == expected(query) and once == expected(query, dedupe=True)
    assert counted != once


def test_ties_go_to_the_smaller_id(corpus):
    _, postings, idf = corpus
    assert [d for d, _ in found(search("quince", postings, idf, k=2))] == [6, 7]


def test_k(corpus):
    _, postings, idf = corpus
    assert search("plum", postings, idf, k=0).count() == 0
    assert search("plum", postings, idf, k=100).count() == 3
    with pytest.raises(ValueError):
        search("plum", postings, idf, k=-1)


def test_no_tokens_and_no_match_keep_the_schema(corpus):
    docs, postings, idf = corpus
    for query in ("the of and", "", "nosuchword"):
        result = search(query, postings, idf, docs)
        assert result.columns == ["doc_id", "score", "text"] and result.count() == 0


def test_words_without_idf_give_score_zero(spark, corpus):
    docs, postings, _ = corpus
    stale = spark.createDataFrame([("pear", 1.0)], "word string, idf double")
    assert found(search("melon", postings, stale, docs)) == [(8, 0.0)]
    assert found(search("melon pear", postings, stale, docs))[0][0] == 1


def test_missing_document_gives_empty_text(corpus):
    docs, postings, idf = corpus
    result = search("melon", postings, idf, docs.filter("doc_id <> 8")).collect()
    assert [(r.doc_id, r.text) for r in result] == [(8, "")]


def test_word_filter_reaches_the_scans(corpus):
    _, postings, idf = corpus
    plan = search("plum quince", postings, idf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedFilters: [In(word, [plum,quince])") == 2
    assert "TakeOrderedAndProject" in plan


def test_request_log(spark):
    log = spark.createDataFrame([("a+b",), ("",), ("x" * 2000,), (None,)], "query string")
    valid, rejected = search_requests(log, max_bytes=1023)
    assert [r.query for r in valid.collect()] == ["a b"]
    assert rejected.count() == 3


def test_json_responses(spark, corpus):
    docs, postings, idf = corpus
    queries = spark.createDataFrame([(1, "pear"), (2, "the"), (3, "nosuchword")], "query_id int, text string")
    rows = results_as_json(batch_search(queries, postings, idf, docs), queries).collect()
    answers = {r.query_id: json.loads(r.response) for r in rows}
    (doc_id, score), = expected("pear")
    assert answers[1] == {
        "message": "Documents retrieved successfully",
        "results": [{"doc_id": str(doc_id), "score": score, "text": "apple apple pear"}],
    }
    assert answers[2] == answers[3] == {"message": "No documents found", "results": []}


# -- batch search against brute force ---------------------------------------------------------------


def skewed_corpus(seed, n_docs=400):
    """Zipf-like words, one word in every document, one in all but one, copies, very short documents."""
    rng = random.Random(seed)
    rows = []
    for i in range(n_docs):
        length = rng.choice([1, 2, 5, 30, 120])
        words = [f"w{min(int(rng.paretovariate(0.7)), 300)}" for _ in range(length)]
        words += ["everywhere"] * rng.randint(1, 4)
        if i:
            words.append("nearly")
        rows.append((i, " ".join(words)))
    rows += [(n_docs + i, rows[i % 3][1]) for i in range(40)]
    return rows


QUERY_WORDS = [f"w{i}" for i in range(1, 40)] + ["everywhere", "nearly", "missing", "the"]


def make_queries(seed, n=120):
    rng = random.Random(seed)
    queries = [(i, " ".join(rng.choices(QUERY_WORDS, k=rng.choice([1, 1, 2, 3, 8, 25])))) for i in range(n)]
    # A third of all queries is one and the same.
    return queries + [(n + i, "w1 everywhere w2") for i in range(n // 2)]


@pytest.mark.parametrize("strategy", ["direct", "bounded", "always bounded"])
@pytest.mark.parametrize("k, dedupe", [(3, False), (1, True), (10, False)])
def test_batch_search_equals_brute_force(spark, monkeypatch, strategy, k, dedupe):
    if strategy == "always bounded":
        monkeypatch.setattr(ways, "PRUNING_FACTOR", 0)
        strategy = "bounded"
    rows, queries = skewed_corpus(k), make_queries(k)
    _, postings, idf = indexed(spark, rows)
    asked = spark.createDataFrame(queries, "query_id int, text string")
    result = batch_search(asked, postings, idf, k=k, dedupe_query_terms=dedupe, strategy=strategy).collect()
    got = {}
    for r in sorted(result, key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.doc_id, r.score))
    model = models.index(rows)
    weights = models.idf(model)
    want = {i: models.search(q, model, weights, k, dedupe) for i, q in queries}
    want = {i: hits for i, hits in want.items() if hits}
    assert set(got) == set(want)
    for i in want:
        assert [d for d, _ in got[i]] == [d for d, _ in want[i]], queries[i]
        assert [s for _, s in got[i]] == pytest.approx([s for _, s in want[i]], abs=2e-8)


def test_bounded_way_prunes(spark):
    _, postings, idf = indexed(spark, skewed_corpus(4))
    asked = spark.createDataFrame([(i, f"w{i + 1}") for i in range(5)], "query_id int, text string")
    _, reps = ways.distinct_queries(asked, "query_id", "text")
    plan = ways.query_plan(ways.term_weights(reps, idf, False), impact_profile(postings), 3)
    assert plan.filter("pruned").count() >= 3
    survivors = ways.candidates(postings.withColumnRenamed("word_frequency", "tf"), plan, 3, "doc_id").count()
    assert survivors < postings.join(reps.selectExpr("words[0] AS word"), "word").count() / 2


def test_words_that_weigh_nothing_or_less_are_pruned_too(spark):
    rows = skewed_corpus(7, 2000)
    _, postings, idf = indexed(spark, rows)
    asked = spark.createDataFrame([(1, "everywhere"), (2, "unknown1 w5"), (3, "w1")], "query_id int, text string")
    stale = idf.filter(F.col("word") == "everywhere")
    _, reps = ways.distinct_queries(asked, "query_id", "text")
    plan = ways.query_plan(ways.term_weights(reps, stale, False), impact_profile(postings), 3)
    routes = {r.rep: (r.pruned, r.flat) for r in plan.collect()}
    assert routes == {1: (True, False), 2: (False, True), 3: (False, True)}
    posted = postings.withColumnRenamed("word_frequency", "tf")
    assert ways.candidates(posted, plan, 3, "doc_id").count() < 600
    assert ways.smallest_ids(posted, plan, 3, "doc_id").count() == 6


def test_found_ids_reach_the_text_scan(spark, sf_dir, tmp_path):
    path = str(tmp_path / "docs")
    spark.read.parquet(f"{sf_dir}/documents.parquet").write.parquet(path)
    docs = spark.read.parquet(path)
    _, postings, idf = indexed(spark, [(r.doc_id, r.text) for r in docs.collect()])
    plan = search("heon tion", postings, idf, docs)._jdf.queryExecution().executedPlan().toString()
    assert "In(doc_id, [" in plan


def test_bounded_way_takes_a_stored_profile(spark):
    _, postings, idf = indexed(spark, skewed_corpus(5))
    asked = spark.createDataFrame([(i, f"w{i + 1}") for i in range(20)], "query_id int, text string")
    profile = materialise(impact_profile(postings), "test-profile")
    stored = batch_search(asked, postings, idf, strategy="bounded", profile=profile)
    direct = batch_search(asked, postings, idf, strategy="direct")
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, direct.collect()))


def test_batch_search_with_stale_and_uncounted_idf(spark):
    rows = skewed_corpus(6)
    _, postings, idf = indexed(spark, rows)
    stale = idf.filter(F.col("word") < "w2").select("word", "idf")
    asked = spark.createDataFrame(make_queries(6, 60), "query_id int, text string")
    found = [sorted(map(tuple, batch_search(asked, postings, stale, strategy=s).collect())) for s in ("direct", "bounded")]
    assert found[0] == found[1] and found[0]


def test_batch_search_equals_single_searches(spark, corpus):
    docs, postings, idf = corpus
    queries = [(1, "plum quince apple"), (2, "cherry"), (3, "pear pear banana"), (4, "of the")]
    asked = spark.createDataFrame(queries, "query_id int, text string")
    batch = batch_search(asked, postings, idf, docs).collect()
    for query_id, text in queries:
        rows = sorted((r for r in batch if r.query_id == query_id), key=lambda r: r["rank"])
        assert [(r.doc_id, r.score, r.text) for r in rows] == [tuple(r) for r in search(text, postings, idf, docs).collect()]


def test_batch_search_arguments(corpus, spark):
    _, postings, idf = corpus
    asked = spark.createDataFrame([(1, "plum")], "query_id int, text string")
    assert batch_search(asked, postings, idf, k=0).count() == 0
    with pytest.raises(ValueError):
        batch_search(asked, postings, idf, k=-2)
    with pytest.raises(ValueError):
        batch_search(asked, postings, idf, strategy="guess")


@pytest.mark.parametrize("rows", [session.BROADCAST_LIMIT_ROWS, 0])
def test_candidates_are_not_broadcast_once_per_word(spark, monkeypatch, rows):
    """Many candidates of a query of many words: rows per candidate and word compress to little, but fill the driver."""
    shared = " ".join(f"s{i}" for i in range(30))
    docs, postings, idf = indexed(spark, [(i, f"{shared} x{i % 50}" if i % 4 == 0 else f"other y{i}") for i in range(400)])
    queries = spark.createDataFrame([(1, f"{shared} x1"), (2, "x4 x8"), (3, "other y3 unknown"), (4, "unknown")], "query_id int, text string")
    want = sorted(tuple(r) for r in batch_search(queries, postings, idf, docs, strategy="direct").collect())
    stored = {}

    def kept(df, name):
        stored[name] = materialise(df, name)
        return stored[name]

    monkeypatch.setattr(ways, "materialise", kept)
    monkeypatch.setattr(ways, "PRUNING_FACTOR", 0)  # all queries by candidates
    monkeypatch.setattr(session, "BROADCAST_LIMIT_ROWS", rows)
    assert sorted(tuple(r) for r in batch_search(queries, postings, idf, docs).collect()) == want
    assert ("query-lookups" in stored) == (rows == 0)  # only if there are too many queries to broadcast their words
    assert stored["query-pairs"].count() == stored["query-pairs"].distinct().count() > 100


def test_repetitive_rows_are_not_small(spark, monkeypatch):
    """Files of equal rows are tiny; what counts for a broadcast is the rows."""
    stored = materialise(spark.range(5000).select(F.lit(1).alias("word")), "equal-rows")
    assert session.is_small(stored)
    monkeypatch.setattr(session, "BROADCAST_LIMIT_ROWS", 4999)
    joined = spark.range(9).select(F.col("id").cast("int").alias("word")).join(session.broadcast_if_few(stored), "word")
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()
