import models
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexspark.functions.text import STOPWORDS, decode_query, is_valid_query, tokens
from lexspark.operators.index import exploded_tokens

CASES = [
    ("The quick, brown FOX.", ["quick", "brown", "fox"]),
    ("It's scikit-learn -- v2.0", ["its", "scikitlearn", "v20"]),
    ("a. THE  to", []),
    ("ÉCOLE Café", ["École", "café"]),
    ("x\ty\x0bz\r\nw", ["x", "y", "z", "w"]),
    ("word_7 word_7 word_8", ["word7", "word7", "word8"]),
    ("", []),
    (None, []),
    ("  \n ", []),
    ("non breaking space here", ["non breaking", "space here"]),
]


def tokenised(spark, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return [r.t for r in rows.select("i", tokens(F.col("text")).alias("t")).orderBy("i").collect()]


def test_token_table(spark):
    assert tokenised(spark, [c[0] for c in CASES]) == [c[1] for c in CASES]


def test_every_stopword_goes(spark):
    assert tokenised(spark, [" ".join(STOPWORDS).upper()]) == [[]]
    assert len(set(STOPWORDS)) == 51


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(max_size=60), min_size=20, max_size=60))
def test_tokens_equal_the_model(spark, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert tokenised(spark, texts) == [models.tokens(t) for t in texts]


def test_positions(spark):
    docs = spark.createDataFrame([(1, "b a b the c"), (2, "of")], "doc_id int, text string")
    rows = exploded_tokens(docs).orderBy("doc_id", "position").collect()
    assert [tuple(r) for r in rows] == [(1, 0, "b"), (1, 1, "b"), (1, 2, "c")]


@pytest.mark.parametrize(
    "raw, query",
    [("a+b", "a b"), ("a%2Bb", "a b"), ("a%20b", "a b"), ("100%", "100%"), ("5%zz%41", "5%zzA"), ("caf%C3%A9", "café")],
)
def test_decode_query(spark, raw, query):
    rows = spark.createDataFrame([(raw,)], "q string")
    assert rows.select(decode_query(F.col("q"))).collect()[0][0] == query


def test_query_validity(spark):
    texts = [None, "", "x", "x" * 1023, "x" * 1024, "é" * 512]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, q string")
    both = rows.select(is_valid_query(F.col("q")).alias("any"), is_valid_query(F.col("q"), 1023).alias("short"), "i")
    found = both.orderBy("i").collect()
    assert [r["any"] for r in found] == [False, False, True, True, True, True]
    assert [r["short"] for r in found] == [False, False, True, True, False, False]
