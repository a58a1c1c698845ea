import pytest
from pyspark.sql import functions as F

from lexspark.llm.common import ship_package

LONG = " ".join(f"word{i % 900} and, then{i}." for i in range(6000))
TEXTS = [
    "The thing on the hill was there and nothing else, it said. It went away again after a while.",
    "The thing on the hill was there and nothing else, it said. It went away again after a while.",
    None,
    "",
    " \t\n ",
    "one",
    "12 34 !! 56",
    "Ünï çödé, naïve — “quoted” words. <|endoftext|> and more.",
    LONG,
    "menu | home | about | contact | help | more | other | last",
]


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="module")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows, and columns with clashing names."""
    rows = [(i, t, None if i % 3 == 0 else "en", None if i % 4 == 0 else f"s{i % 2}") for i, t in enumerate(TEXTS)]
    rows.append((1, TEXTS[1], "en", "s1"))  # a repeated row
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for name in ("n", "key", "id", "size", "slot", "start", "token", "shard", "block", "class", "_old_", "value", "page"):
        docs = docs.withColumn(name, F.lit("x"))
    return docs


@pytest.fixture(scope="module")
def no_docs(odd_docs):
    return odd_docs.limit(0)
