"""The corpus pipeline: five stages, each written as Parquet and read again as the next one's documents.

Every stage works on all that its predecessor kept. The first four return the columns of ``documents``; the
last returns the pieces of the packed sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lexspark.llm.common import arrow_batches, ship_package, table
from lexspark.llm.jaccard_join import keep_one_of_each
from lexspark.llm.language_id import fit_languages, keep_identified
from lexspark.llm.line_quality import clean_documents
from lexspark.llm.mixing import mix_documents
from lexspark.llm.packing import pack_documents
from lexspark.session import materialise

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
#: Words that a worker remembers in the packing (twice at most), and what it is handed at a time. Workers and the heap
#: that the earlier stages filled share an executor's memory.
MEMO_WORDS = 300_000
BATCH_ROWS, BATCH_BYTES = 2000, "8m"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a clear language go."""
    ship_package(spark)
    return keep_identified(docs, fit_languages(docs))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that fail go, and documents that fail or lose too much go."""
    return clean_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by similarity the one with the least id stays."""
    ship_package(spark)
    return keep_one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order in which the schedule of sources delivers them."""
    return mix_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of several lengths."""
    ship_package(spark)
    with arrow_batches(spark, BATCH_ROWS, BATCH_BYTES):
        return materialise(pack_documents(docs, TOKENIZER, memo_words=MEMO_WORDS), "pieces")


STAGES = [
    ("language id", language_id),
    ("quality rules", quality_rules),
    ("n-gram jaccard join", near_duplicates),
    ("mixing", mixing),
    ("packing", packing),
]

#: SQL cannot express compression with dictionaries and tokenising.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
