"""Corpus statistics and inverse-document-frequency snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.functions.scoring import inverse_document_frequency

#: Sketches have at most ``2**SKETCH_LG_K`` registers.
SKETCH_LG_K = 12


def document_frequency(postings: DataFrame, id_col: str = "doc_id", unique: bool = True) -> DataFrame:
    """``(word, document_count)``. Postings of an index are unique on (id, word), so a plain
    count is enough; raw tokens need ``unique=False``."""
    count = F.count(F.lit(1)) if unique else F.count_distinct(F.col(id_col))
    return postings.groupBy("word").agg(count.alias("document_count"))


def document_count(docs: DataFrame) -> DataFrame:
    """One row ``(total_documents)``."""
    return docs.agg(F.count(F.lit(1)).alias("total_documents"))


def indexed_document_count(postings: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The same from stored postings: every stored document has a token. Where the documents are at
    hand, counting the accepted ones is cheaper than this distinct count over all postings."""
    return postings.agg(F.count_distinct(F.col(id_col)).alias("total_documents"))


def vocabulary_size(postings: DataFrame) -> DataFrame:
    """One row ``(vocabulary)``."""
    return postings.agg(F.count_distinct(F.col("word")).alias("vocabulary"))


def document_sketches(raw: DataFrame, id_col: str = "doc_id", lg_k: int = SKETCH_LG_K) -> DataFrame:
    """``(word, sketch)`` of the documents per word of raw tokens, for estimates without a distinct count.

    Repeated tokens are combined map-side; sketches of several changes are merged by ``merge_sketches``.
    """
    return raw.groupBy("word").agg(F.hll_sketch_agg(id_col, lg_k).alias("sketch"))


def merge_sketches(sketches: DataFrame) -> DataFrame:
    """One sketch per word from those of several changes; a document in two changes counts once."""
    return sketches.groupBy("word").agg(F.hll_union_agg("sketch").alias("sketch"))


def estimated_frequency(sketches: DataFrame) -> DataFrame:
    """``(word, document_count)`` as estimated; ``sketch_error`` bounds how far off it is."""
    return sketches.select("word", F.hll_sketch_estimate("sketch").alias("document_count"))


def estimated_vocabulary(words: DataFrame, lg_k: int = SKETCH_LG_K) -> DataFrame:
    """One row ``(vocabulary)`` as estimated from raw tokens or postings."""
    return words.agg(F.hll_sketch_estimate(F.hll_sketch_agg("word", lg_k)).alias("vocabulary"))


def sketch_error(lg_k: int = SKETCH_LG_K) -> float:
    """Six relative standard errors of a sketch."""
    return 6 * 1.04 / 2 ** (lg_k / 2)


def build_idf(frequencies: DataFrame, total_documents: Column | DataFrame | int) -> DataFrame:
    """``(word, idf)`` from ``(word, document_count)`` and the number of stored documents.

    A one-row DataFrame is used as a scalar subquery, so the plan stays lazy and has no join.
    Without documents nothing is computed.
    """
    if isinstance(total_documents, DataFrame):
        total = total_documents.scalar()
    elif isinstance(total_documents, Column):
        total = total_documents
    else:
        total = F.lit(total_documents)
    return idf_snapshot(frequencies, total).select("word", "idf")


def idf_snapshot(frequencies: DataFrame, total_documents: Column) -> DataFrame:
    """``(word, document_count, idf)``, the form kept in a store."""
    return frequencies.withColumn("_n", total_documents).filter(F.col("_n") > 0).select(
        "word",
        "document_count",
        inverse_document_frequency(F.col("_n"), F.col("document_count")).alias("idf"),
    )


def merge_idf(old: DataFrame, new: DataFrame) -> DataFrame:
    """New values overwrite old ones; words that vanished keep their last value.

    A ``document_count`` column of ``new`` is carried along, 0 for the vanished words.
    """
    before = old.select("word", F.col("idf").alias("_old"))
    joined = new.withColumnRenamed("idf", "_new").join(before, "word", "full")
    columns = [F.col("word")]
    if "document_count" in new.columns:
        columns.append(F.coalesce("document_count", F.lit(0).cast("bigint")).alias("document_count"))
    return joined.select(*columns, F.coalesce("_new", "_old").alias("idf"))
