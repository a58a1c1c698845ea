"""Inverted index: documents to postings, and set-based changes of postings.

All word counting is done inside the row that holds the text. A document is one row, so its
counts need no shuffle, and one very long or very frequent document never meets others in a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.functions.scoring import term_frequency
from lexspark.functions.text import clean_text, is_token, tokens


def tokenize(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, tokens)`` with the ordered token list of every document."""
    return docs.select(id_col, tokens(F.col(text_col)).alias("tokens"))


def exploded_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, position, word)``, one row per token."""
    listed = tokenize(docs, id_col, text_col)
    # The outer form keeps the optimiser from adding a size check that tokenises a second time.
    return listed.select(id_col, F.posexplode_outer("tokens").alias("position", "word")).filter(
        F.col("word").isNotNull()
    )


def count_words(df: DataFrame, words: Column, keep: list[str]) -> DataFrame:
    """``(*keep, total_words, word, word_count)`` from an array of words, without a shuffle.

    The array is sorted, so equal words form runs: a run starts where the neighbour differs and
    its length is the distance to the next start.
    """
    ordered = df.select(*keep, F.sort_array(words).alias("_words"))

    def word_at(i: Column) -> Column:
        return F.get(F.col("_words"), i)

    def next_start(j: Column) -> Column:
        return F.coalesce(F.get(F.col("_starts"), j + 1), F.col("total_words"))

    starts = F.filter(
        F.transform("_words", lambda w, i: F.when((i == 0) | (w != word_at(i - 1)), i)),
        lambda i: i.isNotNull(),
    )
    runs = ordered.select(
        *keep, "_words", F.size("_words").cast("bigint").alias("total_words"), starts.alias("_starts")
    )
    counted = F.transform(
        "_starts",
        lambda i, j: F.struct(word_at(i).alias("word"), (next_start(j) - i).cast("bigint").alias("n")),
    )
    return (
        runs.select(*keep, "total_words", F.explode_outer(counted).alias("_run"))
        .filter(F.col("_run").isNotNull())
        .select(*keep, "total_words", F.col("_run.word").alias("word"), F.col("_run.n").alias("word_count"))
    )


def term_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, total_words, word, word_count)``; documents without tokens give no rows."""
    source = docs.select(id_col, text_col)
    return count_words(source, tokens(F.col(text_col)), [id_col])


def build_index(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stored_precision: bool = False
) -> DataFrame:
    """Postings ``(id, word, word_frequency)`` of a whole corpus, unique on (id, word)."""
    tf = term_frequency(F.col("word_count"), F.col("total_words"), stored_precision)
    return term_counts(docs, id_col, text_col).select(id_col, "word", tf.alias("word_frequency"))


def document_lengths(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, total_words)`` of the documents that have tokens."""
    source = docs.select(id_col, text_col)
    sized = source.select(id_col, F.size(tokens(F.col(text_col))).cast("bigint").alias("total_words"))
    return sized.filter(F.col("total_words") > 0)


def with_token_flag(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``has_tokens``, the acceptance test of the index; stops at the first token."""
    words = F.split(clean_text(F.col(text_col)), " ")
    return docs.withColumn("has_tokens", F.exists(words, is_token))


def accepted_documents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    return with_token_flag(docs, text_col).filter("has_tokens").drop("has_tokens")


def rejected_documents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Documents that have no token and are therefore never stored."""
    return with_token_flag(docs, text_col).filter("NOT has_tokens").drop("has_tokens")


def postings_lists(postings: DataFrame, words: list[str], id_col: str = "doc_id") -> DataFrame:
    """Postings of the given words; an empty list of words gives no rows."""
    if not words:
        return postings.select("word", id_col, "word_frequency").filter(F.lit(False))
    return postings.filter(F.col("word").isin(*words)).select("word", id_col, "word_frequency")


def latest_postings(changes: DataFrame, id_col: str = "doc_id", version_col: str = "version") -> DataFrame:
    """Last write per (id, word). ``max`` of a struct is combined map-side, so repeated writes
    of one key never gather in a task."""
    newest = changes.groupBy(id_col, "word").agg(
        F.max(F.struct(version_col, "word_frequency")).alias("_last")
    )
    return newest.select(id_col, "word", F.col("_last.word_frequency").alias("word_frequency"))


def upsert_postings(
    current: DataFrame, changes: DataFrame, id_col: str = "doc_id", version_col: str | None = None
) -> DataFrame:
    """``changes`` over ``current``; the new frequency wins on (id, word)."""
    columns = [id_col, "word", "word_frequency"]
    fresh = latest_postings(changes, id_col, version_col) if version_col else changes.select(*columns)
    kept = current.select(*columns).join(fresh.select(id_col, "word"), [id_col, "word"], "left_anti")
    return kept.unionByName(fresh)
