"""Top-k search by mean TF-IDF over the query tokens.

Score of a document: sum over the query tokens of ``tf * idf``, divided by the number of query
tokens. A repeated token counts as often as it occurs (or once, with ``dedupe_query_terms``; the
divisor counts repeats either way). Any matching term brings a document in, words without an IDF
weigh 0, there is no score threshold, and ties go to the smaller id.
"""

from __future__ import annotations

from collections import Counter
from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark.functions.scoring import mean_score
from lexspark.functions.text import decode_query, is_valid_query, tokens
from lexspark.session import broadcast_if_few

DEFAULT_K = 3
FOUND_MESSAGE = "Documents retrieved successfully"
EMPTY_MESSAGE = "No documents found"


def check_k(k: int) -> None:
    if k < 0:
        raise ValueError("k must not be negative")


def query_terms(spark: SparkSession, query: str) -> list[str]:
    """The tokens of one query text, as the index would see them."""
    row = spark.createDataFrame([(query,)], "q string").select(tokens(F.col("q")).alias("t"))
    return row.collect()[0].t


def term_hits(
    postings: DataFrame, idf: DataFrame, terms: list[str], dedupe_query_terms: bool = False
) -> DataFrame:
    """Postings of the query words plus the ``weight`` of their word: repeats times IDF.

    The words are literals, so the filter reaches the parquet scans of both tables. The IDF side
    is broadcast because it has at most one row per query word.
    """
    if not terms:
        return postings.filter(F.lit(False)).withColumn("weight", F.lit(0.0))
    repeats = Counter(terms)
    words = sorted(repeats)
    idf_of_words = idf.filter(F.col("word").isin(*words)).select("word", "idf")
    weight = F.coalesce(F.col("idf"), F.lit(0.0))
    if not dedupe_query_terms and len(words) < len(terms):
        literals = chain.from_iterable((F.lit(w), F.lit(float(repeats[w]))) for w in words)
        weight = weight * F.element_at(F.create_map(*literals), F.col("word"))
    return (
        postings.filter(F.col("word").isin(*words))
        .join(F.broadcast(idf_of_words), "word", "left")
        .withColumn("weight", weight)
        .drop("idf")
    )


def search(
    query: str,
    postings: DataFrame,
    idf: DataFrame,
    documents: DataFrame | None = None,
    k: int = DEFAULT_K,
    dedupe_query_terms: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(id, score[, text])`` of the best ``k`` documents, best first.

    ``idf`` may be any snapshot; documents reached only through words it does not know still
    appear, with score 0. With ``documents`` the search runs at once: the ids that were found reach the
    document scan as literals, so files and row groups that cannot hold them are skipped.
    """
    check_k(k)
    terms = query_terms(postings.sparkSession, query)
    hits = term_hits(postings, idf, terms, dedupe_query_terms)
    scored = hits.groupBy(id_col).agg(
        mean_score(F.sum(F.col("word_frequency").cast("double") * F.col("weight")), F.lit(max(len(terms), 1))).alias(
            "score"
        )
    )
    top = scored.orderBy(F.desc("score"), id_col).limit(k)
    if documents is None:
        return top
    rows = top.collect()  # k rows at most
    found = postings.sparkSession.createDataFrame(rows, top.schema)
    wanted = documents.filter(F.col(id_col).isin(*[r[id_col] for r in rows])) if rows else documents.limit(0)
    return attach_text(found, wanted, id_col, text_col).orderBy(F.desc("score"), id_col).limit(k)


def attach_text(results: DataFrame, documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Add the text of each result row; a document that is gone gives an empty text.

    The texts are first cut down to the wanted ids by a semi join whose small side is the
    results, so the document table is scanned but not shuffled while the results are small.
    """
    wanted = broadcast_if_few(results.select(id_col))
    found = documents.select(id_col, text_col).join(wanted, id_col, "left_semi")
    return results.join(found, id_col, "left").withColumn(text_col, F.coalesce(F.col(text_col), F.lit("")))


def search_requests(log: DataFrame, raw_col: str = "query", max_bytes: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Split a log of URL-encoded queries into decoded valid requests and rejected ones.

    ``max_bytes`` rejects longer queries too."""
    decoded = log.withColumn(raw_col, decode_query(F.col(raw_col)))
    valid = is_valid_query(F.col(raw_col), max_bytes)
    return decoded.filter(valid), decoded.filter(~valid)


def response_json(results: Column) -> Column:
    """Response document of a search from an array of ``(doc_id, score, text)`` structs."""
    rows = F.coalesce(results, F.array().cast("array<struct<doc_id:string,score:double,text:string>>"))
    message = F.when(F.size(rows) == 0, EMPTY_MESSAGE).otherwise(FOUND_MESSAGE)
    return F.to_json(F.struct(message.alias("message"), rows.alias("results")))


def results_as_json(
    results: DataFrame, queries: DataFrame, query_col: str = "query_id", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(query_id, response)`` for ranked results; queries without results get an empty list.

    At most ``k`` rows exist per query, so the collected lists are bounded.
    """
    hit = F.struct(
        "rank", F.col(id_col).cast("string").alias("doc_id"), "score", F.col(text_col).alias("text")
    )
    listed = results.groupBy(query_col).agg(F.sort_array(F.collect_list(hit)).alias("_hits"))
    fields = ("doc_id", "score", "text")
    bodies = F.transform("_hits", lambda h: F.struct(*[h[name].alias(name) for name in fields]))
    return queries.select(query_col).join(listed, query_col, "left").select(
        query_col, response_json(bodies).alias("response")
    )
