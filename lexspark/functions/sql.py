"""The library's operations as Spark SQL: views and functions of a session.

After ``register(spark, documents, postings, idf)``::

    SELECT tokens('The quick fox')                             -- scalar
    SELECT * FROM term_frequencies('some text')                -- (word, word_frequency)
    SELECT * FROM postings_of(array('spark', 'window'))        -- (word, doc_id, word_frequency)
    SELECT * FROM search('spark window functions', 3)          -- (doc_id, score, text), best first

and the views ``documents``, ``postings`` and ``idf``. A prefix keeps several indexes apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexspark.functions.scoring import SCORE_DECIMALS
from lexspark.functions.text import LOWER, PUNCTUATION, SEPARATORS, STOPWORDS, UPPER


def literal(text: str) -> str:
    """A SQL string literal; everything but letters, digits and spaces is written as an escape."""
    return "'" + "".join(c if c.isalnum() or c == " " else f"\\u{ord(c):04x}" for c in text) + "'"


def tokens_expression(text: str) -> str:
    """SQL for the ordered token list of a text."""
    clean = (
        f"translate(coalesce({text}, ''), {literal(UPPER + SEPARATORS + PUNCTUATION)}, "
        f"{literal(LOWER + ' ' * len(SEPARATORS))})"
    )
    stop = ", ".join(literal(w) for w in STOPWORDS)
    return f"filter(split({clean}, ' '), w -> w <> '' AND w NOT IN ({stop}))"


def register(spark: SparkSession, documents: DataFrame, postings: DataFrame, idf: DataFrame, prefix: str = "") -> None:
    """Creates the temporary views and functions, replacing earlier ones of the same names."""
    id_type = postings.schema["doc_id"].dataType.simpleString()
    tf_type = postings.schema["word_frequency"].dataType.simpleString()
    for name, df in (("documents", documents), ("postings", postings), ("idf", idf)):
        df.createOrReplaceTempView(f"{prefix}{name}")
    create = "CREATE OR REPLACE TEMPORARY FUNCTION"
    spark.sql(f"{create} {prefix}tokens(t STRING) RETURNS ARRAY<STRING> RETURN {tokens_expression('t')}")
    frequencies = f"{prefix}term_frequencies"
    spark.sql(
        f"""{create} {frequencies}(t STRING) RETURNS TABLE (word STRING, word_frequency DOUBLE) RETURN
        SELECT word, CAST(count(*) AS DOUBLE) / any_value(n)
        FROM (SELECT explode(ws) AS word, size(ws) AS n FROM (SELECT {prefix}tokens({frequencies}.t) AS ws)) GROUP BY word"""
    )
    lists = f"{prefix}postings_of"
    spark.sql(
        f"""{create} {lists}(words ARRAY<STRING>)
        RETURNS TABLE (word STRING, doc_id {id_type}, word_frequency {tf_type}) RETURN
        SELECT p.word, p.doc_id, p.word_frequency
        FROM (SELECT explode(ws) AS word FROM (SELECT array_distinct({lists}.words) AS ws)) q
        JOIN {prefix}postings p ON p.word = q.word"""
    )
    search = f"{prefix}search"
    spark.sql(
        f"""{create} {search}(query STRING, k INT) RETURNS TABLE (doc_id {id_type}, score DOUBLE, text STRING) RETURN
        WITH asked AS (
            SELECT word, count(*) AS m, any_value(n) AS n
            FROM (SELECT explode(ws) AS word, size(ws) AS n FROM (SELECT {prefix}tokens({search}.query) AS ws))
            GROUP BY word
        ), scored AS (
            SELECT doc_id, round(sum(m * CAST(word_frequency AS DOUBLE) * coalesce(idf, 0)) / any_value(n), {SCORE_DECIMALS})
                AS score
            FROM asked JOIN {prefix}postings USING (word) LEFT JOIN {prefix}idf USING (word) GROUP BY doc_id
        ), best AS (
            SELECT doc_id, score FROM (
                SELECT *, row_number() OVER (ORDER BY score DESC, doc_id) AS place FROM scored
            ) WHERE place <= {search}.k
        )
        SELECT best.doc_id, score, coalesce(d.text, '') FROM best LEFT JOIN {prefix}documents d ON d.doc_id = best.doc_id"""
    )
