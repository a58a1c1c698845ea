"""An index in tables that are bucketed by word.

Postings, IDF and impact profile of a word lie in buckets of the same number, so joins and aggregations by word read
them where they are: no shuffle moves postings. One task reads a bucket, so a larger corpus gets more of them. Tables are found by name in the session's catalog; their files
lie under ``path``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark.operators.batch_search import impact_profile
from lexspark.operators.idf import document_frequency, idf_snapshot
from lexspark.operators.index import build_index, with_token_flag

DEFAULT_BUCKETS = 64
#: Bytes of text whose postings may lie in one bucket on average, which is what a task sorts.
BUCKET_TEXT_BYTES = 32 * 1024 * 1024


class BucketedIndex:
    def __init__(self, spark: SparkSession, name: str, path: str, buckets: int = DEFAULT_BUCKETS) -> None:
        self.spark, self.name, self.path, self.buckets = spark, name, path.rstrip("/"), buckets

    def _save(self, df: DataFrame, part: str, *order: str) -> DataFrame:
        dealt = df.repartition(self.buckets, "word")
        writer = dealt.write.bucketBy(self.buckets, "word").sortBy("word", *order).option("path", f"{self.path}/{part}")
        writer.format("parquet").mode("overwrite").saveAsTable(f"{self.name}_{part}")
        return self.table(part)

    def table(self, part: str) -> DataFrame:
        return self.spark.table(f"{self.name}_{part}")

    def build(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> BucketedIndex:
        """Writes the tables. The postings are shuffled by word once, here.

        The number of buckets is doubled until they hold the postings of ``BUCKET_TEXT_BYTES`` each.
        """
        texts = with_token_flag(docs.select(text_col), text_col)
        held = texts.agg(F.count_if("has_tokens").alias("n"), F.sum(F.octet_length(text_col)).alias("bytes")).first()
        while self.buckets * BUCKET_TEXT_BYTES < (held["bytes"] or 0):
            self.buckets *= 2
        self._save(build_index(docs, id_col, text_col), "postings", "word_frequency")
        self._save(idf_snapshot(document_frequency(self.postings()), F.lit(held["n"])), "idf")
        self._save(impact_profile(self.postings()), "profile")
        return self

    def postings(self) -> DataFrame:
        return self.table("postings")

    def idf(self) -> DataFrame:
        return self.table("idf")

    def profile(self) -> DataFrame:
        return self.table("profile")

    def weights(self, id_col: str = "doc_id") -> DataFrame:
        """``(id, word, weight)``: frequency times IDF of every posting; words without an IDF weigh 0."""
        weight: Column = F.col("word_frequency").cast("double") * F.coalesce("idf", F.lit(0.0))
        return self.postings().join(self.idf(), "word", "left").select(id_col, "word", weight.alias("weight"))
