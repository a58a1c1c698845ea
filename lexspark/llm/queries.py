"""The registered queries: each operator over the whole of its table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark.llm.common import ship_package, table
from lexspark.llm.cross_polytope import nearest_neighbours
from lexspark.llm.decontamination import contamination
from lexspark.llm.jaccard_join import jaccard_components
from lexspark.llm.language_id import fit_languages, predict_language
from lexspark.llm.line_quality import line_quality
from lexspark.llm.main_text import extract_main_text
from lexspark.llm.mixing import mixing_order
from lexspark.llm.packing import pack_documents
from lexspark.llm.resharding import reshard
from lexspark.llm.revisits import archive_of, header_lines, resolve_revisits
from lexspark.llm.token_files import round_trip
from lexspark.llm.whitening import whiten_embeddings
from lexspark.llm.zone_map_kmeans import zone_map_kmeans

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return table(spark, sf_dir, "documents")


def op1_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return predict_language(docs, fit_languages(docs))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir))


def op4_hierarchical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), TOKENIZER)


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(documents(spark, sf_dir), TOKENIZER)


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return extract_main_text(table(spark, sf_dir, "pages"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing_order(documents(spark, sf_dir))


def op8_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reshard(documents(spark, sf_dir))


def op9_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality(documents(spark, sf_dir))


def op10_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resolve_revisits(archive_of(table(spark, sf_dir, "pages")))
    return found.withColumn("headers", header_lines(F.col("headers")))


def op11_prefix_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op12_zone_map_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return zone_map_kmeans(table(spark, sf_dir, "embeddings"))


def op13_bidiagonal_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return whiten_embeddings(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_cross_polytope": op1_cross_polytope,
    "op2_language_id": op2_language_id,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_hierarchical_packing": op4_hierarchical_packing,
    "op5_token_files": op5_token_files,
    "op6_main_text": op6_main_text,
    "op7_mixing": op7_mixing,
    "op8_resharding": op8_resharding,
    "op9_line_quality": op9_line_quality,
    "op10_revisits": op10_revisits,
    "op11_prefix_containment": op11_prefix_containment,
    "op12_zone_map_kmeans": op12_zone_map_kmeans,
    "op13_bidiagonal_whitening": op13_bidiagonal_whitening,
}
