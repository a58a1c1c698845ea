"""JSON documents in, line by line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark.functions.text import tokens

ACCEPTED = "accepted"


def read_json_documents(spark: SparkSession, path: str) -> DataFrame:
    """``(body)``, one JSON text per line."""
    return spark.read.text(path).select(F.col("value").alias("body"))


def decode_documents(bodies: DataFrame, body_col: str = "body") -> DataFrame:
    """Add ``text`` and ``status`` to rows with one JSON body each.

    ``text`` must be a string member of an object; a missing member counts as an empty text.
    ``status`` is ``accepted`` or the reason for the rejection: ``malformed``, ``not_an_object``,
    ``not_a_string`` or ``no_tokens``. VARIANT keeps the JSON type, so a number is not taken for
    a string.
    """
    body = F.try_parse_json(F.col(body_col))
    parsed = bodies.withColumn("_json", body)
    member = F.try_variant_get("_json", "$.text", "variant")
    text = F.when(F.col("_kind") == "STRING", F.try_variant_get("_json", "$.text", "string")).otherwise(
        F.when(F.col("_kind").isNull(), F.lit(""))
    )
    kind = F.schema_of_variant(member)
    typed = (
        parsed.withColumn("_object", F.coalesce(F.schema_of_variant("_json").startswith("OBJECT"), F.lit(False)))
        .withColumn("_kind", kind)
        .withColumn("text", F.when(F.col("_object"), text))
    )
    status = (
        F.when(F.col("_json").isNull(), "malformed")
        .when(~F.col("_object"), "not_an_object")
        .when(F.col("text").isNull(), "not_a_string")
        .when(F.size(tokens(F.col("text"))) == 0, "no_tokens")
        .otherwise(ACCEPTED)
    )
    return typed.withColumn("status", status).drop("_json", "_object", "_kind")
