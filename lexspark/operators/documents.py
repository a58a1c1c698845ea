"""Set-based access to documents and postings by id."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def get_document(docs: DataFrame, doc_id: Any, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """0 or 1 row. An id that cannot be of the column's type matches nothing."""
    wanted = F.lit(str(doc_id)).try_cast(docs.schema[id_col].dataType)
    return docs.filter(F.col(id_col) == wanted).select(id_col, text_col)


def get_documents(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return docs.join(ids.select(id_col), id_col, "left_semi").select(id_col, text_col)


def delete_by_id(table: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of documents or postings that remain after deleting a set of ids."""
    return table.join(ids.select(id_col), id_col, "left_anti")


def deletion_report(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(id, deleted)`` per requested id: was there something to remove?"""
    present = docs.groupBy(id_col).agg(F.lit(True).alias("_hit"))
    asked = ids.select(id_col).distinct()
    return asked.join(present, id_col, "left").select(id_col, F.coalesce("_hit", F.lit(False)).alias("deleted"))
