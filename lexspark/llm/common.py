"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The separators between words, for Java and for Python patterns: ASCII white space only.
WHITE_SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, also inside of array lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """The words of a text as an array, in order."""
    return F.filter(F.split(text, WHITE_SPACE), lambda w: w != "")


@contextmanager
def arrow_batches(spark: SparkSession, rows: int, size: str) -> Iterator[None]:
    """What is run inside hands Python at most ``rows`` rows and ``size`` bytes at a time (one row at least).

    The session's own limits come back afterwards.
    """
    limits = {"maxRecordsPerBatch": str(rows), "maxBytesPerBatch": size}
    names = {f"spark.sql.execution.arrow.{name}": value for name, value in limits.items()}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        _shipped.add(context.applicationId)
        root = Path(__file__).resolve().parents[2]
        built = tempfile.mkdtemp(prefix="lexspark-package-")  # read by the driver only, which sends it
        context.addPyFile(shutil.make_archive(f"{built}/lexspark", "zip", root, "lexspark"))
