"""Session helpers: local sessions, shared scratch tables, size checks."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only when Spark's own size estimate stays below this.
BROADCAST_LIMIT_BYTES = 16 * 1024 * 1024
#: And of rows, where they are counted: files of repetitive rows are a hundredth of what the rows take in memory.
BROADCAST_LIMIT_ROWS = 2**18
#: Texts are read in splits of at most this size where each task sorts the postings of its texts.
SORT_SPLIT_BYTES = 8 * 1024 * 1024

_local_scratch: dict[str, str] = {}


def local_session(app_name: str = "lexspark", cores: str = "8", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks. On a cluster, pass your own session around."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
        "spark.driver.host": "127.0.0.1",
        "spark.driver.bindAddress": "127.0.0.1",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, from ``spark.checkpoint.dir``.

    Only a session in one local process may go without it; every executor of a cluster has to see the folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="lexspark-")
    return _local_scratch[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    Cuts the lineage for results that several branches of a plan use, survives the loss of
    executors, and gives the planner exact sizes for its later join choices.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate; exact file sizes for tables that were just written."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Hint a broadcast when the estimate is below ``limit``; otherwise leave the join to AQE."""
    return F.broadcast(df) if estimated_bytes(df) <= limit else df


def is_small(df: DataFrame, times: int = 1) -> bool:
    """Whether ``df``, which should come from stored tables, is below both limits; its rows are counted.

    ``times`` as many rows may be there if they are that much narrower than rows with texts."""
    rows = times * BROADCAST_LIMIT_ROWS
    return estimated_bytes(df) <= BROADCAST_LIMIT_BYTES and df.limit(rows + 1).count() <= rows


def broadcast_if_few(df: DataFrame, times: int = 1) -> DataFrame:
    """Hint a broadcast when ``df`` is below both limits; otherwise a merge join, as Spark too would broadcast
    by the size of compressed files."""
    return F.broadcast(df) if is_small(df, times) else df.hint("merge")


@contextmanager
def small_splits(spark: SparkSession) -> Iterator[None]:
    """Jobs inside read files in splits of ``SORT_SPLIT_BYTES`` at most (or one row group, if that is larger).

    A text gives many postings, so a task that sorts those of a split of the usual size spills most of them.
    """
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    if spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes() <= SORT_SPLIT_BYTES:
        yield
        return
    spark.conf.set(key, SORT_SPLIT_BYTES)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def partitions_for(spark: SparkSession) -> int:
    """How many partitions a shuffle gets: what the session is set to."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
