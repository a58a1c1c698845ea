"""Whitening of embeddings from the singular values of the centred rows.

The covariance matrix is never formed. Centred rows are reduced by QR: each task keeps one triangle and folds
its batches into it, triangles are folded in groups until a few are left, and the last one is
bidiagonalised on the driver, whose singular values and vectors (``bidiagonal.py``) are those of all rows. The
directions and the mean are broadcast: components x dimensions numbers.

Components of vectors become whole numbers ``floor(SCALE * c) + OFFSET``, so sums and deviations are exact.

Defined results: vectors that are null or hold null or non-finite entries take no part and get no row; if
vectors have different numbers of components, those with the commonest number count (of equally common ones
the larger) and the others get no row; repeated rows count each time; equal values of the spectrum leave a choice of
directions, made once for all rows; a direction in which the rows do not differ (up to rounding) has a null
``whitened`` and no part in ``identity_error``; a deviation too large for 64 bits is null; an empty
table gives an empty result. Entries of ``2**46`` or more raise ``ValueError``. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.llm.bidiagonal import EPS, right_singular
from lexspark.llm.zone_map_kmeans import matrix
from lexspark.session import materialise

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32
#: Triangles that one task folds into one.
FAN_IN = 32
LIMIT = float(1 << 52)
#: Rows that are worked on at once.
BLOCK_ROWS = 4096


def whole_numbers(column: pa.Array, dimensions: int) -> np.ndarray:
    values = np.floor(SCALE * matrix(column, dimensions).astype(np.float64))
    if values.size and np.abs(values).max() >= LIMIT:
        raise ValueError(f"entries of {LIMIT / SCALE:.0f} or more are too large")
    return values.astype(np.int64) + OFFSET


def centred(rows: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``rows - sums / n``, subtracted before it is rounded."""
    return (rows * n - sums).astype(np.float64) / n


def deviations(rows: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """The sum of squares of ``n * x - S`` per row, exactly; null beyond 64 bits."""
    apart = rows * n - sums
    largest = int(np.abs(apart).max(initial=0))
    if largest * largest * max(apart.shape[1], 1) < 1 << 63:
        return np.einsum("ij,ij->i", apart, apart).tolist()
    exact = [sum(x * x for x in row) for row in apart.tolist()]
    return [x if x < 1 << 63 else None for x in exact]


def _folded(parts: list[np.ndarray]) -> np.ndarray:
    return np.linalg.qr(np.vstack(parts), mode="r")


def _sums(vectors: DataFrame, dimensions: int) -> tuple[int, np.ndarray]:
    """How many vectors there are, and the sum per dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(dimensions + 1, np.int64)
        for batch in batches:
            totals[:dimensions] += whole_numbers(batch.column(0), dimensions).sum(axis=0)
            totals[dimensions] += batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(dimensions + 1), pa.int32()), pa.array(totals)], names=["i", "total"]
        )

    parts = vectors.select("c").mapInArrow(add, "i int, total bigint").groupBy("i").agg(F.sum("total").alias("total"))
    totals = np.zeros(dimensions + 1, np.int64)
    for row in parts.collect():  # one row per dimension
        totals[row["i"]] = row["total"]
    return int(totals[dimensions]), totals[:dimensions]


def triangle(vectors: DataFrame, dimensions: int, n: int, sums: np.ndarray) -> np.ndarray:
    """The square triangular factor of all centred rows."""

    def reduce_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: np.ndarray | None = None
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                rows = centred(whole_numbers(batch.column(0).slice(start, BLOCK_ROWS), dimensions), n, sums)
                held = _folded([rows] if held is None else [held, rows])
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([held.tobytes()], pa.binary())], names=["r"])

    def reduce_triangles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: np.ndarray | None = None
        for batch in batches:
            for data in batch.column(0):
                part = np.frombuffer(data.as_py()).reshape(-1, dimensions)
                held = part if held is None else _folded([held, part])
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([held.tobytes()], pa.binary())], names=["r"])

    parts = materialise(vectors.select("c").mapInArrow(reduce_rows, "r binary"), "triangles")
    while (count := parts.count()) > FAN_IN:
        groups = -(-count // FAN_IN)
        parts = materialise(parts.repartition(groups).mapInArrow(reduce_triangles, "r binary"), "triangles")
    last = [np.frombuffer(row["r"]).reshape(-1, dimensions) for row in parts.collect()]  # FAN_IN triangles at most
    square = np.zeros((dimensions, dimensions))
    whole = _folded(last)
    square[: len(whole)] = whole
    return square


def _identity_error(vectors: DataFrame, whiten, dimensions: int, used: np.ndarray, n: int) -> float:
    """The largest entry of the covariance of whitened rows minus the identity, over ``used`` components."""
    width = len(used)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((width + 1, width + 1))
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                rows = whiten(whole_numbers(batch.column(0).slice(start, BLOCK_ROWS), dimensions))[:, used]
                rows = np.hstack([rows, np.ones((len(rows), 1))])
                totals += rows.T @ rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(totals.size, dtype=np.int32)), pa.array(totals.reshape(-1))], names=["i", "total"]
        )

    parts = vectors.select("c").mapInArrow(moments, "i int, total double").groupBy("i").agg(F.sum("total").alias("total"))
    totals = np.zeros((width + 1) ** 2)
    for row in parts.collect():  # components squared
        totals[row["i"]] = row["total"]
    totals = totals.reshape(width + 1, width + 1) / n
    mean = totals[width, :width]
    return float(np.abs(totals[:width, :width] - np.outer(mean, mean) - np.eye(width)).max(initial=0.0))


def whiten_embeddings(
    vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """Per vector and component ``(id, component, n, deviation, whitened, explained, identity_error)``."""
    spark = vectors.sparkSession
    id_type = vectors.schema[id_col].dataType.simpleString()
    schema = (
        f"{id_col} {id_type}, component int, n bigint, deviation bigint, whitened double, explained double, "
        "identity_error double"
    )
    bad = F.exists(vector_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    valid = vectors.filter(F.coalesce(~bad, F.lit(False)) & (F.size(vector_col) > 0)).select(
        F.col(id_col).alias("id"), F.col(vector_col).alias("c")
    )
    lengths = valid.groupBy(F.size("c").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        return spark.createDataFrame([], schema)
    dimensions = lengths["d"]
    valid = valid.filter(F.size("c") == dimensions)
    n, sums = _sums(valid, dimensions)
    squares, directions = right_singular(triangle(valid, dimensions, n, sums))
    count = min(components, dimensions)
    total = float(squares.sum())
    explained = (squares[:count] / total if total else np.zeros(count)).tolist()
    used = np.flatnonzero(squares[:count] > (100 * dimensions * EPS) ** 2 * squares[0])
    scaled = np.zeros((dimensions, count))
    scaled[:, used] = directions[:, used] / np.sqrt(squares[used] / n)
    shared = spark.sparkContext.broadcast((scaled, sums))

    def whiten(rows: np.ndarray) -> np.ndarray:
        projection, sums = shared.value
        return centred(rows, n, sums) @ projection

    error = _identity_error(valid, whiten, dimensions, used, n)
    differs = np.isin(np.arange(count), used)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, sums = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                numbers, size = whole_numbers(part.column(1), dimensions), part.num_rows
                place = np.repeat(np.arange(size), count)
                columns = [
                    part.column(0).take(pa.array(place)),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), size)),
                    pa.array(np.full(size * count, n)),
                    pa.array(deviations(numbers, n, sums), pa.int64()).take(pa.array(place)),
                    pa.array(whiten(numbers).reshape(-1), mask=~np.tile(differs, size)),
                    pa.array(np.tile(explained, size)),
                    pa.array(np.full(size * count, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    names = [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"]
    return valid.mapInArrow(project, schema)
