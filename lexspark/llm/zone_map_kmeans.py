"""Exact k-means over blocks of a space-filling curve.

Vectors become whole numbers, are sorted along a Hilbert curve and cut into blocks of ``BLOCK_ROWS`` neighbours,
each with the box (least and greatest value per dimension) of its vectors. In every round a block
first looks at its box: a centroid whose least distance to the box is above some other centroid's greatest
distance cannot be the nearest of any vector inside. Only the remaining candidates are compared, exactly and
for the whole block at once.

The blocks are written once, range-partitioned by curve position and id, so equal vectors spread over
partitions. A round moves only sums and counts per task and cluster, combined before they are shuffled; the
driver holds the centroids (clusters x dimensions numbers). All arithmetic is on integers.

Defined results: vectors that are null, have another number of components, or hold null or non-finite ones take
no part and get no row; of equally near centroids the smaller number wins; repeated rows are separate vectors
with the same answer; rows without an id are vectors, but never first centroids unless too few others exist;
with fewer vectors than clusters there are as many centroids as vectors; an empty table gives an empty
result. Components of ``2**27 / scale`` or more would overflow the sums and raise ``ValueError``. Other
columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.session import materialise, partitions_for

CLUSTERS = 8
ROUNDS = 10
SEED = 3
SCALE = 1024
DIMENSIONS = 64
BLOCK_ROWS = 256
#: Bits per dimension of the position on the curve.
CURVE_BITS = 4
LIMIT = 1 << 27


def usable(vector: Column, dimensions: int) -> Column:
    """True for vectors of that many components, none of them null or non-finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) == dimensions) & ~bad, F.lit(False))


def matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    """A list column of ``dimensions`` values each as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def hilbert_keys(cells: np.ndarray, bits: int) -> list[bytes]:
    """The position of each row of ``cells`` (whole numbers below ``2**bits``) on the Hilbert curve, as bytes.

    This is the method of Skilling (2004): reflections and exchanges of axes from the highest bit down, then
    a Gray code; all rows go through each step together.
    """
    axes = cells.T.astype(np.uint32).copy()
    bit = 1 << (bits - 1)
    while bit > 1:
        low = np.uint32(bit - 1)
        for axis in axes:
            on = (axis & bit) != 0
            swap = np.where(on, 0, (axes[0] ^ axis) & low).astype(np.uint32)
            axes[0] ^= np.where(on, low, swap).astype(np.uint32)
            axis ^= swap
        bit >>= 1
    for i in range(1, len(axes)):
        axes[i] ^= axes[i - 1]
    turn = np.zeros(axes.shape[1], np.uint32)
    bit = 1 << (bits - 1)
    while bit > 1:
        turn ^= np.where(axes[-1] & bit, bit - 1, 0).astype(np.uint32)
        bit >>= 1
    axes ^= turn
    planes = [((axes >> (bits - 1 - b)) & 1).T for b in range(bits)]
    packed = np.packbits(np.concatenate(planes, axis=1).astype(np.uint8), axis=1)
    return [row.tobytes() for row in packed]


def _box(vectors: DataFrame, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest value per dimension; empty without vectors. One row per dimension is collected."""

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = high = None
        for batch in batches:
            if batch.num_rows:
                rows = matrix(batch.column(0), dimensions)
                least, most = rows.min(axis=0), rows.max(axis=0)
                low, high = (least, most) if low is None else (np.minimum(low, least), np.maximum(high, most))
        if low is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(dimensions), pa.int32()), pa.array(low), pa.array(high)], names=["i", "low", "high"]
            )

    parts = vectors.select("x").mapInArrow(ends, "i int, low bigint, high bigint")
    rows = parts.groupBy("i").agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("i").collect()
    return np.array([r["low"] for r in rows], np.int64), np.array([r["high"] for r in rows], np.int64)


def _blocks(vectors: DataFrame, id_type: str, low: np.ndarray, high: np.ndarray, block_rows: int) -> DataFrame:
    """``(ids, data, low, high)``: neighbours on the curve with their box; numbers as 32-bit integers."""
    dimensions = len(low)

    def position(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = matrix(batch.column(1), dimensions)
            cells = ((rows - low) << CURVE_BITS) // (high - low + 1)
            data = [row.tobytes() for row in rows.astype("<i4")]
            keys = pa.array(hilbert_keys(cells, CURVE_BITS), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), keys, pa.array(data, pa.binary())], names=["id", "key", "data"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def as_block(rows: pa.Table) -> pa.RecordBatch:
            data = b"".join(x.as_py() for x in rows.column(1))
            numbers = np.frombuffer(data, "<i4").reshape(-1, dimensions)
            columns = [
                pa.array([rows.column(0).to_pylist()], pa.list_(rows.schema.field(0).type)),
                pa.array([data], pa.binary()),
                pa.array([numbers.min(axis=0).tobytes()], pa.binary()),
                pa.array([numbers.max(axis=0).tobytes()], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["ids", "data", "low", "high"])

        for batch in batches:
            fresh = pa.Table.from_batches([batch])
            held = fresh if held is None else pa.concat_tables([held, fresh])
            while held.num_rows >= block_rows:
                yield as_block(held.slice(0, block_rows))
                held = held.slice(block_rows)
        if held is not None and held.num_rows:
            yield as_block(held)

    placed = vectors.select("id", "x").mapInArrow(position, f"id {id_type}, key binary, data binary")
    tie = F.xxhash64("id")
    ordered = placed.repartitionByRange(partitions_for(vectors.sparkSession), "key", tie).sortWithinPartitions("key", tie)
    schema = f"ids array<{id_type}>, data binary, low binary, high binary"
    return materialise(ordered.select("id", "data").mapInArrow(cut, schema), "curve-blocks")


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The numbers of the centroids that may be nearest to some vector of the box."""
    below, above = low - centroids, centroids - high
    least = np.maximum(np.maximum(below, above), 0)
    most = np.maximum(np.abs(below), np.abs(above))
    return np.flatnonzero((least * least).sum(axis=1) <= (most * most).sum(axis=1).min())


def _nearest(batch: pa.RecordBatch, centroids: np.ndarray) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """Per block its ids and vectors, and each vector's cluster and squared distance."""
    dimensions = centroids.shape[1]
    for ids, data, low, high in zip(*(batch.column(c) for c in ("ids", "data", "low", "high")), strict=True):
        rows, least, most = (np.frombuffer(x.as_buffer(), "<i4").astype(np.int64) for x in (data, low, high))
        rows = rows.reshape(-1, dimensions)
        close = candidates(least, most, centroids)
        distances = np.empty((len(close), len(rows)), np.int64)
        for i, number in enumerate(close):
            apart = rows - centroids[number]
            distances[i] = np.einsum("ij,ij->i", apart, apart)
        first = distances.argmin(axis=0)  # the first of equals, which has the smaller number
        yield ids.values, rows, close[first], distances[first, np.arange(len(rows))]


def _moved(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round."""
    clusters, dimensions = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((clusters, dimensions + 1), np.int64)
        for batch in batches:
            for _, rows, found, _ in _nearest(batch, centroids):
                np.add.at(totals[:, :dimensions], found, rows)
                totals[:, dimensions] += np.bincount(found, minlength=clusters)
        used = np.flatnonzero(totals[:, dimensions])
        cluster = np.repeat(used, dimensions + 1).astype(np.int32)
        place = np.tile(np.arange(dimensions + 1, dtype=np.int32), len(used))
        yield pa.RecordBatch.from_arrays(
            [pa.array(cluster), pa.array(place), pa.array(totals[used].reshape(-1))], names=["cluster", "i", "total"]
        )

    parts = blocks.mapInArrow(sums, "cluster int, i int, total bigint")
    moved, totals = centroids.copy(), np.zeros((clusters, dimensions + 1), np.int64)
    for row in parts.groupBy("cluster", "i").agg(F.sum("total").alias("total")).collect():  # clusters x dimensions
        totals[row["cluster"], row["i"]] = row["total"]
    used = totals[:, dimensions] > 0
    moved[used] = totals[used, :dimensions] // totals[used, dimensions:]  # rounds down
    return moved


def zone_map_kmeans(
    vectors: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    seed: int = SEED,
    scale: int = SCALE,
    dimensions: int = DIMENSIONS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Per usable vector ``(id, cluster, distance, cluster_inertia, inertia, centroid_sha256)``.

    The first centroids are the vectors with the least SHA-256 of ``<seed>:<id>``. ``rounds`` times
    all vectors are assigned and every centroid becomes the mean of its vectors, rounded down; then they are
    assigned once more.
    """
    spark = vectors.sparkSession
    id_type = vectors.schema[id_col].dataType.simpleString()
    whole = F.transform(F.col(vector_col), lambda x: F.floor(x.cast("double") * float(scale)).cast("bigint"))
    kept = vectors.filter(usable(F.col(vector_col), dimensions)).select(F.col(id_col).alias("id"), whole.alias("x"))
    low, high = _box(kept, dimensions)
    if len(low) and max(-int(low.min()), int(high.max())) >= LIMIT:
        raise ValueError(f"components of {LIMIT // scale} or more are too large")
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = kept.select(order.alias("h"), "x").orderBy(F.col("h").asc_nulls_last(), "x").limit(clusters).collect()
    schema = f"id {id_type}, cluster int, distance bigint"
    if not first:
        found, sums, shas = spark.createDataFrame([], schema), [], []
    else:
        centroids = np.array([r["x"] for r in first], np.int64)
        blocks = _blocks(kept, id_type, low, high, block_rows)
        for _ in range(rounds):
            before, centroids = centroids, _moved(blocks, centroids)
            if np.array_equal(before, centroids):
                break  # every further round gives the same
        final = centroids

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for ids, _, cluster, distance in _nearest(batch, final):
                    yield pa.RecordBatch.from_arrays(
                        [ids, pa.array(cluster.astype(np.int32)), pa.array(distance)], names=["id", "cluster", "distance"]
                    )

        found = materialise(blocks.mapInArrow(assign, schema), "assigned-vectors")
        sums = found.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()  # a row per cluster
        shas = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in final]
    total = sum(r["d"] for r in sums)
    of_cluster = spark.createDataFrame(
        [(r["cluster"], r["d"], total, shas[r["cluster"]]) for r in sums],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string",
    )
    return found.join(F.broadcast(of_cluster), "cluster").select(
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
