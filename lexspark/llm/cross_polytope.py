"""Approximate nearest neighbours by cross-polytope hashing.

Vectors are hashed by pseudo-random rotations: three rounds of random signs and a fast Hadamard transform.
Each table has two rotations: the *cell* of a vector is the signed axis its first rotation lies closest to, its
*place* in the cell the closest of the first ``PLACES`` signed axes of the second. A query looks at the (cell, place)
buckets it is closest to, over all tables together, and all vectors found there are ranked by their exact
inner products.

Candidates and queries are hashed by their directions, so the length of one vector has no say in the buckets of
others; inner products rank what is found. How many buckets a query has to look at is measured: ``SAMPLE_QUERIES``
queries of each vector length are also searched in full, and the closest ``LEAST_RECALL`` of their neighbours say how
many. The closer the neighbours, as among more rows, the fewer buckets. Where a query would look at as many
buckets as a table has (lengths that outweigh directions), it would compare more pairs than there are, so
all classes of that vector length are ranked, as they are for a query that found fewer than ``k + 1``.

* Equal vectors are one class, and only the smallest ids of a class can be among the nearest, so a class
  brings at most ``k + 1`` ids along; queries with equal vectors are searched once.
* A cell is cut into chunks of about ``CHUNK_ROWS`` classes by a hash of the id, and the queries that look into a
  cell go to each chunk, in blocks, with the set of places they ask for. A task holds one block and one chunk, and
  returns ``k + 1`` classes per query. So a cell with a third of all rows is many tasks.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part, as
queries and as candidates; vectors are compared with those of their own length only; a query with fewer
candidates than ``k`` gets all of them; ties go to the smaller id; repeated rows (equal id and vector)
count once; an empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexspark.session import broadcast_if_small, materialise, partitions_for

NEIGHBOURS = 20
TABLES = 16
#: Axes of the second rotation that tell places apart; two signed ones each.
PLACES = 16
ROUNDS = 3
SEED = 7
CHUNK_ROWS = 4096
QUERY_ROWS = 1024
#: Queries per vector length by which recall is measured, and the share of their neighbours that hashing has to find.
SAMPLE_QUERIES = 64
LEAST_RECALL = 0.95
#: Closeness values that a task holds at once, and rows it merges before it returns them.
CLOSE_VALUES = 1 << 22
MERGE_ROWS = 200_000


def hadamard(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of each row, whose length is a power of two."""
    rows, size = x.shape
    step = 1
    while step < size:
        pairs = x.reshape(rows, size // (2 * step), 2, step)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(rows, size)
        step *= 2
    return x / np.sqrt(size)


def rotate(x: np.ndarray, table: int) -> np.ndarray:
    """The pseudo-rotation of one table, the same on every worker."""
    signs = np.random.default_rng([SEED, table, x.shape[1]]).choice([-1.0, 1.0], size=(ROUNDS, x.shape[1]))
    for row in signs:
        x = hadamard(x * row)
    return x


def directions(x: np.ndarray) -> np.ndarray:
    """Rows of length one, padded by zeros to a power of two."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    out = np.zeros((len(x), 1 << (x.shape[1] - 1).bit_length()))
    out[:, : x.shape[1]] = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    return out


def signed_axes(rotated: np.ndarray) -> np.ndarray:
    """Closeness to each of the 2 * d signed axes."""
    return np.concatenate([rotated, -rotated], axis=1)


def both_rotations(x: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
    """Closeness to the cells and to the places of one table."""
    return signed_axes(rotate(x, 2 * table)), signed_axes(rotate(x, 2 * table + 1)[:, :PLACES])


def own_bucket(x: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
    """Cell and place of each candidate."""
    cells, places = both_rotations(x, table)
    return cells.argmax(axis=1), places.argmax(axis=1)


def buckets_per_table(width: int) -> int:
    """Of rows padded to ``width``."""
    return 4 * width * min(PLACES, width)


def closeness(x: np.ndarray, tables: int) -> Iterator[tuple[int, np.ndarray]]:
    """Of some rows at a time, the number of the first and the closeness to every (table, cell, place)."""
    step = max(1, CLOSE_VALUES // (tables * buckets_per_table(x.shape[1])))
    for first in range(0, len(x), step):
        part = x[first : first + step]
        sums = [c[:, :, None] + p[:, None, :] for c, p in (both_rotations(part, table) for table in range(tables))]
        yield first, np.stack(sums, axis=1)


def probed_cells(x: np.ndarray, tables: int, probes: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, table, cell, places as a set of bits) that hold the ``probes`` closest buckets of each row."""
    for first, close in closeness(x, tables):
        rows, _, cells, places = close.shape
        flat = close.reshape(rows, -1)
        count = min(probes, flat.shape[1])
        chosen = np.argpartition(-flat, count - 1, axis=1)[:, :count]
        keys = np.arange(rows)[:, None] * (tables * cells) + chosen // places
        keys, which = np.unique(keys.reshape(-1), return_inverse=True)
        asked = np.zeros(len(keys), np.int64)
        np.bitwise_or.at(asked, which.reshape(-1), np.int64(1) << (chosen % places).reshape(-1))
        yield first + keys // (tables * cells), keys // cells % tables, keys % cells, asked


def probes_needed(x: np.ndarray, other: np.ndarray, tables: int) -> np.ndarray:
    """How many buckets each row of ``x`` has to look at to meet the same row of ``other``."""
    own = [own_bucket(other, table) for table in range(tables)]
    needed = np.zeros(len(x), np.int64)
    for first, close in closeness(x, tables):
        rows = np.arange(len(close))
        met = [close[rows, t, c[first + rows], p[first + rows]] for t, (c, p) in enumerate(own)]
        best = np.max(met, axis=0)
        needed[first + rows] = 1 + (close > best[:, None, None, None]).sum(axis=(1, 2, 3))
    return needed


def best_of(asked: np.ndarray, found: np.ndarray, scores: np.ndarray, count: int) -> tuple[np.ndarray, ...]:
    """The ``count`` best pairs of each asking class, each pair once; ties go to the smaller class."""
    order = np.lexsort((-scores, found, asked))
    asked, found, scores = asked[order], found[order], scores[order]
    new = np.ones(len(asked), bool)
    new[1:] = (asked[1:] != asked[:-1]) | (found[1:] != found[:-1])
    asked, found, scores = asked[new], found[new], scores[new]
    order = np.lexsort((found, -scores, asked))
    asked, found, scores = asked[order], found[order], scores[order]
    starts = np.flatnonzero(np.concatenate([[True], asked[1:] != asked[:-1]]))
    lengths = np.diff(np.append(starts, len(asked)))
    kept = np.arange(len(asked)) - np.repeat(starts, lengths) < count
    return asked[kept], found[kept], scores[kept]


def usable(vector: Column) -> Column:
    """True for vectors that take part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _vectors(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """A column of equally long lists as rows of doubles."""
    column = batch.column(name)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _by_length(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    sizes = np.diff(batch.column("vector").offsets.to_numpy())
    for size in np.unique(sizes):
        yield batch.filter(pa.array(sizes == size))


def nearest_neighbours(
    rows: DataFrame,
    queries: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = NEIGHBOURS,
    tables: int = TABLES,
    probe_share: float | None = None,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` of the rows for which ``queries`` holds, against all other rows.

    A query looks at the share ``probe_share`` of all buckets, by default at as many as the sample asks for.
    """
    spark = rows.sparkSession
    # Floats are moved as they are and multiplied as doubles.
    of_floats = rows.schema[vector_col].dataType.simpleString() == "array<float>"
    vector = F.transform(F.col(vector_col), lambda x: x.cast("float" if of_floats else "double"))
    taken = (
        rows.withColumn("_query", F.coalesce(queries, F.lit(False)))
        .select(F.col(id_col).cast("bigint").alias("id"), vector.alias("vector"), "_query")
        .filter(F.col("id").isNotNull() & usable(F.col("vector")))
        .distinct()
    )
    taken = materialise(taken, "ann-rows")
    # The smallest ids of each distinct vector; Spark limits the ranks before it shuffles.
    ranked = Window.partitionBy("vector").orderBy("id")
    copies = taken.select("id", "vector").withColumn("_rank", F.row_number().over(ranked)).filter(F.col("_rank") <= k + 1)
    classes = materialise(
        copies.groupBy("vector").agg(F.min("id").alias("class"), F.array_sort(F.collect_list("id")).alias("ids")),
        "ann-classes",
    )
    asked = taken.filter("_query").select("id", "vector").join(classes.select("vector", "class"), "vector").select("id", "class")
    asked = materialise(asked, "ann-queries")
    searched = classes.join(asked.select("class").distinct(), "class", "left_semi")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _by_length(whole):
                x = directions(_vectors(batch, "vector"))
                for table in range(tables):
                    cells, places = own_bucket(x, table)
                    yield bucketed(batch, np.arange(len(x)), table, cells, np.int64(1) << places)

    def probing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _by_length(whole):
                if batch.num_rows:
                    x = directions(_vectors(batch, "vector"))
                    for found in probed_cells(x, tables, batch.column("probes")[0].as_py()):
                        yield bucketed(batch, *found)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """How many buckets the query ``vector`` has to look at to find ``other``."""
        for whole in batches:
            for batch in _by_length(whole):
                x, other = directions(_vectors(batch, "vector")), directions(_vectors(batch, "other"))
                size = pa.array(np.diff(batch.column("vector").offsets.to_numpy()), pa.int32())
                limit = pa.array(np.full(len(x), buckets_per_table(x.shape[1])), pa.int64())
                columns = [size, pa.array(probes_needed(x, other, tables)), limit]
                yield pa.RecordBatch.from_arrays(columns, names=["size", "needed", "limit"])

    def bucketed(batch: pa.RecordBatch, row: np.ndarray, table, cell: np.ndarray, places: np.ndarray) -> pa.RecordBatch:
        size = len(batch.column("vector")[0]) if batch.num_rows else 0
        bucket = (np.int64(size) << 32) + (table << 24) + cell.astype(np.int64)
        taken = pa.array(row)
        columns = [pa.array(bucket), pa.array(places), batch.column("class").take(taken), batch.column("vector").take(taken)]
        return pa.RecordBatch.from_arrays(columns, names=["bucket", "places", "class", "vector"])

    schema = f"bucket bigint, places bigint, class bigint, vector {classes.schema['vector'].dataType.simpleString()}"

    def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """``parts``, merged: what one task finds for a query in several cells becomes one list."""
        held: list[tuple[np.ndarray, ...]] = []
        rows = 0
        for part in parts(batches):
            held.append(part)
            rows += len(part[0])
            if rows > MERGE_ROWS:
                merged = best_of(*map(np.concatenate, zip(*held, strict=True)), k + 1)
                held, rows = [merged], len(merged[0])
                if rows > MERGE_ROWS // 2:
                    yield pairs_of(merged)
                    held, rows = [], 0
        if held:
            yield pairs_of(best_of(*map(np.concatenate, zip(*held, strict=True)), k + 1))

    def pairs_of(part: tuple[np.ndarray, ...]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in part], names=["asked", "class", "score"])

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        """Each (bucket, chunk, block) in turn: first its candidates, then its queries."""
        waiting: pa.Table | None = None
        for batch in batches:
            fresh = pa.Table.from_batches([batch])
            waiting = fresh if waiting is None else pa.concat_tables([waiting, fresh])
            keys = np.stack([waiting.column(c).to_numpy().astype(np.int64) for c in ("bucket", "chunk", "block")])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            start = 0
            for cut in cuts:
                yield from best(waiting.slice(start, cut - start))
                start = cut
            waiting = waiting.slice(start).combine_chunks()
        if waiting is not None and waiting.num_rows:
            yield from best(waiting)

    def best(part: pa.Table) -> Iterator[tuple[np.ndarray, ...]]:
        batch = part.combine_chunks().to_batches()[0]
        role, ids, places = (batch.column(c).to_numpy() for c in ("role", "class", "places"))
        there, asking = np.flatnonzero(role == 0), np.flatnonzero(role == 1)
        if not len(there) or not len(asking):
            return
        x = _vectors(batch, "vector")
        # Ids rise, so that equal scores keep the smaller ones.
        there = there[np.argsort(ids[there], kind="stable")]
        scores = np.full((len(asking), len(there)), -np.inf)
        compared = np.zeros(scores.shape, bool)
        for place in np.unique(places[there]):
            i, j = np.flatnonzero(places[asking] & place), np.flatnonzero(places[there] == place)
            if len(i):
                scores[np.ix_(i, j)] = x[asking[i]] @ x[there[j]].T
                compared[np.ix_(i, j)] = True
        count = min(k + 1, len(there))
        level = np.partition(scores, -count, axis=1)[:, -count][:, None]
        equal = (scores == level) & compared
        above = scores > level
        i, j = np.nonzero(above | (equal & (equal.cumsum(axis=1) <= count - above.sum(axis=1, keepdims=True))))
        if len(i):
            yield ids[asking[i]], ids[there[j]], scores[i, j]

    def nearest_in(held: DataFrame, probes: DataFrame, name: str) -> DataFrame:
        """``(asked, class)``: for each probing class the best of what lies in its buckets."""
        # A count per cell; there are as many cells as tables and axes of each vector length.
        sizes = held.groupBy("bucket").agg(F.count(F.lit(1)).alias("_rows"))
        chunks = F.greatest(F.lit(1), F.ceil(F.col("_rows") / CHUNK_ROWS)).cast("int")
        asks = probes.groupBy("bucket").agg(F.count(F.lit(1)).alias("_asks"))
        blocks = F.greatest(F.lit(1), F.ceil(F.col("_asks") / QUERY_ROWS)).cast("int")
        counted = sizes.join(asks, "bucket").select("bucket", chunks.alias("_chunks"), blocks.alias("_blocks"))
        plan = materialise(counted, f"{name}-plan")

        def sent(side: DataFrame, own: str, other: str, role: int) -> DataFrame:
            part = F.pmod(F.xxhash64("class"), F.col(f"_{own}s")).cast("int")
            out = side.join(broadcast_if_small(plan), "bucket").select(
                "bucket", "places", "class", "vector", part.alias(own), F.explode(F.sequence(F.lit(0), F.col(f"_{other}s") - 1)).alias(other)
            )
            return out.select("bucket", "chunk", "block", F.lit(role).alias("role"), "places", "class", "vector")

        together = sent(held, "chunk", "block", 0).union(sent(probes, "block", "chunk", 1))
        dealt = together.repartition(partitions_for(spark), "bucket", "chunk", "block").sortWithinPartitions(
            "bucket", "chunk", "block", "role"
        )
        pairs = dealt.mapInArrow(rerank, "asked bigint, class bigint, score double")
        # The same pair may come from several tables. Products in blocks may differ in the last bit, so the
        # score is computed again below, from the original vectors.
        unique = pairs.groupBy("asked", "class").agg(F.max("score").alias("score"))
        by_score = Window.partitionBy("asked").orderBy(F.desc("score"), "class")
        ranks = unique.withColumn("_rank", F.row_number().over(by_score)).filter(F.col("_rank") <= k + 1)
        return materialise(ranks.select("asked", "class"), name)

    def everything(side: DataFrame) -> DataFrame:
        """All classes of a vector length as one bucket."""
        bucket = (-F.size("vector")).cast("bigint").alias("bucket")
        return side.select(bucket, F.lit(1).cast("bigint").alias("places"), "class", "vector")

    def of_lengths(side: DataFrame, lengths: DataFrame, how: str = "left_semi") -> DataFrame:
        return side.join(broadcast_if_small(lengths), F.size(side["vector"]) == lengths["size"], how).drop("size")

    by_hash = Window.partitionBy(F.size("vector")).orderBy(F.xxhash64("class"), "class")
    sample = searched.withColumn("_rank", F.row_number().over(by_hash)).filter(F.col("_rank") <= SAMPLE_QUERIES)
    sample = materialise(sample.select("class", "vector"), "ann-sample")
    truth = nearest_in(everything(classes), everything(sample), "ann-truth").filter("asked != class")
    both = truth.join(sample.select(F.col("class").alias("asked"), "vector"), "asked").join(
        classes.select("class", F.col("vector").alias("other")), "class"
    )
    # At most k rows per query of the sample, and one row per vector length.
    needs = both.select("vector", "other").mapInArrow(measured, "size int, needed bigint, limit bigint")
    if probe_share is None:
        probes, hashing = F.ceil(F.percentile("needed", F.lit(LEAST_RECALL))), F.col("probes") < F.col("limit")
    else:
        probes, hashing = F.ceil(F.max("limit") * F.lit(tables * probe_share)), F.lit(True)
    lengths = needs.groupBy("size").agg(probes.cast("bigint").alias("probes"), F.max("limit").alias("limit"))
    served = materialise(lengths.filter(hashing).select("size", "probes"), "ann-hashed")

    def buckets(side: DataFrame, hashing, how: str) -> DataFrame:
        return of_lengths(side, served, how).mapInArrow(hashing, schema).union(everything(of_lengths(side, served, "left_anti")))

    held = buckets(classes.select("class", "vector"), hashed, "left_semi")
    first = nearest_in(held, buckets(searched.select("class", "vector"), probing, "inner"), "ann-first")
    # Whoever found fewer looks at all classes of the length.
    full = first.groupBy("asked").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > k)
    lacking = of_lengths(searched.select("class", "vector"), served).join(full, F.col("class") == F.col("asked"), "left_anti")
    lacking = materialise(lacking, "ann-lacking")
    rest = of_lengths(classes, lacking.select(F.size("vector").alias("size")).distinct())
    second = nearest_in(everything(rest), everything(lacking), "ann-second")
    nearest = first.union(second).distinct()
    product = F.aggregate(F.zip_with("a", "b", lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda t, x: t + x)
    exact = (
        nearest.join(classes.select(F.col("class").alias("asked"), F.col("vector").alias("a")), "asked")
        .join(classes.select("class", F.col("vector").alias("b"), "ids"), "class")
        .select("asked", product.alias("score"), F.explode("ids").alias("vec_id"))
    )
    # Per query vector the best k + 1 ids; each query then leaves itself out.
    ordered = Window.partitionBy("asked").orderBy(F.desc("score"), "vec_id")
    lists = (
        exact.withColumn("_rank", F.row_number().over(ordered))
        .filter(F.col("_rank") <= k + 1)
        .groupBy("asked")
        .agg(F.array_sort(F.collect_list(F.struct("_rank", "vec_id", "score"))).alias("found"))
    )
    others = F.filter("found", lambda e: e["vec_id"] != F.col("id"))
    answers = asked.join(lists, asked["class"] == lists["asked"]).select(
        F.col("id").alias("query_id"), F.posexplode(F.slice(others, 1, k)).alias("_place", "_hit")
    )
    return answers.select(
        "query_id", (F.col("_place") + 1).cast("int").alias("rank"), F.col("_hit.vec_id").alias("vec_id"), F.col("_hit.score").alias("score")
    )
