"""Similarity self-join of documents on word shingles, and the components of its links.

Two documents link when their shingle sets have a Jaccard similarity of ``SIMILARITY_PCT`` or more.

* Equal sets are one class; only classes are compared. A class is named by a 64-bit hash and its size.
* Shingles are ordered rare first, by counts over all documents in a sketch of fixed size, then by hash.
  Sets that link share a shingle of their prefixes, so only prefixes are shuffled. A shingle in the prefix of one class
  alone falls away where it is grouped.
* Pairs are formed in two rounds. The first joins each group of equal prefix shingles to one
  of its members and verifies those pairs; a large group of near copies becomes connected by a number
  of pairs in proportion to its size. The second forms the pairs of different components only,
  under the length and positional filters and a suffix filter (a bound on the difference of two
  sets from how many of their hashes fall into each of ``SIGNATURE`` ranges). A task compares two blocks of at
  most ``BLOCK_ROWS`` rows of a group at a time, so a group of any size spreads over tasks.
* Pairs of both rounds pass a finer suffix filter, with as many ranges as the smaller set has hashes, before any
  set is moved. Each pair is verified once (the second round leaves out what the first one tried), with exact
  integer arithmetic on the whole sets. Two sets in one component need no further link, so no component is lost.

Broadcast are two arrays of fixed size: the sketch (16 MB) and a bitmap of the wanted ids (2 MB), which
only spares the shuffle other texts.

Defined results: null and empty texts, and texts without words, have no shingles and link with nothing;
repeated rows and equal texts share a component; texts with fewer words than a shingle have one; an
empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark.llm.common import arrow_batches
from lexspark.llm.components import connected_components
from lexspark.llm.shingles import set_key, shingle_sets
from lexspark.operators.ordered import running_totals
from lexspark.session import BROADCAST_LIMIT_BYTES, broadcast_if_small, estimated_bytes, materialise, partitions_for

SIMILARITY_PCT = 80
SKETCH_BITS = 22
SKETCH_SLICES = 64
BITMAP_BITS = 1 << 24
SIGNATURE = 256
#: Rows of one group that are held at once when centres are chosen.
RUN_ROWS = 200_000
#: In groups up to this size, rows without a possible partner fall away before anything else is done.
SMALL_GROUP = 64
#: Rows of one block; a task compares two blocks at a time.
BLOCK_ROWS = 1024
#: Pairs of one class that meet one copy of its set.
FAN_OUT = 4096
#: What a Python task is handed at a time: texts, or pairs with both sets. Two tasks and their copies in the JVM share an
#: executor's memory beyond its heap.
BATCH_ROWS, BATCH_BYTES = 2000, "8m"


def least_overlap(size_a, size_b):
    """Shingles two sets of these sizes must share to link: s/(100+s) of the sum, rounded up."""
    return (SIMILARITY_PCT * (size_a + size_b) + 99 + SIMILARITY_PCT) // (100 + SIMILARITY_PCT)


def prefix_length(size: int) -> int:
    return size - (SIMILARITY_PCT * size + 99) // 100 + 1


# -- classes and counts ----------------------------------------------------------------------------


def _profiles(docs: DataFrame, id_type: str) -> DataFrame:
    """Per document ``(id, n, key)``; and per task and slice the counts of the sketch."""

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << SKETCH_BITS, np.uint32)
        ids = None
        for batch in batches:
            ids = batch.schema.field(0).type
            sizes, keys = [], []
            for hashes in shingle_sets(x.as_py() for x in batch.column(1)):
                sizes.append(len(hashes))
                keys.append(set_key(hashes))
                sketch[(hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)] += 1
            empty = pa.nulls(batch.num_rows, pa.int32()), pa.nulls(batch.num_rows, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.int64()), *empty], names=names
            )
        if ids is not None:
            parts = [zlib.compress(x.astype("<u4").tobytes(), 1) for x in np.split(sketch, SKETCH_SLICES)]
            n = len(parts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.nulls(n, ids),
                    pa.nulls(n, pa.int64()),
                    pa.nulls(n, pa.int64()),
                    pa.array(range(n), pa.int32()),
                    pa.array(parts, pa.binary()),
                ],
                names=names,
            )

    names = ["id", "n", "key", "slice", "counts"]
    return docs.mapInArrow(profile, f"id {id_type}, n bigint, key bigint, slice int, counts binary")


def _sketch(profiles: DataFrame) -> np.ndarray:
    """The summed counts; ``SKETCH_SLICES`` rows of fixed size reach the driver."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                counts = np.frombuffer(zlib.decompress(data.as_py()), "<u4")
                if number in total:
                    total[number] += counts
                else:
                    total[number] = counts.astype(np.int64)
        packed = [zlib.compress(np.minimum(x, (1 << 32) - 1).astype("<u4").tobytes(), 1) for x in total.values()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array(packed, pa.binary())], names=["slice", "counts"]
        )

    schema = "slice int, counts binary"
    parts = profiles.filter("counts IS NOT NULL").select("slice", "counts")
    out = np.zeros((SKETCH_SLICES, (1 << SKETCH_BITS) // SKETCH_SLICES), np.int64)
    for row in parts.repartition(SKETCH_SLICES, "slice").mapInArrow(add, schema).collect():
        out[row["slice"]] += np.frombuffer(zlib.decompress(row["counts"]), "<u4")
    return np.minimum(out.reshape(-1), (1 << 32) - 1).astype(np.uint32)


# -- prefixes and their groups ---------------------------------------------------------------------


def _prefixes(docs: DataFrame, sketch) -> DataFrame:
    """``(token, n, key, pos)``: the prefix of every class, once per task that meets it."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, met = sketch.value, set()
        for batch in batches:
            tokens, sizes, keys = [], [], []
            for hashes in shingle_sets(x.as_py() for x in batch.column(0)):
                key = set_key(hashes), len(hashes)
                if not len(hashes) or key in met:
                    continue
                met.add(key)
                order = np.argsort(counts[(hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)], kind="stable")
                tokens.append(hashes[order[: prefix_length(len(hashes))]])
                keys.append(key[0])
                sizes.append(len(hashes))
            lengths = [len(t) for t in tokens]
            columns = [
                np.concatenate(tokens).view(np.int64) if tokens else np.empty(0, np.int64),
                np.repeat(np.array(sizes, np.int32), lengths),
                np.repeat(np.array(keys, np.int64), lengths),
                np.concatenate([np.arange(n, dtype=np.int32) for n in lengths]) if tokens else np.empty(0, np.int32),
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["token", "n", "key", "pos"])

    return docs.select("text").mapInArrow(emit, "token bigint, n int, key bigint, pos int")


def has_partner(token: np.ndarray, n: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Rows that pass the length and positional filters with some other row of their group.

    Rows are sorted by token. Neighbours at distance 1, 2, ... are compared; rows of groups above
    ``SMALL_GROUP`` are all kept.
    """
    kept = np.zeros(len(token), bool)
    sizes, places = n.astype(np.int64), pos.astype(np.int64)
    for distance in range(1, SMALL_GROUP):
        first = np.flatnonzero(token[:-distance] == token[distance:]) if distance < len(token) else []
        if not len(first):
            return kept
        second = first + distance
        a, b = sizes[first], sizes[second]
        shared = np.minimum(a - places[first], b - places[second])
        may = (100 * np.minimum(a, b) >= SIMILARITY_PCT * np.maximum(a, b)) & (shared >= least_overlap(a, b))
        kept[first[may]] = kept[second[may]] = True
    starts = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
    lengths = np.diff(np.append(starts, len(token)))
    return kept | np.repeat(lengths > SMALL_GROUP, lengths)


GROUP_COLUMNS = ["token", "n", "key", "pos", "c_n", "c_key", "c_pos"]


def group_runs(batches: Iterator[pa.RecordBatch], run_rows: int = RUN_ROWS) -> Iterator[pa.RecordBatch]:
    """Rows of tokens that two or more classes share, each with the centre of its group.

    The rows come sorted by token and size, so a group is a run; a run is cut at ``run_rows`` rows, and
    the next part takes a member along. Partners of a row may lie in another part of a cut group, so all its
    rows stay.
    """

    def finished(part: list[np.ndarray]) -> pa.RecordBatch | None:
        token, n, key, pos = part
        new = np.ones(len(token), bool)  # drop the same class from other tasks
        new[1:] = (token[1:] != token[:-1]) | (key[1:] != key[:-1]) | (n[1:] != n[:-1])
        token, n, key, pos = (c[new] for c in part)
        kept = has_partner(token, n, pos)
        if continued is not None:
            kept |= token == continued
        token, n, key, pos = (c[kept] for c in (token, n, key, pos))
        starts = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]])) if len(token) else token
        lengths = np.diff(np.append(starts, len(token)))
        many = np.repeat(lengths > 1, lengths)
        centre = np.repeat(starts + lengths // 2, lengths)[many]
        if not len(centre):
            return None
        columns = [token[many], n[many], key[many], pos[many], n[centre], key[centre], pos[centre]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=GROUP_COLUMNS)

    held: list[np.ndarray] | None = None
    continued: int | None = None  # the token of the group that was cut last
    for batch in batches:
        fresh = [batch.column(i).to_numpy() for i in range(4)]
        held = fresh if held is None else [np.concatenate(x) for x in zip(held, fresh, strict=True)]
        if not len(held[0]):
            continue
        differs = held[0] != held[0][-1]
        cut = len(differs) - int(np.argmax(differs[::-1])) if differs[0] else 0  # where the last group starts
        if cut == 0 and len(held[0]) >= run_rows:  # one group fills the buffer
            continued, middle = held[0][0], len(held[0]) // 2
            out = finished(held)
            held = [c[middle : middle + 1] for c in held]
        elif cut:
            out, held = finished([c[:cut] for c in held]), [c[cut:] for c in held]
        else:
            out = None
        if out is not None:
            yield out
    if held is not None and len(held[0]):
        out = finished(held)
        if out is not None:
            yield out


def _groups(prefixes: DataFrame) -> DataFrame:
    """``group_runs`` over the rows of each token."""
    spark = prefixes.sparkSession
    sorted_rows = prefixes.repartition(partitions_for(spark), "token").sortWithinPartitions("token", "n", "key")
    return sorted_rows.mapInArrow(
        group_runs, "token bigint, n int, key bigint, pos int, c_n int, c_key bigint, c_pos int"
    )


def _may_link(n: Column, pos: Column, other_n: Column, other_pos: Column) -> Column:
    """The length filter, and the positional filter for a token that is the first both share."""
    small, large = F.least(n, other_n), F.greatest(n, other_n)
    bound = 1 + F.least(n - pos - 1, other_n - other_pos - 1)
    total = SIMILARITY_PCT * (n + other_n)
    return (100 * small >= SIMILARITY_PCT * large) & (bound * (100 + SIMILARITY_PCT) >= total)


# -- sets and verification -------------------------------------------------------------------------


def _wanted_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(key, n, hashes, signature, histogram)`` of at least the classes in ``wanted (key, n, node)``.

    A bit may stand for other ids too, whose sets nobody asks for; a copy of a wanted text may come twice.
    Nothing is shuffled.
    """
    spark = docs.sparkSession

    def slot(column: str) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(BITMAP_BITS)) + 1

    marked = wanted.select(slot("node").alias("slot"))
    pieces = (
        marked.groupBy(F.bitmap_bucket_number("slot").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
        .collect()
    )  # BITMAP_BITS / 32768 rows of 4 kB at most
    bitmap = np.zeros(BITMAP_BITS // 8, np.uint8)
    for row in pieces:
        start = (row["bucket"] - 1) * 4096
        bitmap[start : start + 4096] = np.frombuffer(row["bits"], np.uint8)
    shared = spark.sparkContext.broadcast(bitmap)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            slots = batch.column(2).to_numpy()
            hit = pa.array((bits[(slots - 1) // 8] >> ((slots - 1) % 8).astype(np.uint8)) & 1 == 1)
            batch = batch.filter(hit)
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                keys, sizes, sets, signatures, histograms = [], [], [], [], []
                for hashes in shingle_sets(x.as_py() for x in part.column(1)):
                    keys.append(set_key(hashes))
                    sizes.append(len(hashes))
                    sets.append(hashes.tobytes())
                    ranges = np.bincount((hashes >> np.uint64(56)).astype(np.int64), minlength=SIGNATURE)
                    signatures.append(np.minimum(ranges, 255).astype(np.uint8).tobytes())
                    histograms.append(histogram(hashes).tobytes())
                columns = [
                    pa.array(keys, pa.int64()),
                    pa.array(sizes, pa.int32()),
                    pa.array(sets, pa.binary()),
                    pa.array(signatures, pa.binary()),
                    pa.array(histograms, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "n", "hashes", "signature", "histogram"])

    found = docs.select("id", "text", slot("id").alias("slot")).filter("id IS NOT NULL").mapInArrow(
        gather, "key bigint, n int, hashes binary, signature binary, histogram binary"
    )
    return found


def histogram(hashes: np.ndarray) -> np.ndarray:
    """Hashes per range of their values, at most 255; up to one range per hash, a power of two of them."""
    bits = max(len(hashes).bit_length() - 1, 1)
    ranges = np.bincount((hashes >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return np.minimum(ranges, 255).astype(np.uint8)


def least_difference(x: np.ndarray, y: np.ndarray) -> int:
    """At least so many hashes are in one of two sets only, by their histograms."""
    if len(x) < len(y):
        x, y = y, x
    folded = np.minimum(x.reshape(len(y), -1).sum(axis=1, dtype=np.int64), 255)
    return int(np.abs(folded - y).sum())


SIDES = (("key", "n", "x"), ("c_key", "c_n", "y"))


def _with_set(pairs: DataFrame, named: DataFrame, sets: DataFrame, column: str, side: tuple[str, str, str]) -> DataFrame:
    """``pairs`` with ``column`` of one side's class (key, n); ``named`` are the pairs without any set.

    A class in more than ``FAN_OUT`` pairs gets a copy of its set per that many, and its pairs are dealt to them.
    """
    key, n, name = side
    own = sets.select(F.col("key").alias(key), F.col("n").alias(n), F.col(column).alias(name))
    if estimated_bytes(named) <= BROADCAST_LIMIT_BYTES // 2:  # few pairs: sets that none of them names are not moved
        own = own.join(F.broadcast(named.select(key, n).distinct()), [key, n], "left_semi")
    often = named.groupBy(key, n).count().filter(F.col("count") > FAN_OUT)
    often = materialise(often.select(key, n, F.ceil(F.col("count") / FAN_OUT).cast("int").alias("_copies")), "hot-classes")
    if often.isEmpty():
        return pairs.join(own, [key, n])
    often = broadcast_if_small(often)
    rest = pairs.join(often, [key, n], "left_anti").join(own, [key, n])
    copies = own.join(often, [key, n]).withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)))
    dealt = pairs.join(often, [key, n]).withColumn("_copy", F.pmod(F.xxhash64(*named.columns), "_copies").cast("int"))
    hot = dealt.drop("_copies").join(copies.drop("_copies"), [key, n, "_copy"]).drop("_copy")
    return rest.unionByName(hot)


def _kept_pairs(pairs: DataFrame, sets: DataFrame, column: str, links: Callable[[int, int, np.ndarray, np.ndarray], bool]) -> DataFrame:
    """The ``pairs (key, n, c_key, c_n)``, a written table, for which ``links`` holds of both sizes and ``column``."""
    kind = np.uint64 if column == "hashes" else np.uint8

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for n, m, x, y in zip(*(batch.column(i) for i in (1, 3, 4, 5)), strict=True):
                kept.append(links(n.as_py(), m.as_py(), *(np.frombuffer(v.as_buffer(), kind) for v in (x, y))))
            yield batch.select([0, 1, 2, 3]).filter(pa.array(kept, pa.bool_()))

    joined = pairs
    for side in SIDES:
        joined = _with_set(joined, pairs, sets, column, side)
    return joined.select("key", "n", "c_key", "c_n", "x", "y").mapInArrow(check, "key bigint, n int, c_key bigint, c_n int")


def _may_overlap(n: int, m: int, x: np.ndarray, y: np.ndarray) -> bool:
    return least_difference(x, y) <= n + m - 2 * int(least_overlap(np.int64(n), np.int64(m)))


def _overlap(n: int, m: int, x: np.ndarray, y: np.ndarray) -> bool:
    common = n + m - len(np.union1d(x, y))
    return bool(100 * common >= SIMILARITY_PCT * (n + m - common))


def _verified(pairs: DataFrame, sets: DataFrame, nodes: DataFrame) -> DataFrame:
    """The links among ``pairs (key, n, c_key, c_n)``, as nodes ``(a, b)``.

    Histograms, an eighth of the sets' bytes at most, leave few pairs that do not link; only for those that
    are left the sets are moved.
    """
    pairs = materialise(pairs, "candidate-pairs")
    close = materialise(_kept_pairs(pairs, sets, "histogram", _may_overlap).distinct(), "close-pairs")
    links = _kept_pairs(close, sets, "hashes", _overlap)
    other = nodes.select(F.col("key").alias("c_key"), F.col("n").alias("c_n"), F.col("node").alias("b"))
    named = links.join(nodes.select("key", "n", F.col("node").alias("a")), ["key", "n"]).join(other, ["c_key", "c_n"])
    return named.select("a", "b")


# -- pairs of different components -----------------------------------------------------------------


def _length_band(n: Column) -> Column:
    """Sets that can link lie in the same or in neighbouring bands."""
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(100 / SIMILARITY_PCT))).cast("int")


UNIT_COLUMNS = ["token", "a", "b", "side", "n", "key", "pos", "component", "signature"]


def _units(rows: DataFrame) -> DataFrame:
    """Deals groups into units of at most two blocks of ``BLOCK_ROWS`` rows (``UNIT_COLUMNS``).

    ``rows`` has ``(token, n, key, pos, component, signature, size)``. A group of up to a block is a unit. A larger
    one is sorted by length and component and cut into blocks, and every two blocks meet in a unit of their own,
    unless all their rows are of one component or too different in length.
    """
    small = rows.filter(F.col("size") <= BLOCK_ROWS).withColumns({c: F.lit(0).cast("bigint") for c in ("a", "b")})
    small = small.withColumn("side", F.lit(0)).select(*UNIT_COLUMNS)
    banded = rows.filter(F.col("size") > BLOCK_ROWS).withColumn("_band", _length_band(F.col("n")))
    order = ["_band", "component", "n", "key"]
    placed = running_totals(banded, "token", order, {"_at": F.lit(1)}, "large-groups")
    blocks = placed.withColumn("block", F.floor(F.col("_at") / BLOCK_ROWS).cast("bigint"))
    ends = [f(c).alias(f"{name}_{c}") for name, f in (("min", F.min), ("max", F.max)) for c in ("n", "component")]
    ranges = blocks.groupBy("token", "block").agg(*ends)
    x, y = (ranges.select("token", *[F.col(c).alias(f"{side}_{c}") for c in ranges.columns[1:]]) for side in "xy")
    one = (F.col("x_min_component") == F.col("y_max_component")) & (F.col("x_max_component") == F.col("y_min_component"))
    near = (100 * F.col("x_max_n") >= SIMILARITY_PCT * F.col("y_min_n")) & (
        100 * F.col("y_max_n") >= SIMILARITY_PCT * F.col("x_min_n")
    )
    met = x.join(y, "token").filter((F.col("x_block") <= F.col("y_block")) & ~one & near)
    met = met.select("token", F.col("x_block").alias("a"), F.col("y_block").alias("b"))
    left = blocks.join(met.withColumn("block", F.col("a")), ["token", "block"]).withColumn("side", F.lit(0))
    right = blocks.join(met.filter("a < b").withColumn("block", F.col("b")), ["token", "block"]).withColumn("side", F.lit(1))
    return small.unionByName(left.select(*UNIT_COLUMNS)).unionByName(right.select(*UNIT_COLUMNS))


def _block_pairs(x: dict[str, np.ndarray], y: dict[str, np.ndarray], same: bool) -> Iterator[pa.RecordBatch]:
    """The pairs of rows of two blocks (or of one, if they are the ``same``) that pass all filters."""
    n, m = x["n"][:, None], y["n"][None, :]
    may = x["component"][:, None] != y["component"][None, :]
    may &= 100 * np.minimum(n, m) >= SIMILARITY_PCT * np.maximum(n, m)
    may &= 1 + np.minimum(n - x["pos"][:, None] - 1, m - y["pos"][None, :] - 1) >= least_overlap(n, m)
    if same:
        may = np.triu(may, 1)
    first, second = np.nonzero(may)
    for start in range(0, len(first), 10_000):
        i, j = first[start : start + 10_000], second[start : start + 10_000]
        apart = np.abs(x["signature"][i].astype(np.int16) - y["signature"][j].astype(np.int16)).sum(axis=1, dtype=np.int64)
        near = apart <= x["n"][i] + y["n"][j] - 2 * least_overlap(x["n"][i], y["n"][j])
        i, j = i[near], j[near]
        if len(i):
            columns = [x["key"][i], x["n"][i].astype(np.int32), y["key"][j], y["n"][j].astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "n", "c_key", "c_n"])


def unit_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``_block_pairs`` of every unit; rows come sorted by unit and side. One unit is held at a time."""

    def as_rows(part: pa.Table) -> dict[str, np.ndarray]:
        rows = {c: part.column(c).to_numpy() for c in ("n", "key", "pos", "component")}
        rows["n"] = rows["n"].astype(np.int64)
        data = b"".join(x.as_py() for x in part.column("signature"))
        rows["signature"] = np.frombuffer(data, np.uint8).reshape(-1, SIGNATURE)
        return rows

    def compare(unit: pa.Table) -> Iterator[pa.RecordBatch]:
        split = int((unit.column("side").to_numpy() == 0).sum())
        left = as_rows(unit.slice(0, split))
        if unit.column("a")[0].as_py() == unit.column("b")[0].as_py():
            yield from _block_pairs(left, left, True)
        else:
            yield from _block_pairs(left, as_rows(unit.slice(split)), False)

    held: pa.Table | None = None
    for batch in batches:
        fresh = pa.Table.from_batches([batch])
        held = fresh if held is None else pa.concat_tables([held, fresh])
        if not held.num_rows:
            continue
        names = [held.column(c).to_numpy() for c in ("token", "a", "b")]
        differs = np.logical_or.reduce([c[1:] != c[:-1] for c in names])
        starts = np.concatenate([[0], np.flatnonzero(differs) + 1])
        for first, last in zip(starts[:-1], starts[1:], strict=True):
            yield from compare(held.slice(first, last - first))
        held = held.slice(starts[-1]).combine_chunks()
    if held is not None and held.num_rows:
        yield from compare(held)


def _cross_pairs(members: DataFrame) -> DataFrame:
    """Pairs of different components in one group, after the filters; the smaller class comes first."""
    spark, unit = members.sparkSession, ["token", "a", "b"]
    ordered = _units(members).repartition(partitions_for(spark), *unit).sortWithinPartitions(*unit, "side")
    return _ordered_pairs(ordered.mapInArrow(unit_pairs, "key bigint, n int, c_key bigint, c_n int")).distinct()


def _ordered_pairs(pairs: DataFrame) -> DataFrame:
    """The same pairs with the smaller (n, key) first."""
    x, y = F.struct("n", "key"), F.struct(F.col("c_n").alias("n"), F.col("c_key").alias("key"))
    ends = pairs.select(F.least(x, y).alias("x"), F.greatest(x, y).alias("y"))
    return ends.select(
        F.col("x.key").alias("key"), F.col("x.n").alias("n"), F.col("y.key").alias("c_key"), F.col("y.n").alias("c_n")
    )


# -- the join --------------------------------------------------------------------------------------


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``(id, n_shingles, component_id)``; the component is the least id that links reach."""
    with arrow_batches(docs.sparkSession, BATCH_ROWS, BATCH_BYTES):
        return _components(docs, id_col, text_col)


def _components(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """All Python work is run here; the result joins written tables only."""
    spark: SparkSession = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    profiles = materialise(_profiles(docs, id_type), "shingle-profiles")
    sketch = spark.sparkContext.broadcast(_sketch(profiles))
    profiles = profiles.filter("counts IS NULL").select("id", "n", "key")
    classes = profiles.filter("n > 0 AND id IS NOT NULL").groupBy("key", "n").agg(
        F.min("id").alias("node"), F.count(F.lit(1)).alias("copies")
    )

    groups = materialise(_groups(_prefixes(docs, sketch)), "prefix-groups")
    sketch.unpersist()
    members = groups.select("key", "n").distinct()
    wanted = materialise(
        members.join(classes.withColumn("n", F.col("n").cast("int")), ["key", "n"]).select("key", "n", "node"),
        "candidate-classes",
    )
    sets = materialise(_wanted_sets(docs, wanted), "candidate-sets")

    differs = (F.col("key") != F.col("c_key")) | (F.col("n") != F.col("c_n"))
    stars = materialise(
        groups.filter(differs & _may_link(F.col("n"), F.col("pos"), F.col("c_n"), F.col("c_pos")))
        .select("key", "n", "c_key", "c_n")
        .distinct(),
        "star-pairs",
    )
    first_links = _verified(stars, sets, wanted)
    first = materialise(connected_components(first_links), "components")

    placed = wanted.join(first, "node", "left").select("key", "n", F.coalesce("component", "node").alias("component"))
    placed_rows = materialise(
        groups.select("token", "key", "n", "pos").distinct().join(placed, ["key", "n"]), "placed-groups"
    )
    mixed = (
        placed_rows.groupBy("token")
        .agg(F.min("component").alias("_least"), F.max("component").alias("_most"), F.count(F.lit(1)).alias("size"))
        .filter("_least < _most")
        .select("token", "size")
    )
    signatures = sets.select("key", "n", "signature").dropDuplicates(["key", "n"])
    cross = _cross_pairs(placed_rows.join(mixed, "token").join(signatures, ["key", "n"]))
    failed = _ordered_pairs(stars)  # those that linked are of one component
    second_links = _verified(cross.join(failed, cross.columns, "left_anti"), sets, wanted)
    # The second round joins components of the first.
    left = first.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    right = first.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    bridges = (
        second_links.join(left, "a", "left")
        .join(right, "b", "left")
        .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    )
    second = materialise(
        connected_components(bridges).select(F.col("node").alias("component"), F.col("component").alias("over")),
        "components",
    )

    linked = first.join(second, "component", "left").select("node", F.coalesce("over", "component").alias("component"))
    alone = second.select(F.col("component").alias("node"), F.col("over").alias("component")).join(
        first.select("node"), "node", "left_anti"
    )
    of_node = linked.union(alone)
    of_class = (
        classes.join(of_node, "node", "left")
        .filter("copies > 1 OR component IS NOT NULL")
        .select("key", "n", F.coalesce("component", "node").alias("component"))
    )
    return profiles.join(of_class, ["key", "n"], "left").select(
        F.col("id").alias(id_col),
        F.col("n").cast("bigint").alias("n_shingles"),
        F.coalesce("component", "id").alias("component_id"),
    )


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that are the least of their component, with all columns; rows without an id stay.

    A document is its id: all texts of the least id stay, and of rows equal in id and text one.
    """
    named = docs.filter(F.col(id_col).isNotNull())
    first = jaccard_components(named, id_col, text_col).filter(F.col(id_col) == F.col("component_id"))
    kept = named.join(first.select(id_col).distinct(), id_col, "left_semi").select(*docs.columns)
    mark = "_" * (1 + max(map(len, docs.columns)))  # no column has such a name
    hashes = {f"{mark}hash": F.xxhash64(text_col), f"{mark}size": F.length(text_col)}
    once = kept.withColumns(hashes).dropDuplicates([id_col, *hashes]).drop(*hashes)
    return once.union(docs.filter(F.col(id_col).isNull()))
