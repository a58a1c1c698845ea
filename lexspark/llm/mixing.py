"""Interleaving sources to target weights by proportionate-fair scheduling.

Every source is a stream of documents in a shuffled order, cut into blocks of text; a
document belongs to the block in which it starts. One block is delivered per slot. Block ``j`` of a source
with share ``w`` is released at slot ``floor((j - 1) / w)`` and due by ``ceil(j / w)``; in each slot the released
block with the earliest deadline goes first. All deadlines are met, so at any time a source is less than
one block away from its share. Shares are exact fractions of the given weights; nothing is rounded.

When a source runs out, the remaining ones go on under their own shares (a phase), starting without lag.
Nothing is dropped or repeated: every document gets one slot.

The schedule is a table of (source, block, slot), made by one task from one row per source, and joined with the
documents by source and block. It has at most ``MAX_SLOTS`` rows and one per source, as a block has
``BLOCK_BYTES`` of text or, in larger corpora, the ``MAX_SLOTS``-th part of all text. Positions within sources
are running totals over ids and sizes, so a source with a third of all rows is spread like any other.

Defined results: null sources are a source of their own; null texts count one byte, like empty ones;
repeated rows each get their own place; an empty table gives an empty result; a document longer than a
block fills the blocks it covers; sources without a weight, or with weight 0, come after all others, in equal
shares; negative weights and those that are no numbers raise ``ValueError``. Other columns keep their values.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexspark.operators.ordered import running_totals
from lexspark.session import materialise, partitions_for

BLOCK_BYTES = 64 * 1024
#: Slots of a schedule, besides one per source.
MAX_SLOTS = 1 << 20
#: Default target weights: bytes of the source to this power, which lifts small sources.
EXPONENT = 0.5
BATCH_ROWS = 100_000


def whole_weights(weights: dict[str | None, float]) -> dict[str | None, int]:
    """The same proportions as whole numbers, exactly."""
    exact = {s: Fraction(w) for s, w in weights.items()}
    scale = math.lcm(*[x.denominator for x in exact.values()])
    whole = {s: int(x * scale) for s, x in exact.items()}
    shared = math.gcd(*whole.values())
    return {s: w // shared for s, w in whole.items()}


def schedule(blocks: dict[str | None, int], weights: dict[str | None, float]) -> Iterator[tuple[str | None, int, int, int]]:
    """``(source, block, slot, phase)`` for every block of every source, slot by slot.

    Sources with a weight come first, then those without one in equal shares.
    """
    order = sorted(blocks, key=lambda s: (s is None, str(s)))
    done = dict.fromkeys(order, 0)
    slot = phase = 0
    for group in ([s for s in order if weights.get(s, 0)], [s for s in order if not weights.get(s, 0)]):
        active = [s for s in group if blocks[s]]
        while active:
            shares = whole_weights({s: weights.get(s, 0) or 1 for s in active})
            total, first = sum(shares.values()), slot
            waiting = [(0, rank, 0) for rank in range(len(active))]  # (release, rank, block of this phase)
            ready: list[tuple[int, int, int]] = []
            running = True
            while running:
                while waiting and waiting[0][0] <= slot - first:
                    _, rank, block = heapq.heappop(waiting)
                    heapq.heappush(ready, (-(-(block + 1) * total // shares[active[rank]]), rank, block))
                _, rank, block = heapq.heappop(ready)
                source = active[rank]
                yield source, done[source], slot, phase
                done[source] += 1
                slot += 1
                heapq.heappush(waiting, ((block + 1) * total // shares[source], rank, block + 1))
                running = done[source] < blocks[source]
            active = [s for s in active if done[s] < blocks[s]]
            phase += 1


def check_weights(weights: dict[str | None, float]) -> None:
    if any(not math.isfinite(w) or w < 0 for w in weights.values()):
        raise ValueError("weights must be finite numbers of 0 or more")


def text_bytes(text: Column) -> Column:
    return F.greatest(F.coalesce(F.octet_length(text), F.lit(0)), F.lit(1)).cast("bigint")


def _slots(sizes: DataFrame, weights: dict[str | None, float] | None, block_bytes: int, max_slots: int) -> DataFrame:
    """``(source, block, slot, phase, block_bytes)`` from ``(source, bytes)``, one row per source; one task."""

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str | None, int] = {}
        for batch in batches:
            held.update(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        size = max(block_bytes, -(-sum(held.values()) // max_slots))
        wanted = {s: n**EXPONENT for s, n in held.items()} if weights is None else weights
        rows: list[tuple] = []
        for row in schedule({s: -(-n // size) for s, n in held.items()}, wanted):
            rows.append(row)
            if len(rows) == BATCH_ROWS:
                yield as_batch(rows, size)
                rows = []
        if rows:
            yield as_batch(rows, size)

    def as_batch(rows: list[tuple], size: int) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32())
        columns = [pa.array(values, kind) for values, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
        columns.append(pa.array([size] * len(rows), pa.int64()))
        return pa.RecordBatch.from_arrays(columns, names=["p_source", "p_block", "slot", "phase", "block_bytes"])

    one_task = sizes.select(F.col("source").cast("string"), "bytes").coalesce(1)
    made = one_task.mapInArrow(plan, "p_source string, p_block bigint, slot bigint, phase int, block_bytes bigint")
    return materialise(made, "mixing-slots")


def mixing_order(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    block_bytes: int = BLOCK_BYTES,
    max_slots: int = MAX_SLOTS,
) -> DataFrame:
    """``(id, source, size, start, block, slot, phase)``: where every document goes.

    Sorting by (slot, start) gives the mixed order. ``start`` is the first byte in the source's stream.
    """
    check_weights(weights or {})
    keys = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), text_bytes(F.col(text_col)).alias("size"))
    keys = keys.withColumn("shuffle", F.xxhash64("id", F.lit("mix")))
    placed = running_totals(keys, "source", ["shuffle", "id", "size"], {"start": F.col("size")}, "mixing-keys")
    slots = _slots(keys.groupBy("source").agg(F.sum("size").alias("bytes")), weights, block_bytes, max_slots)
    size = F.coalesce(slots.agg(F.max("block_bytes")).scalar(), F.lit(block_bytes))
    start = F.col("start")
    placed = placed.withColumn("block", ((start - start % size) / size).cast("bigint"))
    same = F.col("source").cast("string").eqNullSafe(F.col("p_source")) & (F.col("block") == F.col("p_block"))
    return placed.join(slots, same).select(
        F.col("id").alias(id_col),
        F.col("source").alias(source_col),
        "size",
        "start",
        "block",
        "slot",
        "phase",
    )


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents in mixed order, with their own columns only: sorted ranges of slots."""
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    order = mixing_order(docs, **options).select(
        F.col(id_col).alias("_id"), F.col("size").alias("_size"), F.col("slot").alias("_slot"), F.col("start").alias("_start"),
        F.col(options.get("source_col", "source")).alias("_source"),
    )
    # Repeated ids are told apart by a number, so that no row is lost or multiplied.
    numbered = order.withColumn(
        "_copy", F.row_number().over(Window.partitionBy("_id", "_size", "_source").orderBy("_slot", "_start"))
    )
    source = F.col(options.get("source_col", "source"))
    sized = docs.withColumns({"_n": text_bytes(F.col(text_col))})
    sized = sized.withColumn(
        "_k", F.row_number().over(Window.partitionBy(id_col, "_n", source).orderBy(F.xxhash64(text_col)))
    )
    joined = sized.join(
        numbered,
        sized[id_col].eqNullSafe(numbered["_id"])
        & (sized["_n"] == numbered["_size"])
        & source.eqNullSafe(numbered["_source"])
        & (sized["_k"] == numbered["_copy"]),
    )
    parts = partitions_for(docs.sparkSession)
    dealt = joined.repartitionByRange(parts, "_slot", "_start").sortWithinPartitions("_slot", "_start")
    return dealt.select(*docs.columns)
