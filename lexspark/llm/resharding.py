"""Resharding by minimum-cost flow.

The old layout has ``OLD_SHARDS`` shards by a hash of the text. Its contents fall into blocks: ranges of
the hash, and for a range larger than ``BLOCK_SHARE`` of a new shard also parts by a hash of the id, so copies of
one text stay together unless they are too many for a shard. From the old sizes and the new capacities a
minimum-cost flow (a byte that stays costs nothing, one that moves costs one) says how many bytes go
from each old to each new shard; blocks are dealt to these flows in order. Only shards that give or take
blocks are rewritten, as files; the others stay where they are.

Law: ``bytes``. New shards have equal capacities; they differ by about a block.

The driver sees sums per block only: at most ``OLD_SHARDS`` * ``RANGES`` * ``SPLIT`` of them. Texts are shuffled
once, to the writers of their shard, of which a large shard has several.

Defined results: null texts count one byte and have the checksum of an empty text; repeated rows are all
kept; an empty table gives an empty result; a text longer than a block is a block of its own. Other columns
are written along but not read.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.operators.ordered import running_totals
from lexspark.session import partitions_for, scratch_path

OLD_SHARDS = 12
NEW_SHARDS = 16
RANGES = 512
#: Parts by id that a large block is split into.
SPLIT = 64
#: A block above this share of a new shard's capacity is split.
BLOCK_SHARE = 0.25


def minimum_cost_flow(supply: list[int], capacity: list[int], cost: list[list[int]]) -> list[list[int]]:
    """Integer flows from suppliers to takers at least cost; the sums must agree.

    Successive shortest paths in the residual graph. There are as many nodes as shards.
    """
    rows, columns = len(supply), len(capacity)
    flow = [[0] * columns for _ in range(rows)]
    supply, capacity = list(supply), list(capacity)
    while any(supply):
        distance: dict[tuple[str, int], float] = {("s", i): 0 for i in range(rows) if supply[i]}
        before: dict[tuple[str, int], tuple[str, int]] = {}
        queue = deque(distance)
        while queue:  # label correcting: residual arcs have negative costs
            kind, i = queue.popleft()
            at = distance[kind, i]
            if kind == "s":
                arcs = [(("t", j), cost[i][j]) for j in range(columns)]
            else:
                arcs = [(("s", k), -cost[k][i]) for k in range(rows) if flow[k][i]]
            for node, price in arcs:
                if at + price < distance.get(node, float("inf")):
                    distance[node], before[node] = at + price, (kind, i)
                    queue.append(node)
        _, end = min((distance["t", j], j) for j in range(columns) if capacity[j])
        path = [("t", end)]
        while path[-1] in before:
            path.append(before[path[-1]])
        path.reverse()
        amount = min(supply[path[0][1]], capacity[end])
        for (kind, i), (_, j) in zip(path, path[1:], strict=False):
            if kind == "t":
                amount = min(amount, flow[j][i])
        for (kind, i), (_, j) in zip(path, path[1:], strict=False):
            if kind == "s":
                flow[i][j] += amount
            else:
                flow[j][i] -= amount
        supply[path[0][1]] -= amount
        capacity[end] -= amount
    return flow


def equal_capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (i < total % shards) for i in range(shards)]


def deal_blocks(blocks: list[tuple[int, int]], flow: list[list[int]]) -> list[int]:
    """A new shard for each (old shard, bytes) block: largest first, to the flow with most bytes open."""
    open_bytes = [list(row) for row in flow]
    targets = [0] * len(blocks)
    for i in sorted(range(len(blocks)), key=lambda i: (-blocks[i][1], i)):
        old, size = blocks[i]
        taker = max((j for j, planned in enumerate(flow[old]) if planned), key=lambda j: open_bytes[old][j])
        open_bytes[old][taker] -= size
        targets[i] = taker
    return targets


def record_bytes(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint")


def place(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", old_shards: int = OLD_SHARDS, new_shards: int = NEW_SHARDS) -> tuple[DataFrame, set[int]]:
    """``docs`` with ``_old`` and ``_new`` shard, and the new shards that give or take blocks."""
    text_hash = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    keyed = docs.withColumns(
        {
            "_old": F.pmod(text_hash, F.lit(old_shards)).cast("int"),
            "_range": F.pmod(F.floor(text_hash / old_shards).cast("bigint"), F.lit(RANGES)).cast("int"),
            "_split": F.pmod(F.xxhash64(F.col(id_col), F.lit("split")), F.lit(SPLIT)).cast("int"),
        }
    )
    sums = (
        keyed.groupBy("_old", "_range", "_split").agg(F.sum(record_bytes(F.col(text_col))).alias("bytes"))
    ).collect()
    total = sum(r["bytes"] for r in sums)
    ranges: dict[tuple[int, int], dict[int, int]] = {}
    for r in sums:
        ranges.setdefault((r["_old"], r["_range"]), {})[r["_split"]] = r["bytes"]
    limit = max(1, int(BLOCK_SHARE * total / new_shards))
    blocks: list[tuple[int, int, int | None, int]] = []  # old, range, part or None for the whole range, bytes
    for (old, number), parts in sorted(ranges.items()):
        if sum(parts.values()) > limit:
            blocks.extend((old, number, part, size) for part, size in sorted(parts.items()))
        else:
            blocks.append((old, number, None, sum(parts.values())))
    supply = [sum(b[3] for b in blocks if b[0] == old) for old in range(old_shards)]
    cost = [[int(i != j) for j in range(new_shards)] for i in range(old_shards)]
    flow = minimum_cost_flow(supply, equal_capacities(total, new_shards), cost)
    targets = deal_blocks([(b[0], b[3]) for b in blocks], flow)
    affected = set(range(old_shards, new_shards))
    for (old, *_), new in zip(blocks, targets, strict=True):
        if old != new:
            affected |= {old, new}
    plan = docs.sparkSession.createDataFrame(
        [(old, number, part, new) for (old, number, part, _), new in zip(blocks, targets, strict=True)],
        "p_old int, p_range int, p_part int, _new int",
    )
    ours = (
        (F.col("_old") == F.col("p_old"))
        & (F.col("_range") == F.col("p_range"))
        & (F.col("p_part").isNull() | (F.col("_split") == F.col("p_part")))
    )
    placed = keyed.join(F.broadcast(plan), ours).drop("p_old", "p_range", "p_part", "_range")
    return placed, affected


def rewrite(placed: DataFrame, affected: set[int], path: str) -> DataFrame:
    """Writes the affected new shards under ``path/shard=<n>``; returns the layout as a table.

    ``placed`` has ``_new`` and ``_split`` (by which a shard is spread over several files). Tasks take ranges of both,
    which a sample of all rows makes even.
    """
    spark = placed.sparkSession
    changed = placed.filter(F.col("_new").isin(*affected)) if affected else placed.filter("false")
    dealt = changed.repartitionByRange(partitions_for(spark), "_new", "_split")
    columns = [c for c in placed.columns if not c.startswith("_")]
    dealt.select(*columns, F.col("_new").alias("shard")).write.partitionBy("shard").parquet(path)
    kept = placed.filter(~F.col("_new").isin(*affected)) if affected else placed
    names = {f: placed.schema[f].dataType.simpleString() for f in columns}
    schema = ", ".join([*[f"`{f}` {t}" for f, t in names.items()], "shard int"])
    written = spark.read.schema(schema).parquet(path)
    return written.unionByName(kept.select(*columns, F.col("_new").cast("int").alias("shard")))


def reshard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """``(id, size, text_crc32, law, shard, slot, grown_shard)`` of every document in the new layout."""
    path = path or scratch_path(docs.sparkSession, "shards")
    placed, affected = place(docs.select(id_col, text_col), id_col, text_col)
    layout = rewrite(placed, affected, path)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = layout.select(
        F.col(id_col).alias("id"),
        record_bytes(F.col(text_col)).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
    )
    numbered = running_totals(rows, "shard", ["id", "text_crc32"], {"slot": F.lit(1)}, "shard-rows")
    return numbered.withColumn("grown_shard", F.lit(None).cast("int")).withColumnRenamed("id", id_col)
