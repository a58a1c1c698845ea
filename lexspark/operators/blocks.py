"""Postings in blocks of falling impact.

A block holds at most ``BLOCK_POSTINGS`` postings of one word, with the largest and the smallest frequency in it, and the
blocks of a word are numbered from the highest frequencies down. A reader that knows what frequency can still
matter reads the blocks above it and leaves the rest unread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexspark.session import materialise

BLOCK_POSTINGS = 128
#: A slot has about ``SAMPLED_PER_SLOT / SAMPLED_SHARE`` postings of a frequent word.
SAMPLED_SHARE, SAMPLED_PER_SLOT = 1 / 1024, 128


def posting_blocks(postings: DataFrame, id_col: str = "doc_id", block_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """``(word, block, n, tf_max, tf_min, postings)``; ``postings`` are structs (word_frequency, id), highest first.

    Postings are moved once, to the slot of their word; frequent words have many slots, along (frequency, id), so a
    word in all documents spreads over tasks. Only the blocks that lie in two slots are put together afterwards.
    """
    rows = postings.select("word", id_col, "word_frequency")
    cuts = materialise(_slot_cuts(rows, id_col), "slot-cuts")
    split = not cuts.isEmpty()
    first = F.lit(0).cast("bigint")
    if split:
        slotted = rows.join(F.broadcast(cuts), "word", "left")
        rows = slotted.withColumn("_slot", F.coalesce(_slot(id_col), F.lit(0))).drop("cuts")
        sizes = rows.join(F.broadcast(cuts), "word", "left_semi").groupBy("word", "_slot").agg(F.count(F.lit(1)).alias("_n"))
        earlier = Window.partitionBy("word").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
        starts = sizes.select("word", "_slot", F.sum("_n").over(earlier).alias("_start"))  # a row per cut and word
    else:
        rows = rows.withColumn("_slot", F.lit(0))
    inside = Window.partitionBy("word", "_slot").orderBy("_falling", id_col)
    placed = rows.withColumn("_falling", -F.col("word_frequency").cast("double")).withColumn(
        "_at", F.row_number().over(inside).cast("bigint") - 1
    )
    if split:
        placed = placed.join(F.broadcast(starts), ["word", "_slot"], "left")
        first = F.coalesce("_start", first)
    entry = F.struct("_falling", F.col(id_col), "word_frequency")
    block = F.floor((F.col("_at") + first) / block_postings).cast("bigint").alias("block")
    blocks = placed.groupBy("word", "_slot", block).agg(
        F.sort_array(F.collect_list(entry)).alias("_entries")  # block_postings at most
    )
    if split:
        stored = materialise(blocks.join(F.broadcast(cuts.select("word", F.lit(True).alias("_cut"))), "word", "left"), "posting-parts")
        part = F.coalesce("_cut", F.lit(False)) & (F.size("_entries") < block_postings)
        joined = stored.filter(part).groupBy("word", "block").agg(
            F.sort_array(F.flatten(F.collect_list("_entries"))).alias("_entries")
        )
        blocks = stored.filter(~part).select("word", "block", "_entries").unionByName(joined)
    return blocks.select(
        "word",
        "block",
        F.size("_entries").alias("n"),
        F.get("_entries", F.lit(0))["word_frequency"].alias("tf_max"),
        F.element_at("_entries", -1)["word_frequency"].alias("tf_min"),
        F.transform("_entries", lambda e: F.struct(e["word_frequency"].alias("word_frequency"), e[id_col].alias(id_col))).alias(
            "postings"
        ),
    )


def _spot(id_col: str) -> Column:
    return F.struct((-F.col("word_frequency").cast("double")).alias("falling"), F.col(id_col).alias("id"))


def _slot_cuts(rows: DataFrame, id_col: str) -> DataFrame:
    """``(word, cuts)`` of the words that are frequent in a sample: where their slots end, as structs (-frequency, id).

    The sample decides where postings are worked on, nothing else.
    """
    seen = rows.sample(SAMPLED_SHARE, seed=1).select("word", _spot(id_col).alias("_spot"))
    listed = seen.groupBy("word").agg(F.sort_array(F.collect_list("_spot")).alias("_spots"))
    cuts = F.filter("_spots", lambda s, i: (i + 1) % SAMPLED_PER_SLOT == 0)
    return listed.filter(F.size("_spots") >= 2 * SAMPLED_PER_SLOT).select("word", cuts.alias("cuts"))


def _slot(id_col: str) -> Column:
    """The number of cuts before a posting; null for words without cuts."""
    spot = _spot(id_col)
    return F.when(F.col("cuts").isNotNull(), F.size(F.filter("cuts", lambda c: c < spot)))


def block_order(blocks: DataFrame) -> DataFrame:
    """Sorted for storage: the scan of a word skips to its blocks, the highest first."""
    return blocks.repartitionByRange("word", "block").sortWithinPartitions("word", "block")


def long_form(blocks: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(id, word, word_frequency)`` of all blocks."""
    return blocks.select("word", F.explode("postings").alias("_p")).select(
        F.col(f"_p.{id_col}").alias(id_col), "word", F.col("_p.word_frequency").alias("word_frequency")
    )
